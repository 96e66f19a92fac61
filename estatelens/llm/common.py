"""Shared expressions and staging for the training-data operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

BLANK = "[ \\t-\\r]+"  # the bytes 0x20 and 0x09-0x0D


def ship(module: str) -> None:
    """Send the functions of ``module`` to executors by value: they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back.

    Cuts the lineage (a lost executor re-reads the table), keeps column pruning, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where the body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(col) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters outside 0x20 and 0x09-0x0D."""
    return F.array_remove(F.split(text, BLANK), "")


def group_key(col: Column) -> Column:
    """A non-null string per value; null is a group of its own."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("-"))


def pairs(arr: Column, body) -> Column:
    """``body(x, next x)`` for each element; the last one has a null partner."""
    return F.zip_with(arr, F.slice(arr, F.lit(2), F.greatest(F.size(arr), F.lit(1))), body)


def running(df: DataFrame, group: list[str], bucket: str, order: list, sums: dict[str, Column], rank: str) -> DataFrame:
    """Rank and exclusive running sums within ``group`` by (bucket, order), without a task that holds a whole group.

    ``bucket`` cuts each group into pieces of bounded size that are consecutive in the wanted order. Pieces are summed
    first (partial aggregates), their offsets come from a window over one row per (group, bucket), and only the rows
    of one piece are sorted together.
    """
    totals = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"),
                            *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    piece = Window.partitionBy(*group, bucket).orderBy(*order)
    inside = piece.rowsBetween(Window.unboundedPreceding, -1)
    out = df.join(offsets, [*group, bucket]).withColumns(
        {rank: F.row_number().over(piece) - 1 + F.col("_o")}
        | {k: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_o_{k}") for k, c in sums.items()})
    return out.drop("_o", *[f"_o_{k}" for k in sums])
