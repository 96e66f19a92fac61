"""Landing zone (city/day JSON batches), raw listing table, quarantine sink, seeds."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions import to_utc_wallclock, utc_day
from ..session import written
from .tables import only_missing
from ..schemas import LOOKUP_SCHEMA, RAW_FIELDS, RAW_SCHEMA

PARTITIONS = ["source_city", "batch_date"]
CORRUPT = "_corrupt_record"


def batch_schema() -> T.StructType:
    """Typed batch row as found in landing files (times as ISO text)."""
    fields = []
    for name, dtype in RAW_FIELDS:
        if name == "source_city":
            continue
        fields.append(T.StructField(name, T.StringType() if name == "date_collected" else dtype))
    return T.StructType(fields)


def write_landing(df: DataFrame, root: str) -> None:
    """Write batches as JSON under source_city=/batch_date= folders. Re-delivering a city/day replaces
    exactly that folder (dynamic partition overwrite); cities without rows write nothing."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS).json(root))


def _folders(key: str, names: Sequence[str] | None) -> str:
    """Glob over the folders of one level, plain or key=value; ``None`` means all of them."""
    if names is None:
        return "*"
    literal = [re.sub(r"([\\{}\[\],*?])", r"\\\1", n) for n in names]
    return "{" + ",".join(p + n for n in literal for p in ("", f"{key}=")) + "}"


def _array_path(root: str, cities: Sequence[str] | None, day: str | None) -> str:
    """The <city>/<day> folders asked for. One glob, so that a missing city is no rows rather than an error."""
    if cities is None and day is None:
        return root
    return f"{root}/{_folders(PARTITIONS[0], cities)}/{_folders(PARTITIONS[1], None if day is None else [day])}"


def read_batches(spark: SparkSession, root: str, cities: Sequence[str] | None = None,
                 day: str | None = None, layout: str = "landing", corrupt: str | None = None) -> DataFrame:
    """Read city/day batches; ``corrupt`` names a column for the text of records that do not parse. ``layout="landing"``: folders written by ``write_landing`` (JSON lines
    under source_city=/batch_date=); ``layout="arrays"``: the source's own ``<city>/<day>/*.json``
    files, each one JSON array. A missing folder or an empty array is an empty batch, not an error.
    City/day filters are partition filters (landing) or part of the path (arrays), so other folders are never opened.
    """
    schema = batch_schema()
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"columnNameOfCorruptRecord": corrupt} if corrupt else {}
    empty = spark.createDataFrame([], T.StructType(schema.fields + [T.StructField("source_city", T.StringType()),
                                                                   T.StructField("batch_date", T.DateType())]))
    empty = empty.withColumn("date_collected", F.lit(None).cast("timestamp_ntz"))
    if cities is not None and not cities:
        return empty
    try:
        if layout == "arrays":
            # recursive lookup: folder names are parsed below, never inferred as partition columns
            df = (spark.read.schema(schema).options(**options).option("multiLine", True)
                  .option("recursiveFileLookup", True).json(_array_path(root, cities, day)))
            path = F.input_file_name()
            city = F.regexp_extract(path, r"/([^/]+)/[^/]+/[^/]+$", 1)
            day_dir = F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)
            # folder names may be plain ('katowice') or key=value ('source_city=katowice')
            df = df.withColumn("source_city", F.regexp_replace(city, "^[^=]*=", "")) \
                   .withColumn("batch_date", F.to_date(F.regexp_replace(day_dir, "^[^=]*=", "")))
        else:
            full = T.StructType(schema.fields + [T.StructField("source_city", T.StringType()),
                                                 T.StructField("batch_date", T.DateType())])
            df = spark.read.schema(full).options(**options).json(root)
    except AnalysisException as e:
        only_missing(e)
        return empty
    if cities is not None:
        df = df.filter(F.col("source_city").isin(list(cities)))
    if day is not None:
        df = df.filter(F.col("batch_date") == F.lit(day).cast("date"))
    return df.withColumn("date_collected", to_utc_wallclock(F.col("date_collected")))


def read_items(spark: SparkSession, root: str, cities: Sequence[str] | None = None, day: str | None = None) -> DataFrame:
    """Scraped items as landed: text files of one JSON item a line under source_city=/batch_date= folders, with a
    sequence that follows the files' order."""
    schema = T.StructType([T.StructField("item_json", T.StringType()), T.StructField("source_city", T.StringType()), T.StructField("batch_date", T.DateType())])
    try:
        df = spark.read.schema(schema).text(root)
    except AnalysisException as e:
        only_missing(e)
        df = spark.createDataFrame([], schema)
    df = df.withColumn("seq", F.monotonically_increasing_id())
    if cities is not None:
        df = df.filter(F.col("source_city").isin(list(cities)))
    return df if day is None else df.filter(F.col("batch_date") == F.lit(day).cast("date"))


@dataclass
class Landing:
    """Rows of the batches that could be read, and one row per batch: rows, corrupt records, readable."""
    rows: DataFrame
    status: DataFrame


def load_batches(spark: SparkSession, root: str, cities: Sequence[str] | None = None, day: str | None = None,
                 layout: str = "landing") -> Landing:
    """``read_batches`` with faults kept to their batch: a file (or line) that does not parse blocks its city and day as a
    whole, as rows are missing from it; other batches pass. The files are parsed once."""
    rows = written(read_batches(spark, root, cities, day, layout, corrupt=CORRUPT), "landing")
    status = written(rows.groupBy(*PARTITIONS).agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_records")
    ).withColumn("readable", F.col("corrupt_records") == 0), "landing-status")
    blocked = status.where(~F.col("readable")).select(*PARTITIONS)
    good = rows.drop(CORRUPT).join(blocked, PARTITIONS, "left_anti")
    return Landing(good.select(*[c for c in rows.columns if c != CORRUPT]), status)


def write_array_files(df: DataFrame, root: str, rows_per_file: int = 500, seq: str | None = None) -> None:
    """Write batches in the source's layout: JSON array files under <city>/<day>/ folders.

    Rows are grouped into arrays of at most ``rows_per_file`` (bounded groups; a big batch becomes
    several files in its folder).
    """
    order = F.col(seq) if seq else F.monotonically_increasing_id()
    body = df.drop(*PARTITIONS)
    x = df.select(*PARTITIONS, order.alias("_o"), F.struct(*body.columns).alias("_r"))
    # ordinals are consecutive within a task, so integer division makes chunks of <= rows_per_file
    x = x.withColumn("_chunk", F.floor(F.col("_o") / F.lit(rows_per_file)))
    docs = (x.groupBy(*PARTITIONS, "_chunk")
            .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_r"))), lambda s: s["_r"])).alias("value")))
    # one array document per file, as the source writes them
    (docs.select(*PARTITIONS, "value").write.mode("overwrite").option("maxRecordsPerFile", 1)
     .partitionBy(*PARTITIONS).text(root))


def to_raw_rows(df: DataFrame, source_city: str | None = None) -> DataFrame:
    """Enforce the raw table's 22 typed columns: missing ones become typed nulls, unknown ones are
    ignored, ``source_city`` is stamped from the batch identity."""
    cols = set(df.columns)
    out = []
    for f in RAW_SCHEMA.fields:
        if f.name == "source_city" and source_city is not None:
            out.append(F.lit(source_city).alias(f.name))
        elif f.name in cols:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def ensure_raw(spark: SparkSession, path: str) -> None:
    """Create the (empty) raw table with its day/city partitioning on first use; never touch an
    existing one, so later appends cannot disagree with the partition spec."""
    try:
        spark.read.parquet(path).limit(0).collect()
        return
    except AnalysisException as e:
        only_missing(e)
    empty = spark.createDataFrame([], RAW_SCHEMA).withColumn("collected_date", F.lit(None).cast("date"))
    empty.write.mode("ignore").partitionBy("collected_date", "source_city").parquet(path)


def append_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append to the raw table, partitioned by collection day and city, rows sorted by city.

    ``mode="append"`` keeps every delivery (reruns add duplicates, like the source pipeline);
    ``mode="replace"`` makes reruns idempotent: each delivered (day, city) partition is replaced.
    """
    rows = to_raw_rows(df).withColumn("collected_date", utc_day("date_collected"))
    # rebalance (not repartition): AQE splits a hot city-day into several tasks instead of one
    rows = rows.hint("rebalance", "collected_date", "source_city").sortWithinPartitions("source_city", "id")
    w = rows.write.partitionBy("collected_date", "source_city")
    if mode == "replace":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)


def read_raw(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Raw table scan with the 22 columns; ``since`` prunes day partitions (a literal filter on the
    stored partition column, so it prunes folders)."""
    # explicit schema: a table with no rows yet (every batch blocked so far) or no folder reads as empty
    schema = T.StructType(list(RAW_SCHEMA.fields) + [T.StructField("collected_date", T.DateType())])
    try:
        df = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        only_missing(e)
        df = spark.createDataFrame([], schema)
    if since is not None:
        df = df.filter(F.col("collected_date") >= F.lit(since).cast("date"))
    return df.select(*[f.name for f in RAW_SCHEMA.fields])


def write_quarantine(df: DataFrame, root: str) -> None:
    """Rejected rows as JSON lines per city and day, with their own types; a day delivered again replaces its folder."""
    write_landing(df, root)


def missing_rows(df: DataFrame, path: str) -> DataFrame:
    """The rows of a delivery that the raw table does not hold yet, looking at the delivery's own days only."""
    key = ["source_city", "id", "date_collected"]
    days = [r[0] for r in df.select(utc_day("date_collected")).distinct().collect()]  # the days of one delivery
    held = read_raw(df.sparkSession, path, since=min(days).isoformat() if days else None).select(*key).distinct()
    on = [df[k].eqNullSafe(held[k]) for k in key]
    return df.join(held, on[0] & on[1] & on[2], "left_anti")


def read_seed(spark: SparkSession, path: str) -> DataFrame | None:
    """City seed CSV (header). Missing file -> None (geo rule disabled); missing bbox columns -> the
    seed without them (geo rule skipped)."""
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        only_missing(e)
        return None
    types = {f.name: f.dataType for f in LOOKUP_SCHEMA.fields}
    return raw.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def write_seed(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
