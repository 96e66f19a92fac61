"""Data tests: the failing rows of one test as a (lazy) DataFrame, and a whole suite compiled to one aggregate per model.

Generic tests (unique, not null, relationships, accepted values, expression, unique combination,
optional ``where`` pre-filter) and a severity per check (``error`` / ``warn``).

``run_declared`` counts all declared tests of a model in one pass over it: row conditions become filtered counts,
relationships a left join with each parent's distinct keys and a count of the rows without a partner (small parents are
broadcast by their measured size, larger ones shuffle). Only uniqueness needs the model's own rows shuffled: the keys of
all unique tests of a model are stacked and counted in one group-by.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _where(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(F.expr(where)) if where else df


def unique(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """Values seen more than once (nulls ignored): (unique_field, n_records)."""
    d = _where(df, where).filter(F.col(col).isNotNull())
    return (d.groupBy(F.col(col).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def not_null(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    return _where(df, where).filter(F.col(col).isNull())


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str, where: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join on the key)."""
    c = _where(child, where).filter(F.col(fk).isNotNull())
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return c.join(p, c[fk] == p["_pk"], "left_anti")


def accepted_values(df: DataFrame, col: str, values: Sequence, where: str | None = None) -> DataFrame:
    """Values outside the accepted set (nulls pass): (value_field, n_records)."""
    d = _where(df, where).filter(~F.col(col).isin(list(values)))
    return d.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def expression_is_true(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    return _where(df, where).filter(~F.coalesce(F.expr(expression), F.lit(False)))


def unique_combination(df: DataFrame, cols: Sequence[str], where: str | None = None) -> DataFrame:
    return (_where(df, where).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


@dataclass(frozen=True)
class Declared:
    """A test as declared for a model. ``expression`` is what must hold; frames of failing rows come with the run."""
    name: str
    model: str
    columns: tuple[str, ...] = ()
    to: str | None = None
    field: str | None = None
    values: tuple = ()
    expression: str | None = None
    where: str | None = None
    severity: str = "error"

    @property
    def column(self) -> str | None:
        return self.columns[0] if len(self.columns) == 1 else None


def _model_counts(df: DataFrame, tests: list[tuple[int, Declared]], models: dict[str, DataFrame]) -> list[DataFrame]:
    """(test, failures) frames of one model."""
    counts, stacked = [], []
    for i, t in tests:
        here = F.expr(f"coalesce(({t.where}), false)") if t.where else F.lit(True)
        col = F.col(t.columns[0]) if t.columns else None
        if t.name == "not_null":
            counts.append((i, F.count_if(here & col.isNull())))
        elif t.name == "accepted_values":
            counts.append((i, F.count_distinct(F.when(here & ~col.isin(list(t.values)), col))))
        elif t.name == "relationships":
            parent = models[t.to].select(F.col(t.field).alias(f"_key{i}")).where(F.col(f"_key{i}").isNotNull()).distinct().withColumn(f"_hit{i}", F.lit(True))
            df = df.join(parent, df[t.columns[0]] == F.col(f"_key{i}"), "left")
            counts.append((i, F.count_if(here & df[t.columns[0]].isNotNull() & F.col(f"_hit{i}").isNull())))
        elif t.name in ("unique", "unique_combination"):
            counted = here & col.isNotNull() if t.name == "unique" else here
            stacked.append(F.struct(F.lit(i).alias("test"), F.when(counted, F.to_json(F.struct(*t.columns))).alias("value")))
        else:
            counts.append((i, F.count_if(here & ~F.coalesce(F.expr(t.expression), F.lit(False)))))
    out = []
    if counts:
        row = df.agg(*[c.alias(f"c{i}") for i, c in counts])
        out.append(row.select(F.explode(F.array(*[F.struct(F.lit(i).alias("test"), F.col(f"c{i}").alias("failures")) for i, _ in counts])).alias("r")).select("r.*"))
    if stacked:
        values = df.select(F.explode(F.array(*stacked)).alias("r")).select("r.*").where(F.col("value").isNotNull())
        twice = values.groupBy("test", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        out.append(twice.groupBy("test").agg(F.count(F.lit(1)).alias("failures")))
    return out


def run_declared(tests: Sequence[Declared], models: dict[str, DataFrame], frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per declared test: failures, severity and status (pass / warn / fail).

    ``frames``: failing rows of tests that are queries of their own, by name. Tests on a model, or against a parent,
    that the run does not have are left out.
    """
    frames = frames or {}
    ready = [(i, t) for i, t in enumerate(tests) if t.name in frames or (t.model in models and (t.to is None or t.to in models) and (t.columns or t.expression))]
    parts = []
    for model in dict.fromkeys(t.model for _, t in ready):
        own = [(i, t) for i, t in ready if t.model == model and t.name not in frames]
        if own:
            parts += _model_counts(models[model], own, models)
    parts += [frames[t.name].agg(F.count(F.lit(1)).alias("failures")).select(F.lit(i).alias("test"), "failures") for i, t in ready if t.name in frames]
    spark = next(iter(models.values())).sparkSession
    listed = spark.createDataFrame([(i, t.name, t.model, t.column, t.severity) for i, t in ready], "test int, check_name string, model string, column_name string, severity string")
    counted = parts[0]
    for p in parts[1:]:
        counted = counted.unionByName(p)
    failures = F.coalesce("failures", F.lit(0)).cast("long")
    out = listed.join(counted, "test", "left").select("check_name", "model", "column_name", "severity", failures.alias("failures"))
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))
