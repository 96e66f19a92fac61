"""Latest-row-per-key selection.

``row_number() over (partition by keys order by ...) = 1`` is rewritten by Catalyst into a
``WindowGroupLimit`` that runs before the shuffle as well as after it, so each map task ships at most
one row per key: a hot key (say a third of all rows) costs one row per task, not one huge group.
Every ordering carries a full tiebreak so the choice is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (a list of sort columns, e.g. desc(ts))."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_last(df: DataFrame, keys: Sequence, seq: str = "seq") -> DataFrame:
    """In-batch dedup: the last occurrence (highest ``seq``) of each key wins."""
    return latest_per_key(df, keys, [F.col(seq).desc()])
