"""Merge-by-key (upsert, no deletes) for plain Parquet tables, with schema sync.

new = (target rows whose key is not in source) UNION source. Columns follow the source: new columns
appear (null on untouched target rows), removed columns are dropped. The anti join only needs the
source's keys; both sides shuffle on the key (AQE turns it into a broadcast when the slice is small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target reshaped to the source's columns: missing ones become typed nulls, extra ones drop."""
    tcols = set(target.columns)
    return target.select(*[F.col(f.name) if f.name in tcols else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in source.schema.fields])


def merge_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    keep = sync_columns(target, source).join(source.select(*keys), list(keys), "left_anti")
    return keep.unionByName(source)
