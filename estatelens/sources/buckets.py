"""One-row-per-key tables in a fixed number of hash buckets of the key, changed by upserts that rewrite touched buckets only.

``data/_bucket=<n>/`` holds a bucket. An upsert reads the buckets its keys fall into (partition filters), merges them, writes
their whole new content to ``_pending``, notes that as ready in the log, overwrites exactly these partitions (dynamic
overwrite) and notes it done. A job that dies before "ready" has changed nothing; one that dies after it is finished by
the next use, as writing a bucket's whole content again is harmless. Schema changes need no rewriting: the log keeps the
current schema, columns that a file lacks read as null and dropped ones are not read. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators.merge import merge_by_key
from ..session import written
from .tables import only_missing

BUCKET = "_bucket"


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 32):
        self.spark, self.path, self.key, self._new_buckets = spark, path.rstrip("/"), key, buckets

    # ---- the log: numbered lines, of which the last one tells the state ------------------------

    def _last(self) -> dict | None:
        try:
            line = self.spark.read.text(f"{self.path}/_log").agg(F.max("value")).first()[0]
        except AnalysisException as e:
            only_missing(e)
            return None
        return json.loads(line.split("|", 1)[1]) if line else None

    def _note(self, **state) -> None:
        line = f"{state['seq']:012d}{int(state['done'])}|{json.dumps(state)}"
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/_log")

    def _current(self) -> dict | None:
        """The state after finishing what a lost job left ready."""
        state = self._last()
        if state and not state["done"]:
            self._apply(state)
            state["done"] = True
        return state

    def _apply(self, state: dict) -> None:
        ready = self.spark.read.schema(self._schema(state)).parquet(f"{self.path}/_pending")
        (ready.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
         .option("partitionOverwriteMode", "static" if state["whole"] else "dynamic").parquet(f"{self.path}/data"))
        self._note(**{**state, "done": True})

    def _schema(self, state: dict) -> T.StructType:
        columns = [f for f in T.StructType.fromJson(state["schema"]).fields if f.name != BUCKET]
        return T.StructType([*columns, T.StructField(BUCKET, T.IntegerType())])

    def _data(self, state: dict) -> DataFrame:
        return self.spark.read.schema(self._schema(state)).parquet(f"{self.path}/data")

    def _dealt(self, df: DataFrame, buckets: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(buckets)).cast("int"))

    def _commit(self, df: DataFrame, seq: int, buckets: int, whole: bool) -> None:
        df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/_pending")
        state = {"seq": seq, "done": False, "buckets": buckets, "whole": whole, "schema": json.loads(df.schema.json())}
        self._note(**state)
        self._apply(state)

    # ---- use -----------------------------------------------------------------------------------

    def exists(self) -> bool:
        return self._last() is not None

    def read(self) -> DataFrame | None:
        state = self._current()
        return None if state is None else self._data(state).drop(BUCKET)

    def _touched(self, keys: DataFrame, state: dict) -> list[int]:
        """Buckets that some keys fall into: at most the table's number of buckets."""
        return sorted(r[0] for r in self._dealt(keys, state["buckets"]).select(BUCKET).distinct().collect())

    def rows_of(self, keys: DataFrame) -> DataFrame | None:
        """The stored rows of some keys, reading their buckets only."""
        state = self._current()
        if state is None:
            return None
        hit = self._data(state).where(F.col(BUCKET).isin(self._touched(keys, state))).drop(BUCKET)
        return hit.join(keys.select(self.key).distinct(), self.key, "left_semi")

    def upsert(self, changes: DataFrame) -> list[int]:
        """Insert or replace one row per key, following the columns of ``changes``; returns the buckets rewritten."""
        state = self._current()
        if state is None:
            self.replace(changes)
            return list(range(self._new_buckets))
        new = written(self._dealt(changes, state["buckets"]), "bucket-changes")
        touched = self._touched(new, state)
        if touched or set(new.columns) != set(self._schema(state).names):
            old = self._data(state).where(F.col(BUCKET).isin(touched))
            self._commit(merge_by_key(old, new, [self.key]), state["seq"] + 1, state["buckets"], whole=False)
        return touched

    def replace(self, rows: DataFrame) -> None:
        """The whole table anew (full refresh)."""
        state = self._current()
        buckets = state["buckets"] if state else self._new_buckets
        self._commit(self._dealt(rows, buckets), state["seq"] + 1 if state else 1, buckets, whole=True)
