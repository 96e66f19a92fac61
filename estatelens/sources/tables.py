"""Versioned Parquet tables in a shared folder: write a new version, then commit its number.

A job never overwrites the directory it reads from (a merge reads version N and writes N+1), so a
failed or lost executor can only leave an unreferenced version behind, never a half-written table.
A commit is a small file named by its number that is created only where none of that name exists, so of two
writers that build on the same version one wins and the other is told.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


class CommitConflict(RuntimeError):
    """Another writer has committed the version number this write aimed at."""


VERSION = re.compile(r"v-\d{12}-[0-9a-f]{8}")
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def only_missing(e: AnalysisException) -> None:
    """Nothing at the path means empty; any other error is raised again."""
    if (e.getCondition() or "").split(".")[0] not in NOTHING_THERE:
        raise e


class TableStore:
    """Tables as immutable versions, numbered from 1. The commit of the highest number is the table; a crash at any point
    leaves the version before it in place.

    Creating a commit without overwriting is as exclusive as the file system's rename to a name that must not exist:
    atomic in HDFS and its like; a plain local folder checks first and renames then. Commit files are kept for good (a
    line each), so a number once taken can't be taken again; ``vacuum`` removes the data of old versions only.
    """

    def __init__(self, spark: SparkSession, root: str, retain: int | None = None):
        """With ``retain``, each write leaves the data of the newest ``retain`` versions only; at least 2, as a job may
        still read the version before its own."""
        if retain is not None and retain < 2:
            raise ValueError("a store retains at least 2 versions")
        self.spark = spark
        self.root = root.rstrip("/")
        self.retain = retain

    def _commits(self, name: str) -> DataFrame:
        log = self.spark.read.text(f"{self.root}/{name}/_commits")
        return log.select(F.col("_metadata.file_name").cast("long").alias("number"), F.col("value").alias("version"))

    def _newest(self, name: str) -> tuple[int, str | None]:
        try:
            newest = self._commits(name).agg(F.max(F.struct("number", "version"))).first()[0]
        except AnalysisException as e:
            only_missing(e)
            newest = None
        return (newest["number"], newest["version"]) if newest else (0, None)

    def version(self, name: str) -> int:
        """The number of the current version, 0 where there is none."""
        return self._newest(name)[0]

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _commit(self, name: str, number: int, version: str) -> None:
        sc, jvm = self.spark.sparkContext, self.spark._jvm
        hadoop = jvm.org.apache.hadoop.fs
        final = self._path(f"{self.root}/{name}/_commits/{number:012d}")
        draft = self._path(f"{self.root}/{name}/_drafts/{version}")
        fs = final.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(final.getParent())
        out = fs.create(draft, True)
        out.write(bytearray(version.encode()))
        out.close()
        files = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(final), sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if fs.exists(final):
                raise CommitConflict(f"version {number} of {name} was committed by another writer") from e
            raise

    def current_path(self, name: str) -> str | None:
        newest = self._newest(name)[1]
        if newest is None:
            try:
                self.spark.read.parquet(f"{self.root}/{name}/v-*")
            except AnalysisException as e:
                only_missing(e)
                return None
            raise RuntimeError(f"{self.root}/{name} holds versions but no commit names the current one")
        return f"{self.root}/{name}/{newest}"

    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    def read(self, name: str) -> DataFrame | None:
        path = self.current_path(name)
        return None if path is None else self.spark.read.parquet(path)

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None, base: int | None = None) -> str:
        """Materialise ``df`` as a new version and make it current. Returns the version path.

        ``base`` is the version that ``df`` was computed from (default: the current one as the write starts). Where another
        writer commits on the same base first, this one raises ``CommitConflict`` and changes nothing.
        """
        number = (self.version(name) if base is None else base) + 1
        version = f"v-{number:012d}-{uuid.uuid4().hex[:8]}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/{name}/{version}")
        self._commit(name, number, version)
        if self.retain is not None:
            self.vacuum(name, self.retain)
        return f"{self.root}/{name}/{version}"

    def vacuum(self, name: str, keep: int = 2) -> list[str]:
        """Remove the data of versions that are none of the newest ``keep`` commits; returns their names.

        A version aims at one number, told by its name. If that number is not above the newest commit's and the version
        isn't kept, it is old or has lost, and no writer can commit it any more: writes still running are never touched.
        """
        if keep < 1:
            raise ValueError("the current version is never removed")
        newest = self.version(name)
        if not newest:
            return []
        kept = {r["version"] for r in self._commits(name).where(F.col("number") > newest - keep).collect()}  # at most keep rows
        folder = self._path(f"{self.root}/{name}")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        there = [s.getPath().getName() for s in fs.listStatus(folder)]
        gone = sorted(v for v in there if VERSION.fullmatch(v) and int(v.split("-")[1]) <= newest and v not in kept)
        for v in gone:
            fs.delete(self._path(f"{self.root}/{name}/{v}"), True)
        return gone

    def bucketed(self, name: str, key: str, buckets: int = 32):
        """A table of one row per key that is changed by upserts."""
        from .buckets import BucketTable
        return BucketTable(self.spark, f"{self.root}/{name}", key, buckets)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        """A lazy, non-materialised model (kept only as a temp view)."""
        df.createOrReplaceTempView(name)
        return df


class RunLog:
    """What the runs of one day have finished, as appended lines: a run that died is taken up where it stopped, and a
    run after a finished one is a new attempt."""

    def __init__(self, store: TableStore, name: str):
        self.store, self.path = store, f"{store.root}/_runs/{name}"
        try:
            lines = [r[0].split("|") for r in store.spark.read.text(self.path).collect()]  # a few lines a run
        except AnalysisException as e:
            only_missing(e)
            lines = []
        last = max((int(n) for n, _ in lines), default=0)
        self.done = {step for n, step in lines if int(n) == last}
        self.attempt = last
        if "finished" in self.done or not last:
            self.attempt, self.done = last + 1, set()

    def note(self, step: str) -> None:
        self.store.spark.createDataFrame([(f"{self.attempt}|{step}",)], "value string").coalesce(1).write.mode("append").text(self.path)
        self.done.add(step)


def materialize(df: DataFrame, kind: str, store: TableStore | None = None, name: str | None = None) -> DataFrame:
    """view -> temp view, ephemeral -> the lazy frame itself, table -> new version read back."""
    if kind == "ephemeral":
        return df
    if kind == "view":
        return store.view(name, df) if store else df
    if kind == "table":
        store.write(name, df)
        return store.read(name)
    raise ValueError(f"unknown materialisation {kind!r} (incremental tables use plans.star.incremental_fact)")
