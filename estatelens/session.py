"""Session helpers: a tuned local session for tests/bench and a shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "estatelens") -> SparkSession:
    """Session for tests, bench and the CLI. A cluster deployment passes its own conf instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and materialised tables.

    Read from the session (``spark.checkpoint.dir`` / the context's checkpoint dir). Only when the
    session names none (local tests) a private folder is created and registered.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # the cluster's shared folder when the session names one; a private folder only in a local session
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="estatelens-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/estatelens/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df):
    """Reliable checkpoint into the shared checkpoint folder: cuts the lineage so a frame used by many
    downstream jobs is computed once, and a lost executor never recomputes past it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str):
    """Write ``df`` to the shared scratch folder and read it back: like ``materialized``, but the planner knows the
    table's real size and reads only the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TASK_ROWS = 100_000  # rows a task takes of a table


def spread(df, *keys, rows: int = TASK_ROWS):
    """Deal a table out to tasks of about ``rows`` rows, at least one a slot: round robin, or by hash of ``keys``.

    Small inputs stored as one file with one row group are read by a single task, and large ones by few, which then also
    run every per-row step before the first shuffle (JSON parsing, label decoding). With the number of tasks taken from
    the row count (read from the file footers) a task does not grow with the table. Round robin is a no-op where the
    scan has enough splits; with ``keys``, steps that group by them need no further shuffle of their wider rows.
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    if keys:
        return df.repartition(wanted, *keys)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


# broadcast only what is proven small: at most this many rows (checked, not assumed)
BROADCAST_MAX_ROWS = 200_000


def small(df, max_rows: int = BROADCAST_MAX_ROWS):
    """Broadcast ``df`` when it has at most ``max_rows`` rows, checked with a bounded count
    (``limit(max_rows + 1)`` stops early); otherwise return it unchanged, so the planner and AQE pick
    the join from measured sizes (a shuffle join beyond the bound)."""
    from pyspark.sql import functions as F
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
