"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.pagelarder.shared.dir"

# Pages are large and grow when shredded: small scan splits and small Arrow batches keep the
# working set of a task low. Adaptive execution picks join strategies and splits skewed keys
# from measured sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.files.maxPartitionBytes": "64m",
    # Bodies are joined to narrow id tables: build a hash table of the ids where the planner
    # finds it small enough, rather than sort the bodies.
    "spark.sql.join.preferSortMergeJoin": "false",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every expression doubles the time to build one.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "pagelarder", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings above; `settings` use "__" in place of "."."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def partitions_for(moved_bytes: int, cores: int, target: int = 128 << 20) -> int:
    """Shuffle partitions that keep what one task receives near the target size.

    Count the bytes that move: keys and links for a bucketed snapshot, bodies otherwise.
    """
    return max(cores, -(-moved_bytes // target))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, of known size."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query as soon as it ends.

    Spark keeps them until the driver collects its garbage, so a run of many queries that move
    bodies would hold the files of all. A DataFrame must be executed once only in here.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the folder that all executors share.

    spark.checkpoint.dir names it, or spark.pagelarder.shared.dir where the former is unset,
    which a running session can still set. There is no fallback.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED, None)
    if not root:
        raise ValueError(f"set spark.checkpoint.dir or {SHARED} to a folder all executors can reach")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system; one that does not exist is fine."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
