"""Tables, the shared folder and small helpers of the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelarder import session

# Characters that separate words, as a character class of Java and RE2 expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one all executors share (see `session.shared_folder`).

    Only a session on one machine may name none; it then gets one temporary folder for all.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(session.SHARED, None)
    if not named and spark.sparkContext.master.startswith("local["):
        spark.conf.set(session.SHARED, tempfile.mkdtemp(prefix="shared-"))
    return session.shared_folder(spark, purpose)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage, fixes what a retry could number differently, and gives the planner
    the true size of the table.
    """
    return stored_at(df, shared_folder(df.sparkSession, purpose))


def stored_at(df: DataFrame, folder: str) -> DataFrame:
    """As `stored`, in a folder that the caller drops when it is done with the table."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores as make it differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """Mark a table of counted rows for broadcast when it is below the limit; else leave it alone."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def runs_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of consecutive rows with one key, from batches sorted by it.

    A run may span batches; what is held is one run and one batch.
    """
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if held and held_key != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, i - start))
            held_key = keys[start]
            if i < len(keys):
                yield pa.Table.from_batches(held)
                held = []
            start = i
    if held:
        yield pa.Table.from_batches(held)
