"""Line dedup: repeated runs of lines from a suffix array over line identifiers.

The suffixes of all documents' line sequences are sorted by prefix doubling (Manber, Myers,
1990): from the ranks of the first w lines of each suffix, the pairs (rank at i, rank at i + w)
sort the first 2w. A round counts the distinct pairs, sorts them over range partitions, and
numbers them in order. A pair that occurs once belongs to no repeated run, so its suffix leaves;
after the first round only repeated lines are left.

A window counts if it has `least_lines` lines or `least_words` words, so single lines, pairs and
windows of `least_lines` are looked at, and from there on doubling goes on until nothing repeats.
Each suffix is aligned with the first occurrence of its widest window that stands earlier too.
Windows inside an earlier window leave; touching windows of one alignment make a run. Every line
of a later copy of a run that counts is deleted, since each such run is covered by windows that
count. A run is cut in two only where the widest windows first stand in different places.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelarder.llm.common import SPACE, same, shared_folder, stored, stored_at
from pagelarder.session import drop_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEY = ["doc", "hash"]


def _lines(docs: DataFrame) -> DataFrame:
    """doc, hash, pos, words, digest: the lines that are not blank, in order, without outer white space."""
    trimmed = F.transform(
        F.split(F.col("text"), "\n"), lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    )
    rows = docs.select(
        F.col("doc_id").alias("doc"), F.xxhash64("text").alias("hash"),
        F.posexplode(F.filter(trimmed, lambda x: x != "")).alias("pos", "line"),
    )
    words = F.size(F.split("line", SPACE + "+")).cast("long")
    return rows.select(*_KEY, "pos", words.alias("words"), F.unhex(F.md5("line")).alias("line"))


def _ordered(pairs: DataFrame, order: list[str]) -> DataFrame:
    """Number distinct rows in order: `rank` grows with it, over range partitions."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pairs.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stored(rows.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def _doubled(ranks: DataFrame, shift: int, folder: str) -> DataFrame:
    """Sort suffixes by (rank at pos, rank at pos + shift); those of no repeated pair leave.

    The pairs are written to `folder`, which the caller drops when the ranks are stored.
    """
    none = F.lit(None).cast("long")
    here = ranks.select(*_KEY, "pos", F.col("rank").alias("r1"), none.alias("r2"), "words")
    there = ranks.select(*_KEY, (F.col("pos") - shift).alias("pos"), none, F.col("rank"), "words")
    both = here.union(there).groupBy(*_KEY, "pos").agg(
        F.max("r1").alias("r1"), F.max("r2").alias("r2"), F.sum("words").alias("words")
    )
    both = stored_at(both.where("r1 is not null and r2 is not null"), folder)
    pairs = both.groupBy("r1", "r2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return both.join(_ordered(pairs, ["r1", "r2"]), ["r1", "r2"]).select(*_KEY, "pos", "words", "rank")


def _later(ranks: DataFrame, width: int) -> DataFrame:
    """Suffixes whose first `width` lines stand earlier, with their first occurrence."""
    # A number that orders occurrences: doc_id, then the hash's upper bits, then the line.
    place = F.expr(
        "coalesce(cast(doc as decimal(38,0)), cast(9223372036854775807 as decimal(38,0))) * 18014398509481984"
        " + shiftrightunsigned(hash, 42) * 4294967296L + pos"
    ).cast("decimal(38,0)")
    least = ranks.groupBy("rank").agg(
        F.min(place).alias("place"), F.min_by("hash", place).alias("keep_hash"),
        F.min_by("doc", place).alias("keep_doc"), F.min_by("pos", place).alias("keep_pos"),
    )
    later = ranks.join(least, "rank").where(place > F.col("place"))
    return later.select(*_KEY, "pos", F.lit(width).alias("width"), "keep_doc", "keep_hash", "keep_pos")


def repeated_runs(docs: DataFrame, least_lines: int = 3, least_words: int = 50) -> DataFrame:
    """doc, hash, first_line, last_line, keep_doc, keep_line: runs of lines that repeat an earlier one.

    Runs have `least_lines` lines or `least_words` words (separated by white space). Lines are
    numbered from 0 without blank ones. `hash` tells apart rows of one doc_id with different
    texts; equal rows are one document. Documents are ranked by doc_id, null last.
    """
    lines = _lines(docs)
    lines = stored(lines.dropDuplicates([*_KEY, "pos"]), "lines")
    names = lines.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    ranks = lines.join(_ordered(names, ["line"]), "line").select(*_KEY, "pos", "words", "rank")
    width, found, spark = 1, None, docs.sparkSession
    folder = shared_folder(spark, "line-runs")
    while True:
        ranks = stored_at(ranks, f"{folder}/suffixes-{width}")
        # What the round before has left is read no more: its ranks, and the pairs made of them.
        drop_folder(spark, f"{folder}/pairs")
        if width > 1:
            drop_folder(spark, f"{folder}/suffixes-{before}")
        if found is not None and ranks.isEmpty():
            break
        # Windows of one rank have the same lines, hence the same number of words.
        counting = ranks if width >= least_lines else ranks.where(F.col("words") >= least_words)
        later = stored(_later(counting, width), "later")
        found = later if found is None else found.union(later)
        shift = min(width, least_lines - width) if width < least_lines else width
        ranks, before, width = _doubled(ranks, shift, f"{folder}/pairs"), width, width + shift
    widest = found.groupBy(*_KEY, "pos").agg(
        F.max_by(F.struct("width", "keep_doc", "keep_hash", "keep_pos"), "width").alias("w")
    ).select(*_KEY, "pos", (F.col("pos") + F.col("w.width")).alias("end"), "w.keep_doc", "w.keep_hash", "w.keep_pos")
    order = Window.partitionBy(*_KEY).orderBy("pos")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    aligned = widest.withColumn("reached", reached).where("reached is null or end > reached")
    aligned = aligned.withColumn("shift", F.col("pos") - F.col("keep_pos"))
    before = F.lag(F.struct("keep_doc", "keep_hash", "shift")).over(order)
    goes_on = same(before, F.struct("keep_doc", "keep_hash", "shift")) & (F.col("pos") <= F.col("reached"))
    run = F.sum((~F.coalesce(goes_on, F.lit(False))).cast("int")).over(order)
    return aligned.withColumn("run", run).groupBy(*_KEY, "run").agg(
        F.min("pos").alias("first_line"), (F.max("end") - 1).alias("last_line"),
        F.min_by("keep_doc", "pos").alias("keep_doc"), F.min("keep_pos").alias("keep_line"),
    ).drop("run")


_RUNS = "array<struct<first_line:int,last_line:int,keep_doc_id:bigint,keep_line:int,start:int,stop:int>>"


def without_lines(text: str, runs: list[dict]) -> tuple[str, list[dict], int]:
    """The text without the lines of the runs, the runs with offsets, and the number of lines gone.

    Blank lines between two lines of a run go with it; offsets are code points of the text.
    """
    spans, at = [], 0
    lines = text.split("\n")
    filled = []
    for i, line in enumerate(lines):
        if line.strip(" \t\n\x0b\x0c\r"):
            filled.append(i)
        spans.append((at, at + len(line)))
        at += len(line) + 1
    gone: set[int] = set()
    found, covered, done = [], 0, -1
    for run in runs:
        first, last = filled[run["first_line"]], filled[run["last_line"]]
        gone.update(range(first, last + 1))
        covered += max(0, run["last_line"] - max(done, run["first_line"] - 1))
        done = max(done, run["last_line"])
        found.append({**run, "start": spans[first][0], "stop": spans[last][1]})
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), found, covered


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_deleted", pa.int32()), ("text", pa.string()),
        ("runs", pa.list_(pa.struct([
            ("first_line", pa.int32()), ("last_line", pa.int32()), ("keep_doc_id", pa.int64()),
            ("keep_line", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
        ]))),
    ])
    for batch in batches:
        rows = []
        for doc_id, text, runs in zip(*(batch.column(i) for i in range(3)), strict=True):
            kept, found, deleted = text.as_py(), [], 0
            if runs.is_valid:
                kept, found, deleted = without_lines(kept, runs.as_py())
            rows.append({"doc_id": doc_id.as_py(), "n_deleted": deleted, "text": kept, "runs": found})
        yield pa.RecordBatch.from_pylist(rows, schema)


def without_repeated_lines(docs: DataFrame, least_lines: int = 3, least_words: int = 50) -> DataFrame:
    """One row per document: doc_id, n_deleted (lines that are not blank), text that stays, runs.

    A null text stays null and an empty one empty, without runs. Rows equal in doc_id and text
    are one document and get equal results; of different documents the least doc_id keeps a run.
    """
    runs = repeated_runs(docs, least_lines, least_words).groupBy(*_KEY).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("first_line").cast("int").alias("first_line"), F.col("last_line").cast("int").alias("last_line"),
            F.col("keep_doc").alias("keep_doc_id"), F.col("keep_line").cast("int").alias("keep_line"),
        ))).alias("runs")
    )
    runs = stored(runs, "runs")
    rows = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    # One shape of the join at every size: the runs grow with the documents.
    rows = rows.hint("merge").join(runs, same(rows.doc_id, runs.doc) & (rows.h == runs.hash), "left")
    rows = rows.select("doc_id", "text", "runs")
    return rows.mapInArrow(_rewrite, f"doc_id long, n_deleted int, text string, runs {_RUNS}")
