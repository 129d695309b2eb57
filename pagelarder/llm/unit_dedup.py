"""Substring dedup by hashing units: paragraphs, lines, and sentences within lines.

A paragraph is a stretch of lines that are not blank. Each unit of five or more words is normalised
(lower case, one space between words) and hashed to 128 bits; the digests are grouped over all
documents, the occurrence with the least (doc_id, start) stays and later ones are marked. Five words
are the least that do not repeat by chance in prose; shorter lines go only as part of a paragraph.

Marked paragraphs and lines are removed with their line feed. Sentences are an addition, for passages
that were set into another paragraph: consecutive marked sentences make a span, which is removed if it
has `least_words` words; sentences of under five words neither count nor interrupt. What is removed
keeps its offsets in the original text, in code points. An earlier copy of each removed unit is either
kept or itself covered by copies that are earlier still, so one of each stays.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelarder.llm.common import same, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A sentence ends at its last full stop or mark before white space, or at the end of the line.
_UNIT = re.compile(r"[^\n.!?。！？]+(?:[.!?。！？]+(?!\s|$)[^\n.!?。！？]*)*[.!?。！？]*|[.!?。！？]+")
UNIT_WORDS = 5
_LINE = re.compile(r"[^\n]*\n|[^\n]+")
_UNITS = "doc_id long, n long, place int, start int, stop int, words int, whole boolean, digest binary"
_TYPES = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.bool_(), pa.binary()]
_NAMES = [column.split()[0] for column in _UNITS.split(", ")]


def _digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def _sentences(text: str, start: int, stop: int) -> Iterator[tuple[int, int, list[str]]]:
    """start, stop and words of the sentences of enough words in a line."""
    for match in _UNIT.finditer(text, start, stop):
        words = match[0].lower().split()
        if len(words) >= UNIT_WORDS:
            lead = len(match[0]) - len(match[0].lstrip())
            yield match.start() + lead, match.start() + len(match[0].rstrip()), words


def units(text: str | None) -> Iterator[tuple[int | None, int, int, int, bool, bytes]]:
    """place, start, stop, number of words, whole and digest of every unit of enough words.

    `place` numbers sentences; `whole` marks lines and paragraphs. A line of one sentence is both.
    """
    text, place = text or "", 0
    open_at, open_to, open_words, open_lines = 0, 0, [], 0
    for line in [*_LINE.finditer(text), None]:
        words = line[0].lower().split() if line else []
        if not words:
            if open_lines > 1 and len(open_words) >= UNIT_WORDS:
                yield None, open_at, open_to, len(open_words), True, _digest(open_words)
            open_words, open_lines = [], 0
            continue
        open_at = open_at if open_lines else line.start()
        open_to, open_lines = line.end(), open_lines + 1
        open_words.extend(words)
        if len(words) < UNIT_WORDS:
            continue
        found = list(_sentences(text, line.start(), line.end()))
        single = len(found) == 1 and found[0][2] == words
        yield place if single else None, line.start(), line.end(), len(words), True, _digest(words)
        for start, stop, inner in [] if single else found:
            yield place, start, stop, len(inner), False, _digest(inner)
            place += 1
        place += single


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of each row. `n` tells apart rows of one doc_id with different texts."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=_NAMES)

    for batch in batches:
        rows: list[tuple] = []
        for doc_id, n, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            key = doc_id.as_py(), n.as_py()
            for unit in units(text.as_py()):
                rows.append((*key, *unit))
                if len(rows) >= 20_000:
                    yield packed(rows)
                    rows = []
        if rows:
            yield packed(rows)


def repeated_spans(docs: DataFrame, least_words: int = 25) -> DataFrame:
    """doc_id, n, start, stop, keep_doc_id: maximal stretches that repeat earlier units.

    `n` is a hash of the text. Rows equal in doc_id and text are one document here; a null
    doc_id ranks last. keep_doc_id is the document where the first unit of the stretch first stands.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("n"), "text")
    found = rows.mapInArrow(_units, _UNITS)
    found = stored(found, "units")
    # min over a number is a hash aggregate, which combines a hot digest before the shuffle.
    rank = F.expr(
        "coalesce(cast(doc_id as decimal(38,0)), cast(9223372036854775807 as decimal(38,0))) * 4294967296 + start"
    ).cast("decimal(38,0)")
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.min_by("n", rank).alias("first_n"),
                                        F.min("doc_id").alias("keep_doc_id"), F.count("*").alias("size"))
    first = first.where("size > 1").drop("size").withColumnRenamed("digest", "d")
    later = found.join(first, found.digest == F.col("d")).where(
        (rank > F.col("first")) | (F.col("n") != F.col("first_n"))
    )
    later = later.groupBy("doc_id", "n", "start", "stop").agg(
        F.min("place").alias("place"), F.min("words").alias("words"), F.max("whole").alias("whole"),
        F.min("keep_doc_id").alias("keep_doc_id"),
    )
    # Consecutive places make a run; a sentence of a run that counts reaches to the next one.
    places = Window.partitionBy("doc_id", "n").orderBy(F.col("place").asc_nulls_last())
    later = later.withColumn("run", F.col("place") - F.row_number().over(places))
    run = Window.partitionBy("doc_id", "n", "run")
    counts = F.col("place").isNotNull() & (F.sum("words").over(run) >= least_words)
    reach = F.greatest("stop", F.when(counts, F.lead("start").over(run.orderBy("place"))))
    marked = later.select("*", counts.alias("counts"), reach.alias("to")).where("whole or counts")
    # Marked units that overlap or touch make one stretch.
    order = Window.partitionBy("doc_id", "n").orderBy("start", F.desc("stop"))
    before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = marked.withColumn("opens", (F.coalesce(before, F.lit(-1)) < F.col("start")).cast("int"))
    marked = marked.withColumn("stretch", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("doc_id", "n", "stretch").agg(
        F.min("start").alias("start"), F.max("to").alias("stop"),
        F.min_by("keep_doc_id", "start").alias("keep_doc_id"),
    ).drop("stretch")


_SPAN = "array<struct<start:int,stop:int,keep_doc_id:bigint>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last two columns, text and spans, by the text that stays and the spans."""
    for batch in batches:
        texts = []
        for text, spans in zip(*(batch.column(batch.num_columns - k) for k in (2, 1)), strict=True):
            whole, at, kept = text.as_py(), 0, []
            if whole is None:
                texts.append(None)
                continue
            for span in spans.as_py():
                kept.append(whole[at : span["start"]])
                at = span["stop"]
            kept.append(whole[at:])
            texts.append("".join(kept))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(texts, pa.string()), batch.columns[-1]], names=batch.schema.names
        )


def without_repeats(docs: DataFrame, least_words: int = 25) -> DataFrame:
    """A row per document: doc_id, keep_doc_ids, text, removed.

    `text` is what stays, `removed` lists start, stop (code points of the original text) and the
    document that keeps the passage; both lists are empty where nothing repeats. Null and empty
    texts have no units and stay as they are. Of equal rows each gets its row, with equal results.
    """
    spans = repeated_spans(docs, least_words)
    spans = spans.groupBy("doc_id", "n").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "keep_doc_id"))).alias("removed")
    )
    spans = stored(spans.select(F.col("doc_id").alias("d"), F.col("n").alias("m"), "removed"), "spans")
    rows = docs.select("doc_id", "text").withColumn("n", F.xxhash64("text"))
    rows = rows.join(spans, same(rows.doc_id, spans.d) & (rows.n == spans.m), "left")
    removed = F.coalesce("removed", F.array().cast(_SPAN))
    rows = rows.select("doc_id", "text", removed.alias("removed"))
    keepers = F.array_sort(F.array_distinct(F.transform("removed", lambda s: s.keep_doc_id)))
    rows = rows.select("doc_id", keepers.alias("keep_doc_ids"), "text", "removed")
    return rows.mapInArrow(_cut, f"doc_id long, keep_doc_ids array<bigint>, text string, removed {_SPAN}")
