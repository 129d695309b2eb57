"""Contiguous shards of near equal size, from global prefix sums.

Rows are put in order over range partitions, which numbers them within their partition. The
totals of the partitions, a row for each, are summed up to give every partition the bytes and
rows before it; that sum is itself made in two levels, so no task reads a row of every partition
at 100,000 of them. A running sum within a partition then gives each row its place among all
bytes, and the row goes to the shard in whose equal share of the bytes its middle lies. So a
shard differs from its share by half a row at either end, whatever the order or skew.

Built-in functions only. What a task holds is a range partition; rows equal in the whole order
are told apart by a running number, so many copies of one row are split over partitions too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelarder.llm.common import broadcast_if_small, stored

SHARDS = 16
_BLOCK = 1024


def utf8_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def utf8_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _in_order(rows: DataFrame, size: Column, order: list[Column]) -> DataFrame:
    """row (all columns), size and place: the range partition and, in the lower 33 bits, the row in it."""
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    keyed = rows.select(F.struct("*").alias("row"), size.cast("long").alias("size"), *keys)
    keyed = keyed.withColumn("tie", F.monotonically_increasing_id())
    by = [F.col(f"k{i}").asc_nulls_last() for i in range(len(keys))] + [F.col("tie")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = keyed.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return stored(sorted_rows.select("row", "size", F.monotonically_increasing_id().alias("place")), "ordered")


def _before(totals: DataFrame) -> DataFrame:
    """part, bytes_before, rows_before: sums over all earlier range partitions."""
    totals = totals.withColumn("block", F.floor(F.col("part") / _BLOCK))
    blocks = totals.groupBy("block").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    over_blocks = Window.orderBy("block")  # a row for 1,024 partitions
    blocks = blocks.select(
        "block",
        (F.sum("bytes").over(over_blocks) - F.col("bytes")).alias("block_bytes"),
        (F.sum("rows").over(over_blocks) - F.col("rows")).alias("block_rows"),
    )
    inside = Window.partitionBy("block").orderBy("part")
    return totals.join(blocks, "block").select(
        "part",
        (F.col("block_bytes") + F.sum("bytes").over(inside) - F.col("bytes")).alias("bytes_before"),
        (F.col("block_rows") + F.sum("rows").over(inside) - F.col("rows")).alias("rows_before"),
    )


def contiguous_shards(rows: DataFrame, size: Column, order: list[Column], shards: int = SHARDS) -> DataFrame:
    """All rows with `shard` (0 to shards - 1) and `slot` (from 0 without gaps within the shard).

    Shards are consecutive stretches of the rows in `order` (ascending, null last); sizes are
    whole numbers of 1 or more. Each shard's sum is within one row's size of an equal share; with
    fewer rows than shards some shards have no row. Rows equal in the whole order stand in any
    order among themselves. All columns of `rows` are kept, but one named shard or slot is
    replaced. An empty table gives an empty result. `rows` should be a stored table or a scan.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    columns = [c for c in rows.columns if c not in ("shard", "slot")]
    ordered = _in_order(rows.select(*[F.col(f"`{c}`") for c in columns]), size, order)
    part, at = F.shiftright("place", 33), F.expr("place & 8589934591")
    totals = ordered.groupBy(part.alias("part")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = stored(_before(stored(totals, "totals")), "before")
    parts, everything = before.count(), ordered.agg(F.sum("size")).first()[0] or 1
    running = F.sum("size").over(Window.partitionBy("part").orderBy("place"))
    numbered = ordered.withColumn("part", part).withColumn("up_to", running)
    numbered = numbered.join(broadcast_if_small(before, parts, 40), "part").select(
        "row",
        # The middle of the row lies at before + size / 2 of all bytes.
        F.expr(f"cast((2 * (bytes_before + up_to) - size) * {shards}L div (2L * {everything}L) as int)").alias("shard"),
        (F.col("rows_before") + at).alias("nth"),
    )
    starts = numbered.groupBy("shard").agg(F.min("nth").alias("start"))  # a row for each shard
    starts = stored(starts, "starts")
    numbered = numbered.join(broadcast_if_small(starts, shards, 32), "shard")
    slot = (F.col("nth") - F.col("start")).alias("slot")
    return numbered.select(*[F.col("row")[c].alias(c) for c in columns], "shard", slot)


def _document_order(docs: DataFrame) -> tuple[Column, list[Column]]:
    """Size of a document, and the order by doc_id, then size and digests of the text."""
    text = docs["text"]
    return utf8_size(text), [docs["doc_id"], utf8_size(text), utf8_crc32(text), F.xxhash64(text)]


def document_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the bytes of the text in UTF-8 and one more (an end mark); a null text has none, and
    the crc32 of an empty one. The law is `bytes`: sizes of shards are nearly equal. Shards are
    consecutive in doc_id, null last; rows of one doc_id are ordered by size, then digests. Equal
    texts have no say in it, so a group of copies of any size can't overfill a shard. grown_shard is
    null, as this law does not keep rows in place when shards are added. Only narrow rows are moved.
    """
    text = F.col("text")
    # The digest and size are taken before the shuffle, so no text takes part in it.
    narrow = docs.select(
        "doc_id", utf8_size(text).alias("size"), utf8_crc32(text).alias("text_crc32"), F.xxhash64(text).alias("digest")
    )
    order = [F.col(c) for c in ("doc_id", "size", "text_crc32", "digest")]
    found = contiguous_shards(narrow, F.col("size"), order, shards)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> DataFrame:
    """Write whole documents as Parquet, a folder `shard=k` for each shard, files in slot order.

    Returns a row for each shard that has documents: shard, rows, bytes, first_doc_id and
    last_doc_id. Columns of `docs` are written as they are, with `slot`.
    """
    size, order = _document_order(docs)
    rows = contiguous_shards(docs, size, order, shards)
    by = [F.col("shard"), F.col("slot")]
    rows.repartitionByRange(*by).sortWithinPartitions(*by).write.partitionBy("shard").parquet(folder)
    written = docs.sparkSession.read.parquet(folder)
    return written.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum(utf8_size(F.col("text"))).alias("bytes"),
        F.min_by("doc_id", "slot").alias("first_doc_id"), F.max_by("doc_id", "slot").alias("last_doc_id"),
    )
