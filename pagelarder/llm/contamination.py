"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short and a document long, so their similarity is near zero and only containment
tells: the share of the item's shingles that the document has. A min-wise sample of the *item*
serves for that: a document that holds a share c of an item holds about that share of its sample.

Items are partitioned by the size of their shingle sets (by powers of two). All items of a
partition get the same number of MinHash samples, the k least hashes of the set, with
k = floor((1 - c) * largest size) + 1. A document that lacks at most a share 1 - c of the
shingles can't lack all k, so no contained item is missed, and small items need few samples.
Documents look up the hash of each of their shingles in the samples; the size of a document
rules out partitions whose items it is too short to hold. Pairs found are then verified on the
shingles themselves, as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelarder.llm.common import broadcast_if_small, let, same, stored

WORDS = 5


def words_of(text: Column) -> Column:
    r"""Words in lower case: runs of letters and digits."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(split, lambda w: w != "")


def _windows(words: Column, shingle) -> Column:
    """`shingle` of each position of an array of words that five words start at."""
    starts = F.when(F.size(words) >= WORDS, F.sequence(F.lit(0), F.size(words) - WORDS))
    return F.transform(starts, shingle)


def _hashes(text: Column) -> Column:
    """Distinct shingle hashes of a text; null for a text of fewer than five words."""
    words = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return let(
        words,
        lambda w: F.array_distinct(_windows(w, lambda i: F.xxhash64(*[w[i + k] for k in range(WORDS)]))),
    )


def _texts(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """key..., shingle: the shingles themselves, one row for each distinct one of a row."""
    shingles = let(
        words_of(F.col(text)),
        lambda w: F.array_distinct(_windows(w, lambda i: F.concat_ws(" ", F.slice(w, i + 1, WORDS)))),
    )
    return df.select(*key, F.explode(shingles).alias("shingle"))


def _item_sets(items: DataFrame) -> DataFrame:
    """item_id, n_item and the sorted shingle hashes; rows of one item_id are one item."""
    rows = items.where("item_id is not null").select("item_id", F.explode(_hashes(F.col("text"))).alias("hash"))
    rows = rows.distinct()
    return rows.groupBy("item_id").agg(F.sort_array(F.collect_list("hash")).alias("hashes"))


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """Pairs (doc_id, item_id, n_item, n_shared) of documents that hold at least `percent` % of
    the distinct five-word shingles of an item, anywhere and in any order.

    Words are runs of letters and digits in lower case. Items and documents of fewer than five
    words have no shingle and are in no pair. Of rows that share a doc_id the one that holds most
    counts, rows that share an item_id are one item; null ids and null texts are in no pair. One
    pair is one row.
    """
    sets = _item_sets(items)
    sized = sets.withColumn("n_item", F.size("hashes")).withColumn(
        "partition", F.floor(F.log2("n_item")).cast("int")
    )
    samples = F.floor(F.lit(100 - percent) * F.expr("shiftleft(2, partition) - 1") / 100).cast("int") + 1
    sampled = sized.select("item_id", "n_item", F.explode(F.slice("hashes", F.lit(1), samples)).alias("hash"))
    sampled = stored(sampled, "samples")
    sizes = sampled.select(F.count("*"), F.min("n_item")).first()
    least = -(-(sizes[1] or 0) * percent // 100)

    # A text too short to hold the smallest item has no hashes to look up.
    hashes = let(_hashes(F.col("text")), lambda h: F.when(F.size(h) >= least, h))
    hits = docs.where("doc_id is not null").select("doc_id", F.explode(hashes).alias("hash"))
    hits = hits.join(broadcast_if_small(sampled, sizes[0], 32), "hash")
    candidates = stored(hits.select("doc_id", "item_id").distinct(), "candidates")

    suspects = docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    held = _texts(suspects.withColumn("_row", F.xxhash64("text")).select("doc_id", "_row", "text"), ["doc_id", "_row"], "text")
    item_texts = stored(_texts(items, ["item_id"], "text").distinct(), "items")
    item_count = item_texts.count()
    counts = item_texts.groupBy("item_id").agg(F.count("*").alias("n_item"))
    shared = held.join(broadcast_if_small(item_texts, item_count, 128), "shingle")
    shared = shared.select("doc_id", "_row", "item_id", "shingle").distinct()
    shared = shared.groupBy("doc_id", "_row", "item_id").agg(F.count("*").alias("n_shared"))
    shared = shared.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"))
    shared = shared.join(candidates, ["doc_id", "item_id"])
    return (
        shared.join(counts, "item_id")
        .where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
        .select("doc_id", "item_id", "n_item", "n_shared")
    )


def without_contaminated(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of documents that hold no item; all columns are kept as they are."""
    bad = stored(contained_items(docs, items, percent).select(F.col("doc_id").alias("_bad")).distinct(), "bad")
    return docs.join(bad, same(docs["doc_id"], bad["_bad"]), "left_anti")
