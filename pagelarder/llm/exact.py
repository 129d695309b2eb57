"""Exact duplicates by distributed MSD radix partitioning.

A round splits every open group by the next bytes of its texts, a digit. A digit that one
document alone has ends that document; a group whose texts end with the digit is a group of
equal texts. What is left goes on with the next digit. Digits are 64 bytes wide in the first
round and 16 times as wide in each later one, so a text of n bytes takes log16(n) rounds and
bytes are moved only as far as texts agree (once for the first round). Equality is decided by
the bytes themselves; the SHA-256 is reported but not compared.

The digits of a group are counted by a hash aggregate, which combines copies before the shuffle,
and joined back on a side that is unique, which adaptive execution can split: thousands of
copies never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelarder.llm.common import same, stored

FIRST_WIDTH, GROWTH = 64, 16


def exact_duplicates(docs: DataFrame) -> DataFrame:
    r"""One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without the characters [\x20\x09-\x0D]; null is empty.
    Of a group the row with the most code points of original text stays, then the smallest
    doc_id, null last. Of repeated rows with that doc_id exactly one stays. An empty table gives
    an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    base = docs.select("doc_id", F.length(text).cast("long").alias("n"), plain.alias("plain"))
    base = base.withColumn("sha", F.sha2(F.col("plain"), 256))
    # One number orders the rows of a group, and names it: length, then doc_id downwards, then
    # bits of the digest, which tell rows of one doc_id with different texts apart.
    rank = F.expr(
        "cast(n as decimal(38,0)) * 39614081257132168796771975168 + "  # 2^95
        "cast(-coalesce(cast(doc_id as decimal(38,0)), cast(9223372036854775807 as decimal(38,0)))"
        " as decimal(38,0)) * 1073741824 + cast(conv(substr(sha, 1, 7), 16, 10) as decimal(38,0))"
    ).cast("decimal(38,0)")
    open_rows = base.select(
        "doc_id", "sha", rank.alias("rank"), F.lit(None).cast("decimal(38,0)").alias("name"),
        F.col("plain").cast("binary").alias("rest"),
    )
    done, width = [], FIRST_WIDTH
    while True:
        split = stored(_split(open_rows, width), "radix")
        done.append(split.where("state <> 'open'").drop("rest", "rank", "state"))
        open_rows = split.where("state = 'open'").select("doc_id", "sha", "rank", "name", "rest")
        if open_rows.isEmpty():
            break
        width *= GROWTH
    rows = done[0]
    for part in done[1:]:
        rows = rows.unionByName(part)
    return _with_kept(rows)


def _split(rows: DataFrame, width: int) -> DataFrame:
    """Split open groups by their next `width` bytes."""
    rows = rows.withColumns({
        "digit": F.expr(f"substring(rest, 1, {width})"),
        "ended": F.expr(f"octet_length(rest) <= {width}"),
    })
    key = ["name", "digit", "ended"]
    groups = rows.groupBy(*key).agg(
        F.count("*").alias("size"), F.max("rank").alias("best"), F.max_by("doc_id", "rank").alias("best_id")
    ).where("size > 1")
    groups = groups.select(*[F.col(c).alias(f"g_{c}") for c in groups.columns])
    match = same(rows["name"], groups.g_name) & (rows.digit == groups.g_digit) & (rows.ended == groups.g_ended)
    state = F.when(F.col("g_size").isNull(), "single").when(F.col("ended"), "equal").otherwise("open")
    return rows.join(groups, match, "left").select(
        "doc_id", "sha", "rank",
        F.col("g_best").alias("name"),
        F.when(F.col("g_size").isNull(), F.col("doc_id")).otherwise(F.col("g_best_id")).alias("keep_id"),
        F.coalesce("g_size", F.lit(1)).cast("long").alias("group_size"),
        state.alias("state"),
        F.when(state == "open", F.expr(f"substring(rest, {width + 1})")).alias("rest"),
    )


def _with_kept(rows: DataFrame) -> DataFrame:
    """Mark one row of each group. Rows that could stay are counted, and one of them is marked."""
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    rows = rows.select("doc_id", "keep_id", "group_size", F.col("sha").alias("text_sha256"))
    best = same(F.col("doc_id"), F.col("keep_id"))
    single = rows.where("group_size = 1").withColumn("kept", F.lit(True))
    others = rows.where((F.col("group_size") > 1) & ~best).withColumn("kept", F.lit(False))
    first = (
        rows.where((F.col("group_size") > 1) & best).groupBy(*columns).count()
        .select(*columns, F.explode(F.expr("sequence(1L, `count`)")).alias("nth"))
        .select(*columns, (F.col("nth") == 1).alias("kept"))
    )
    return single.unionByName(others).unionByName(first).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
