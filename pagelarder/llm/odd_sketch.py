"""Near-duplicates: MinHash bands propose, odd sketches estimate, full shingle sets decide.

1. Every document gets 256 MinHash values. The first 128 make 32 bands of four. All of them are
   folded into a bitmap of parities, an odd sketch (Mitzenmacher, Pagh, Pham, 2014): the number
   of ones in the XOR of two bitmaps estimates how many values differ, best at high similarity.
   At a similarity of 0.85 no band agrees with a probability of 6e-11 (at 0.8: 5e-8).
2. Texts with the same words form one class, which has a number; only one of its texts goes on.
3. Every bucket of a band compares its members with one of them, its leader. Sketches drop
   false candidates and gather similar documents in loose clusters. Where some members of a
   bucket are unlike the leader, those and the ones not close to it are compared with each other
   in blocks of bounded size; a task returns a spanning forest and never the pairs.
4. Full shingle sets make the links, by exact intersection and union. First every document of
   a cluster meets the leader most like it, in stars of bounded size, so its set moves once.
   The links found join documents to components, and only members of different components of
   one cluster are compared further: their sketches meet in blocks of bounded rows and bytes,
   and the sets of those that are close to a member of another component follow.

So a cluster of n different texts that link to their leaders moves n sets and the leaders, and
one with a few stragglers moves them a second time. Where many members of a cluster are alike
but not linked, (n / SET_ROWS)^2 / 2 tasks compare sketches of 128 bytes; sets move only for
pairs that sketches can't rule out. No link is lost by sampling or caps.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelarder.llm import common, shingles
from pagelarder.llm.common import same, stored
from pagelarder.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(common)

HASHES, ROWS, BANDS, BITS, BLOCK = 256, 4, 32, 1024, 128
# Similarities, as sketches estimate them: members this like their leader share its cluster;
# below NEAR they are also compared with those that don't. The estimate is off by 0.02 to 0.03.
LOOSE, NEAR, MARGIN = 0.5, 0.78, 0.13
# A task on full sets takes about this many rows and shingles (16 MB) from each side.
SET_ROWS, SET_SHINGLES = 512, 1 << 21

_random = np.random.default_rng(20140407)
_A = _random.integers(0, 1 << 31, HASHES, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_B = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]


def minhashes(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set of 64-bit hashes."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        values = short[at : at + 1024] * _A
        values += _B
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        key = shingles.mix(key * np.uint64(0x100000001B3) + row)
    return key.view(np.int64)


def odd_sketch(least: np.ndarray) -> bytes:
    at = shingles.mix((np.arange(HASHES, dtype=np.uint64) << np.uint64(32)) | least) % np.uint64(BITS)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def estimate(differing: np.ndarray) -> np.ndarray:
    """Similarity from the number of ones in the XOR of two sketches."""
    share = np.minimum(2.0 * differing / BITS, 0.999)
    return 1 + BITS / (4.0 * HASHES) * np.log1p(-share)


def _bitmaps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


SIGNED = "doc_id long, hash long, n_shingles long, words binary, bands array<long>, sketch binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            counts, digests, bands, sketches = [], [], [], []
            for text in part.column(1):
                words = shingles.word_hashes(text.as_py())
                found = shingles.shingle_set(words)
                counts.append(len(found))
                if len(found):
                    least = minhashes(found)
                    digests.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(least))
                    sketches.append(odd_sketch(least))
                else:
                    digests.append(None)
                    bands.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "hash", "n_shingles", "words", "bands", "sketch"],
            )


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            bits = _bitmaps(batch.column(2)) ^ _bitmaps(batch.column(3))
            value = estimate(np.bitwise_count(bits).sum(axis=1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value, pa.float64())],
                names=["id", "leader", "est"],
            )


def _forest(joined: list[int], pairs: Iterator[tuple[int, int]], linked) -> list[tuple[int, int]]:
    """Links that join what is not joined yet; rows with one number in `joined` are from the start."""
    first: dict[int, int] = {}
    root = [first.setdefault(x, i) for i, x in enumerate(joined)]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b and linked(i, j):
            root[b] = a
            edges.append((i, j))
    return edges


def _close_pairs(
    block: np.ndarray, joined: np.ndarray, bits: np.ndarray, least: float
) -> Iterator[tuple[int, int]]:
    """Pairs of a task whose sketches are alike, the most alike first within a row.

    A task of two blocks has the pairs across them, a task of one block all of its pairs; rows
    that are joined already are no pair.
    """
    across = len(np.unique(block)) > 1
    for i in range(len(bits) - 1):
        est = estimate(np.bitwise_count(bits[i] ^ bits[i + 1 :]).sum(axis=1, dtype=np.int64))
        ok = (est >= least) & (joined[i + 1 :] != joined[i])
        if across:
            ok &= block[i + 1 :] != block[i]
        at = np.flatnonzero(ok)
        for j in at[np.argsort(-est[at], kind="stable")]:
            yield i, i + 1 + int(j)


def _task_pairs(task: pa.Table, least: float) -> tuple[list[int], Iterator[tuple[int, int]]]:
    name = "joined" if "joined" in task.column_names else "id"
    joined = np.array(task.column(name).to_pylist())
    bits = _bitmaps(task.column("sketch").combine_chunks())
    return joined.tolist(), _close_pairs(np.array(task.column("block").to_pylist()), joined, bits, least)


def _close(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows of each task whose sketch is close to that of a row joined with others."""
    for task in common.runs_of(batches, "task"):
        found: set[int] = set()
        for pair in _task_pairs(task, least)[1]:
            found.update(pair)
        if found:
            rows = task.select(["id", "joined", "block", "task"]).take(pa.array(sorted(found)))
            yield from rows.combine_chunks().to_batches()


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each task and id, of batches sorted by these: rows of a table can be repeated."""
    last = np.zeros((2, 0), np.int64)
    for batch in batches:
        keys = np.array([batch.column(c).to_numpy() for c in ("task", "id")])
        before = np.concatenate([last, keys], axis=1)[:, -batch.num_rows - 1 : -1]
        new = np.ones(batch.num_rows, bool)
        new[batch.num_rows - before.shape[1] :] = (before != keys[:, batch.num_rows - before.shape[1] :]).any(axis=0)
        if batch.num_rows:
            last = keys[:, -1:]
            yield batch.filter(pa.array(new))


def _edges(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Forest of each task's links: by full sets where there are some, else by sketches."""
    found: list[tuple[int, int]] = []

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())],
            names=["a", "b"],
        )
        found.clear()
        return out

    for task in common.runs_of(_once(batches), "task"):
        ids = task.column("id").to_pylist()
        if len(ids) < 2:
            continue
        sets = None
        if "members" in task.column_names:
            sets = [np.frombuffer(x, np.uint64) for x in task.column("members").to_pylist()]

        def linked(i: int, j: int, sets=sets) -> bool:
            if sets is None:
                return True
            a, b = sets[i], sets[j]
            if 100 * min(len(a), len(b)) < similarity * max(len(a), len(b)):
                return False
            shared = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
            return 100 * shared >= similarity * (len(a) + len(b) - shared)

        joined, pairs = _task_pairs(task, similarity / 100 - MARGIN)
        found += [(ids[i], ids[j]) for i, j in _forest(joined, pairs, linked)]
        if len(found) > 10_000:
            yield batch()
    if found:
        yield batch()


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, a text, by its full shingle set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [
                shingles.shingle_set(shingles.word_hashes(t.as_py())).tobytes()
                for t in part.column(part.num_columns - 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(sets, pa.binary())], names=[*part.schema.names[:-1], "members"]
            )


def _in_blocks(members: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """Add `block` and `task`: each pair of blocks of a group is one task of at most ~2 BLOCK rows."""
    n = F.ceil(F.col("size") / BLOCK).cast("long")
    placed = members.join(sizes, group).withColumn("n", n).withColumn("block", F.expr("pmod(xxhash64(id), n)"))
    return (
        placed.withColumn("other", F.explode(F.expr("sequence(0L, n - 1)")))
        .withColumn("task", F.xxhash64(group, F.least("block", "other"), F.greatest("block", "other")))
        .drop("other", "n", "size", group)
    )


def _parts(rows: str, shingles: str) -> Column:
    return F.ceil(F.greatest(F.col(rows) / SET_ROWS, F.col(shingles) / SET_SHINGLES)).cast("long")


def _star_tasks(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, joined, block, task) of stars: a leader in block 0, those most like it in block 1.

    `pairs` (id, leader, est), `counts` (id, n_shingles). A leader's followers are dealt over
    as many tasks as their rows and shingles need; the leader is in each of these.
    """
    best = pairs.groupBy("id").agg(F.max(F.struct("est", (-F.col("leader")).alias("to"))).alias("best"))
    best = best.select("id", (-F.col("best.to")).alias("leader")).join(counts, "id")
    sizes = best.groupBy("leader").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("shingles"))
    sizes = sizes.select("leader", _parts("rows", "shingles").alias("n"))
    placed = best.join(sizes, "leader").withColumn("task", F.expr("xxhash64(leader, pmod(xxhash64(id), n))"))
    followers = placed.select("id", F.lit(1).alias("block"), "task")
    leaders = placed.select(F.col("leader").alias("id"), F.lit(0).alias("block"), "task").distinct()
    tasks = followers.unionByName(leaders)
    return tasks.select("id", F.col("id").alias("joined"), "block", "task")


def _cross_tasks(members: DataFrame) -> DataFrame:
    """(id, joined, block, task) that bring members of different components of a cluster together.

    `members` (id, cluster, joined, n_shingles), joined being the component so far. A large
    component has blocks of its own, which never meet each other; small ones share blocks. A
    cluster that is one component has no task.
    """
    groups = members.groupBy("cluster", "joined").agg(
        F.count("*").alias("rows"), F.sum("n_shingles").alias("shingles")
    )
    mixed = groups.groupBy("cluster").agg(F.count("*").alias("k")).where("k > 1").select("cluster")
    large = (F.col("rows") * 4 >= SET_ROWS) | (F.col("shingles") * 4 >= SET_SHINGLES)
    groups = groups.join(mixed, "cluster").withColumn("owner", F.when(large, F.col("joined")))
    groups = stored(groups.withColumn("n", _parts("rows", "shingles")), "groups")
    shared = groups.where("owner IS NULL").groupBy("cluster").agg(
        F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles")
    )
    shared = shared.select("cluster", _parts("rows", "shingles").alias("shared"))
    groups = groups.select("cluster", "joined", "owner", "n").join(shared, "cluster", "left")
    block = F.expr(
        "if(owner IS NULL, xxhash64(cluster, pmod(xxhash64(joined), shared)),"
        " xxhash64(cluster, owner, pmod(xxhash64(id), n)))"
    )
    placed = members.join(groups, ["cluster", "joined"]).select(
        "id", "joined", "cluster", "owner", block.alias("block")
    )
    placed = stored(placed, "placed")
    blocks = stored(placed.select("cluster", "owner", "block").distinct(), "blocks")
    others = blocks.select("cluster", F.col("owner").alias("owner2"), F.col("block").alias("block2"))
    met = blocks.join(others, "cluster").where("block <= block2 AND (owner IS NULL OR NOT owner <=> owner2)")
    met = met.select(
        "cluster", F.xxhash64("cluster", "block", "block2").alias("task"),
        F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"),
    )
    return placed.drop("owner").join(met, ["cluster", "block"]).select("id", "joined", "block", "task")


def _linked(members: DataFrame, similarity: int) -> DataFrame:
    return (
        members.repartition("task").sortWithinPartitions("task", "id")
        .mapInArrow(lambda batches: _edges(batches, similarity), "a long, b long")
    )


def _shared_ids(spoken: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of the rows of one doc_id. Few ids have more than one."""
    of = classes.select(F.col("words").alias("of"), "id")
    rows = spoken.select("doc_id", "words").distinct()
    several = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(several, "doc_id").join(of, F.col("words") == F.col("of")).select("doc_id", "id")
    first = rows.groupBy("doc_id").agg(F.min("id").alias("a"))
    return rows.join(first, "doc_id").where("id > a").select("a", F.col("id").alias("b"))


def near_duplicates(docs: DataFrame, similarity: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A & B| >= similarity * |A | B| for their sets of five-word
    shingles (words between white space, A-Z in lower case; a shorter text is one shingle). A
    document without words is linked with nothing. component_id is the least doc_id reachable.

    Rows that share a doc_id are one document: they carry the links of each of them, and stay or
    go together. Rows with a null doc_id are linked with nothing and kept, with a null component.
    """
    signed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).mapInArrow(_sign, SIGNED)
    signed = stored(signed, "signed")
    spoken = signed.where("n_shingles > 0 and doc_id is not null")
    # A class is told by its words; rows of one doc_id with different words are in several.
    classes = spoken.groupBy("words").agg(F.min("doc_id").alias("rep"))
    # Numbers grow with the least doc_id, so that the first document of a bucket leads it: the
    # one that others were copied from is nearer to them than they are to each other.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = classes.repartitionByRange(parts, "rep", "words").sortWithinPartitions("rep", "words")
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    known = classes.withColumnRenamed("words", "of")
    firsts = spoken.join(known, (spoken.words == known["of"]) & (spoken.doc_id == known.rep))
    # Rows of a class with one doc_id differ in white space only; one of them gives the text.
    firsts = stored(firsts.select("id", "rep", "hash", "n_shingles", "bands", "sketch"), "firsts")
    one = firsts.groupBy("id", "rep").agg(F.min("hash").alias("hash"))
    firsts = stored(firsts.join(one, ["id", "rep", "hash"]).dropDuplicates(["id"]), "firsts")

    rows = firsts.select("id", F.explode("bands").alias("key"))
    leaders = rows.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    rows = stored(rows.join(leaders.drop("n"), "key").where("id > leader"), "buckets")
    sketches = firsts.select("id", "sketch")
    pairs = (
        rows.select("id", "leader").distinct()
        .join(sketches, "id")
        .join(sketches.select(F.col("id").alias("leader"), F.col("sketch").alias("other")), "leader")
        .select("id", "leader", "sketch", "other")
    )
    pairs = stored(pairs.mapInArrow(_estimates, "id long, leader long, est double"), "pairs")

    # Buckets in which some members are unlike the leader: those members among each other.
    far = rows.join(pairs.where(F.col("est") < NEAR), ["id", "leader"]).select("key", "id", "est")
    mixed = far.groupBy("key").agg(F.count("*").alias("size"), F.min("est").alias("least"))
    mixed = mixed.where((F.col("size") > 1) & (F.col("least") < LOOSE)).drop("least")
    rest = _in_blocks(far.select("key", "id"), "key", mixed).join(sketches, "id")
    loose = pairs.where(F.col("est") >= LOOSE).select(F.col("id").alias("a"), F.col("leader").alias("b"))
    clusters = stored(components(loose.unionByName(_linked(rest, similarity))), "clusters")

    counts = firsts.select("id", "n_shingles")
    members = clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    texts = docs.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("hash"), "text")
    sets = members.join(firsts.drop("bands"), "id").join(texts, ["rep", "hash"]).select("id", "sketch", "text")
    sets = stored(sets.mapInArrow(_shingle_sets, "id long, sketch binary, members binary"), "sets")

    close = similarity / 100 - MARGIN
    stars = _star_tasks(pairs.where(F.col("est") >= close), counts)
    links = stored(_linked(stars.join(sets, "id"), similarity), "links")
    known = components(links).withColumnRenamed("component", "joined")
    joined = members.join(known, members.id == known.node, "left")
    joined = joined.select("id", "cluster", F.coalesce("joined", "id").alias("joined")).join(counts, "id")
    cross = _cross_tasks(stored(joined, "joined")).join(sketches, "id")
    cross = cross.repartition("task").sortWithinPartitions("task", "id").mapInArrow(
        lambda batches: _close(batches, close), "id long, joined long, block long, task long"
    )
    across = _linked(cross.join(sets, "id"), similarity)
    links = links.unionByName(across)
    found = stored(components(links.unionByName(_shared_ids(spoken, classes))), "components")

    # A component has the least doc_id of its classes.
    named = classes.join(found, classes.id == found.node, "left")
    named = stored(named.select("words", "rep", F.coalesce("component", "id").alias("group")), "named")
    least = named.groupBy("group").agg(F.min("rep").alias("component"))
    named = named.join(least, "group").select(F.col("words").alias("of"), "component")
    known = signed.select("doc_id", "n_shingles", "words")
    result = known.join(named, known.words == named["of"], "left")
    # Rows without words are linked with nothing.
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        same(F.col("doc_id"), component).alias("kept"),
    )
