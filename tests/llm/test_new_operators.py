"""Periodic runs, contiguous shards and centroid clusters against plain versions of each."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pagelarder.llm import balanced, centroids, periodic
from pagelarder.llm.common import shared_folder
from tests.llm.test_operators import LONG, ODD_ROWS, frame, prose


def brute_runs(words, least=24, times=3):
    """Every period on its own: stretches of equal words q apart, unless a divisor explains them."""
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, times * q):
                smaller = (d for d in range(1, q) if all(words[k] == words[k + d] for k in range(i, i + n - d)))
                if next(smaller, None) is None:
                    found.append((i, n, q))
            i = max(j, i + 1)
    return sorted(found)


def periodic_words(r: random.Random, n: int) -> list[bytes]:
    words = [b"%d" % r.randrange(r.choice([1, 2, 3, 40])) for _ in range(n)]
    if n > 3 and r.random() < 0.8:
        a = r.randrange(n)
        p = 1 + (n - a) // (3 + r.randrange(8))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    if n > 30 and r.random() < 0.3:
        words[r.randrange(n)] = b"x"
    return words + words[-r.randint(1, 20) :] * r.choice([0, 3])


def test_runs_against_every_period():
    r = random.Random(1)
    for _ in range(600):
        words = periodic_words(r, r.randint(0, 130))
        assert periodic.runs(words) == brute_runs(words), words
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        found = {(s, e - s + 1, q) for (s, q), e in periodic.squares([number[w] for w in words]).items()}
        assert found == set(brute_runs(words, 2, 2)), words


def test_automaton_has_a_state_for_each_set_of_ends():
    words = [1, 2, 1, 2, 2, 1, 2, 1]
    automaton = periodic.Automaton(words)
    ends = Counter()
    for i in range(len(words)):
        for j in range(i, len(words)):
            piece = words[i : j + 1]
            ends[tuple(k for k in range(len(words)) if words[max(0, k + 1 - len(piece)) : k + 1] == piece)] = 1
    assert len(automaton.length) == len(ends) + 1
    assert [automaton.length[s] for s in automaton.ends] == list(range(1, len(words) + 1))


def test_long_runs_in_long_texts():
    r = random.Random(2)
    period = [b"%d" % r.randrange(9999) for _ in range(5000)]
    words = [b"%d" % r.randrange(9999) for _ in range(20_000)]
    text = words + period * 4 + words[:1] + [b"same"] * 30_000
    found = periodic.runs(text)
    assert (20_000, 20_000, 5000) in found and found[-1][1:] == (30_000, 1)
    assert len(periodic.collapsed(text, found)) == 20_000 + 5000 + 1 + 1


def expected_report(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    numbers = (best[0], best[1], best[2], best[1] * 1000 // best[2]) if best else (None,) * 4
    return doc_id, len(found), *numbers, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_periodic_query(spark):
    r = random.Random(4)
    rows = [x for x in ODD_ROWS if x[1] != LONG]
    rows += [(i, prose(i, r.choice([1, 5, 30, 200])), "a") for i in range(100, 300)]
    rows += [(i, "  " + " \n".join(w.decode() for w in periodic_words(r, 120)) + "\t", "a") for i in range(300, 360)]
    rows += [(400, " ".join("ab" * 40), "a"), (401, "é ö  " * 20, "a")]
    found = periodic.run_report(periodic.without_periodic_runs(periodic.repeating_tails(frame(spark, rows))))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                             "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, found.collect())) == Counter(expected_report(i, t) for i, t, _ in rows)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, t, _ in rows if i and t) > 10
    empty = periodic.run_report(periodic.without_periodic_runs(periodic.repeating_tails(frame(spark, []))))
    assert empty.isEmpty() and [t for _, t in empty.dtypes[:6]] == ["bigint"] * 6


def shard_rows():
    r = random.Random(6)
    rows = list(ODD_ROWS) + [(i, prose(i, r.randint(0, 60)), "a") for i in range(1000, 1400)]
    return rows + [(7777, "one and the same", "a")] * 300


def test_contiguous_shards(spark):
    rows = shard_rows()
    found = [tuple(x) for x in balanced.document_shards(frame(spark, rows)).collect()]
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter(x[:3] for x in found) == sizes
    assert all(x[3] == "bytes" and x[6] is None for x in found)
    order = sorted(found, key=lambda x: (math.inf if x[0] is None else x[0], x[1], x[2], x[4], x[5]))
    assert order == sorted(found, key=lambda x: (x[4], x[5]))
    share = sum(x[1] for x in found) / 16
    before = 0
    for shard in range(16):
        own = [x for x in order if x[4] == shard]
        assert [x[5] for x in own] == list(range(len(own)))
    for x in order:
        assert x[4] * share <= before + x[1] / 2 < (x[4] + 1) * share
        before += x[1]
    small = balanced.document_shards(frame(spark, [(i, "x" * 9, "a") for i in range(4)])).collect()
    assert sorted((x.doc_id, x.shard, x.slot) for x in small) == [(i, 2 + 4 * i, 0) for i in range(4)]
    assert balanced.document_shards(frame(spark, [])).isEmpty()


def test_shards_keep_columns(spark):
    docs = frame(spark, shard_rows()).withColumns({"shard": F.lit("s"), "slot": F.lit("t"), "row": F.lit(1),
                                                   "place": F.lit(2), "part": F.lit(3), "k0": F.lit(4)})
    found = balanced.contiguous_shards(docs, balanced.utf8_size(docs.text), [docs.doc_id, docs.text], 5)
    assert found.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert Counter(tuple(x)[:-2] for x in found.collect()) == Counter(map(tuple, docs.drop("shard", "slot").collect()))
    with pytest.raises(ValueError):
        balanced.contiguous_shards(docs, balanced.utf8_size(docs.text), [docs.doc_id], 0)


def test_many_parts_are_summed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(balanced, "_BLOCK", 3)
    totals = spark.createDataFrame([(i, 10 * i, i) for i in range(0, 40, 2)], "part long, bytes long, rows long")
    for x in balanced._before(totals).collect():
        assert x.rows_before == sum(range(0, x.part, 2)) and x.bytes_before == 10 * x.rows_before


def test_written_shards(spark):
    rows = shard_rows()
    folder = shared_folder(spark, "test-balanced")
    told = {x.shard: x for x in balanced.write_shards(frame(spark, rows), folder, 4).collect()}
    written = spark.read.parquet(folder).collect()
    assert Counter((x.doc_id, x.text) for x in written) == Counter((i, t) for i, t, _ in rows)
    plan = {(x.shard, x.slot): x for x in balanced.document_shards(frame(spark, rows), 4).collect()}
    assert {(x.shard, x.slot): x.doc_id for x in written} == {k: x.doc_id for k, x in plan.items()}
    for shard, x in told.items():
        own = [p for (s, _), p in plan.items() if s == shard]
        assert (x.rows, x.bytes) == (len(own), sum(p.size for p in own))


VECTORS = "vec_id long, embedding array<double>, label string, cluster int, d int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS).repartition(3)


def brute_clusters(rows, k, rounds, width):
    good = [(i, v) for i, v in rows if v is not None and len(v) == width
            and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in good]
    key = lambda x: (x[0] is None, hashlib.sha256(f"2:{x[0]}".encode()).hexdigest(), x[1])
    centres = [v for _, v in sorted(whole, key=key)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [min((far(v, c), n) for n, c in enumerate(centres)) for _, v in whole]

    for _ in range(rounds):
        near = assign()
        for n in range(len(centres)):
            own = [v for (_, v), x in zip(whole, near, strict=True) if x[1] == n]
            if own:
                centres[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    near = assign()
    inertia = Counter()
    for d, n in near:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, n, d, inertia[n], sum(inertia.values()), digest[n])
                   for (i, _), (d, n) in zip(whole, near, strict=True))


@pytest.mark.parametrize("spread", [0.004, 1.0, 5000.0])
def test_clusters_against_all_distances(spark, spread):
    """Few distinct components make ties; large ones go beyond what doubles add up exactly."""
    r = random.Random(9)
    rows = [(i, [r.gauss(0, spread) for _ in range(4)]) for i in range(250)]
    rows += [(300, [0.0] * 4)] * 80 + [(300, [0.5, -0.5, 0.25, 1e-9])] * 3 + [(None, [1.0] * 4)] * 2
    rows += [(401, None), (402, []), (403, [1.0] * 3), (404, [1.0, None, 1.0, 1.0]), (405, [float("nan")] * 4),
             (406, [float("inf"), 0.0, 0.0, 0.0]), (407, [0.0, 0.0, float("-inf"), 0.0])]
    found = centroids.clusters(vectors(spark, rows), k=12, rounds=3, width=4)
    assert Counter(map(tuple, found.collect())) == brute_clusters(rows, 12, 3, 4)


def test_few_and_odd_vectors(spark):
    assert centroids.clusters(vectors(spark, [])).isEmpty()
    assert centroids.clusters(vectors(spark, [(1, [0.0] * 3)])).isEmpty()
    two = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])]
    assert Counter(map(tuple, centroids.clusters(vectors(spark, two), width=2).collect())) == brute_clusters(two, 40, 5, 2)
    huge = vectors(spark, [(1, [1e308, 0.0]), (2, [-1e308, 0.0]), (3, [1e308, 1e300])])
    found = centroids.clusters(huge, k=1, rounds=1, width=2).collect()
    assert len(found) == 3 and max(x.distance for x in found) == (1 << 63) - 1
