r"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a longest stretch of words with smallest period q, at least `least` words and three
times q long. The suffix links of the automaton of a word sequence form a tree in which the
prefix that ends at i is a node and its suffixes are the path to the root. Every node knows
where its strings ended last. Appending word i accesses the node of prefix i: the path to the
root is cut from the paths of older ends and takes the colour i. On its way the access meets
segments of one colour j each; the deepest node of a segment has the length L of the longest
suffix at i that ended last at j. If the distance d = i - j is at most L, then L + d words that
end at i have period d, which is a square or more. d is their smallest period (a smaller one
would have been a later end), and they can't be extended to the left (a longer suffix would be
in the segment). As every further word of a run meets its segment again, the last i extends the
run to the right. So a run is the pair (start, d) with the last i at which it was met.

The automaton is complete before the first access, so its tree stands still: the paths of
link-cut trees are kept as stacks on the heavy chains of that tree, of which a path to the root
meets at most log2(n). An access pops what it covers, so segments cost amortised O(log n).

Most texts have no run, and the automaton need not see them. A run of `least` words has a window
of `least` - floor(least / 3) words that stands q words earlier too, with q at most a third of
the run. Windows are hashed to find those stretches; words left out by that are in no run. What
is kept in memory is a text with its word numbers, and about 150 bytes for each word of the
longest stretch that repeats itself.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelarder.llm.common import WORD, let

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 24
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """Suffix automaton of a sequence of numbers: `length` and `link` of each state, `ends[i]` the
    state of the prefix that ends at i. State 0 is the root; its link is -1.

    Nearly all states have one transition, which is kept in two arrays; others are in `more`.
    """

    def __init__(self, words: list[int]):
        self.length, self.link, self.ends = array("i", [0]), array("i", [-1]), array("i")
        self._word, self._to, self._more = array("i", [-1]), array("i", [-1]), {}
        last = 0
        for word in words:
            last = self._append(last, word)
            self.ends.append(last)

    def _new(self, length: int, link: int, word: int, to: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._word.append(word)
        self._to.append(to)
        return len(self.length) - 1

    def _append(self, last: int, word: int) -> int:
        first, to, more, link, length = self._word, self._to, self._more, self.link, self.length
        new = self._new(length[last] + 1, 0, -1, -1)
        p, q = last, -1
        while p >= 0:
            if first[p] == word:
                q = to[p]
                break
            if first[p] < 0:
                first[p], to[p] = word, new
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {word: new}
                elif word in others:
                    q = others[word]
                    break
                else:
                    others[word] = new
            p = link[p]
        if q < 0:
            return new
        if length[q] == length[p] + 1:
            link[new] = q
            return new
        clone = self._new(length[p] + 1, link[q], first[q], to[q])
        if q in more:
            more[clone] = dict(more[q])
        link[q] = link[new] = clone
        while p >= 0:
            if first[p] == word:
                if to[p] != q:
                    break
                to[p] = clone
            elif more.get(p, {}).get(word) == q:
                more[p][word] = clone
            else:
                break
            p = link[p]
        return new


def heavy_chains(length: array, link: array) -> tuple[array, array]:
    """`chain` of each state and `above`, for each chain, the state above its top.

    A state shares the chain of its largest subtree.
    """
    n = len(length)
    order = np.argsort(np.frombuffer(length, np.int32), kind="stable").tolist()
    size, heavy = array("i", [1]) * n, array("i", [-1]) * n
    for v in reversed(order):
        p = link[v]
        if p >= 0:
            size[p] += size[v]
            if heavy[p] < 0 or size[v] > size[heavy[p]]:
                heavy[p] = v
    chain, above = array("i", [0]) * n, array("i")
    for v in order:
        p = link[v]
        if p >= 0 and heavy[p] == v:
            chain[v] = chain[p]
        else:
            chain[v] = len(above)
            above.append(p)
    return chain, above


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """(start, period) -> last word of every stretch of at least two periods that is maximal."""
    automaton = Automaton(words)
    length, ends = automaton.length, automaton.ends
    chain, above = heavy_chains(length, automaton.link)
    stacks: list[list[tuple[int, int]]] = [[] for _ in above]
    found: dict[tuple[int, int], int] = {}
    for i, v in enumerate(ends):
        below = -1  # colour of the segment that a chain further down began with
        while v >= 0:
            own = chain[v]
            stack, depth, met, j, top = stacks[own], length[v], 0, -1, -1
            # Segments of the chain, from its top: the length at the lower end, and the colour.
            while stack and stack[-1][0] <= depth:
                if j >= 0 and i - j <= met:
                    found[j - met + 1, i - j] = i
                met, j = stack.pop()
                if top < 0:
                    top = j
            if met < depth and stack:
                if j >= 0 and i - j <= met:
                    found[j - met + 1, i - j] = i
                met, j = depth, stack[-1][1]
                if top < 0:
                    top = j
            # The last one may go on in the chain below, where it was met at its lower end.
            if j >= 0 and j != below and i - j <= met:
                found[j - met + 1, i - j] = i
            below = top
            stack.append((depth, i))
            v = above[own]
    return found


def stretches(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Disjoint stretches (first, after the last word) outside of which no run has a word.

    A window of `width` words that stands q words earlier too is in a run of period q only if
    all windows of the run beyond its first q words do. They are consecutive, and there are at
    least two thirds of the run's words less `width` of them.
    """
    width = least - least // 3
    n = len(ids)
    if n < least:
        return []
    hashed, done = ids.astype(np.uint64) + np.uint64(1), 1
    while done < width:
        step = min(done, width - done)
        hashed = (hashed[: len(hashed) - step] * _MIX) ^ (hashed[step:] + (hashed[step:] >> np.uint64(29)))
        hashed ^= hashed >> np.uint64(32)
        done += step
    order = np.argsort(hashed, kind="stable")
    equal = np.flatnonzero(hashed[order[1:]] == hashed[order[:-1]])
    at, distance = order[equal + 1], order[equal + 1] - order[equal]
    by_place = np.argsort(at)
    at, distance = at[by_place], distance[by_place]
    while len(at):
        # Consecutive windows; a period is at most half of their number plus `width`.
        first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
        count = np.diff(np.r_[first, len(at)])
        most = np.repeat((count + width) // 2, count)
        near = distance <= most
        if near.all():
            break
        at, distance = at[near], distance[near]
    if not len(at):
        return []
    begin = np.maximum(0, at[first] - (count + width) // 2)
    end = at[first] + count + width - 1
    joined: list[tuple[int, int]] = []
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        while joined and joined[-1][1] >= a:
            a = min(a, joined.pop()[0])
        joined.append((a, b))
    return joined


def runs(words: list[bytes], least: int = LEAST, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < least:
        return []
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    found = []
    for a, b in stretches(np.array(ids, np.int64), least):
        for (start, period), last in squares(ids[a:b]).items():
            length = last - start + 1
            if length >= least and length >= times * period:
                found.append((a + start, length, period))
    return sorted(found)


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            texts, lists = [], []
            for text in part.column(1).cast(pa.binary()).to_pylist():
                words = (text or b"").split()  # bytes are split at the six ASCII spaces alone
                found = runs(words)
                texts.append(b" ".join(collapsed(words, found)))
                lists.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            columns = [part.column(0), pa.array(lists, kind), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "text"])


def without_periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, runs (start, length, period), text.

    Words are what the six ASCII white-space characters separate, numbered from 0. `runs` are
    sorted by start, then period. `text` has the words that stay, one space between them: a word
    goes if any run holds it after the first period of that run. A null or empty text, or one of
    spaces only, has no run and gives an empty text. Rows do not see each other, so repeated rows
    and repeated ids give equal rows; a null doc_id is kept as it is. Other columns, whatever their
    names, are not read. An empty table gives an empty result. Nothing is shuffled.
    """
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_collapse, f"doc_id long, runs {RUNS}, text string")


def repeating_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents go on with their own words from a place on.

    With h the crc32 of the decimal doc_id and g = floor(h / 10): if h % 10 = 0, every word from
    a = g % n on is replaced by word a + (i - a) % p, with p = 1 + floor((n - a) / (3 + g % 8)).
    Other texts, and those of a null doc_id, are left as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def replaced(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0), n - 1)
        return F.array_join(
            F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " "
        )

    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    text = F.when((h % 10 == 0) & F.col("text").rlike(WORD), let(words, replaced)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def run_report(found: DataFrame) -> DataFrame:
    """What `without_periodic_runs` gives, as numbers and digests: doc_id, n_runs, the start,
    length, period and exponent_milli of the run with most periods, runs_sha256, collapsed_sha256.

    Of runs with equally many periods the first in (start, period) counts; without a run all four
    are null.
    """
    best = F.aggregate(
        "runs", F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
