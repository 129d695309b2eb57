"""Mixing sources to target weights by entropy balancing.

Targets: sources share `share` times all words by weight; none may exceed `most` times its own
words, and the excess is shared again by weight among the others (water filling).

Rates: of all document rates r in [0, most] that meet the target of their source, those nearest
to 1 in relative entropy are r = min(most, exp(lambda * x)), with x the size of the document over
the mean size of its source. The dual is convex with one lambda per source; Newton steps, kept
in a bracket, solve all sources at once. A step is an aggregate over (source, size) counts:
documents of one size have one rate, so documents are read once.

Copies: r is rounded down, and a document gets one more when its random number, a hash of its id
and text, lies below the rest of r plus a shift. The shift of a source is found by counting
words over ever finer bins of the margin. The gap before the document at which the target is
passed is filled with the largest documents that fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelarder.llm.common import WORD, same, stored

WEIGHTS = (3, 1, 2)
_BINS, _LEVELS = 1024, 3
_SCALE = _BINS**_LEVELS
_PICKS = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Add `nth`, the 0-based place of a source by code point, null last.

    Range partitions are sorted and numbered, and the row counts before each are added.
    """
    parts = sources.sparkSession.conf.get("spark.sql.shuffle.partitions")
    order = [F.col("source").asc_nulls_last()]
    placed = sources.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "sources")
    part, row = F.expr("shiftright(place, 33)"), F.expr("place & 8589934591")
    before = placed.groupBy(part.alias("part")).count()  # a row per partition
    before = before.select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before")
    )
    placed = placed.withColumn("part", part).join(before, "part")
    return placed.withColumn("nth", F.col("before") + row).drop("part", "place", "before")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target for a table (source, source_size) with a row per source."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = stored(_ranked(sizes).withColumn("weight", weight), "weights")
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    cap = F.col("source_size") * F.lit(most)
    # The level rises from one round to the next until no further source is above it.
    level, before = 0.0, -1.0
    while level != before:
        before = level
        free = (F.col("weight") * before < cap) & (cap > 0)
        capped, spread = rows.agg(
            F.sum(F.when(~free, cap).otherwise(0.0)), F.sum(F.when(free, F.col("weight")).otherwise(0.0))
        ).first()
        level = max(before, (total - capped) / spread) if spread else before
    return rows.select(
        "source", "source_size", F.least(F.col("weight") * level, cap).cast("double").alias("target")
    )


def _solved(histogram: DataFrame, goals: DataFrame, most: float, tolerance: float = 1e-6) -> DataFrame:
    """source and its lambda, by bracketed Newton steps over (source, size, n)."""
    mean = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    goals = goals.withColumnRenamed("source", "s")
    state = goals.join(mean, same(goals.s, mean.source)).select(
        "source", "source_size", "target", "mean",
        F.lit(0.0).alias("lam"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("met"),
    )
    # A target at the bound takes every document as often as it may be taken.
    full = F.col("target") >= F.col("source_size") * (most * (1 - tolerance))
    state = state.withColumns({"lam": F.when(full, 1e6).otherwise(0.0), "met": full})
    state = stored(state, "dual")
    for _ in range(200):  # bisection alone ends in 80 steps; Newton needs some eight
        s = state.select(F.col("source").alias("s"), *[c for c in state.columns if c != "source"])
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(most), F.exp(F.least(F.col("lam") * x, F.lit(50.0))))
        step = (
            histogram.join(s, same(histogram.source, s.s)).where("size > 0")
            .groupBy("source", "source_size", "target", "mean", "lam", "low", "high", F.col("met").alias("was_met"))
            .agg(F.sum(rate * F.col("size") * F.col("n")).alias("taken"),
                 F.sum(F.when(rate < most, rate * x * F.col("size") * F.col("n")).otherwise(0.0)).alias("slope"))
        )
        miss = F.col("taken") - F.col("target")
        met = F.col("was_met") | (F.abs(miss) <= tolerance * F.col("target")) | (F.col("high") - F.col("low") < 1e-12)
        step = step.withColumns({
            "met": met,
            "low": F.when(miss < 0, F.col("lam")).otherwise(F.col("low")),
            "high": F.when(miss < 0, F.col("high")).otherwise(F.col("lam")),
        })
        newton = F.col("lam") - F.try_divide(miss, F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        # Without a usable step: half the bracket, or twice as far while a side is still open.
        wider = (
            F.when(F.col("high") >= 1e6, F.greatest(F.col("low") * 2, F.lit(1.0)))
            .when(F.col("low") <= -1e6, F.least(F.col("high") * 2, F.lit(-1.0)))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        step = step.withColumn(
            "lam", F.when(F.col("met"), F.col("lam")).when(F.coalesce(inside, F.lit(False)), newton).otherwise(wider)
        )
        state = stored(step.drop("taken", "slope", "was_met"), "dual")
        if state.where(~F.col("met")).isEmpty():
            break
    else:
        raise RuntimeError("the rates of some sources don't meet their targets")
    # Sums of doubles depend on their order in the last digits; reruns must not.
    return state.select("source", "mean", F.round("lam", 7).alias("lam"))


def rated(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`docs` with _size, _source_size, _target and _copies, a whole number from 0 to `most`.
    Columns of `docs` with one of these four names are replaced; no other name matters.

    A null text has no words. A null source is a source of its own, the last. Documents without
    words have rate 1 and are taken once. Repeated rows get equal copies. An empty table stays
    empty. Reruns give the same copies.
    """
    taken = {"_size", "_source_size", "_target", "_copies"}
    rows = _rated(docs, weights, share, most)
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in taken]
    return rows.select(*kept, "_size", "_source_size", "_target", "_copies")


def _rated(docs: DataFrame, weights, share: float, most: float) -> DataFrame:
    """`row` (all columns of a document, so that no name can clash), _size, _source_size, _target, _copies."""
    if not 1 <= most == int(most):
        raise ValueError("most must be a whole number, 1 or more")
    size = word_count(F.col("text"))
    narrow = docs.select("source", "doc_id", F.xxhash64("doc_id", "text").alias("u"), size.alias("size"))
    narrow = stored(narrow.drop("doc_id"), "sizes")
    histogram = stored(narrow.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    goals = stored(
        targets(
            histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size")),
            weights, share, most,
        ),
        "targets",
    )
    duals = _solved(histogram, goals, most).withColumnRenamed("source", "s")
    plan = goals.join(duals, same(goals.source, duals.s), "left").drop("s")
    plan = stored(plan.select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"), F.col("mean").alias("_mean"), F.coalesce("lam", F.lit(0.0)).alias("_lam"),
    ), "plan")

    def placed(rows: DataFrame, size: str, u: str) -> DataFrame:
        rate = F.least(F.lit(float(most)), F.exp(F.least(F.lit(50.0), F.col("_lam") * F.col(size) / F.col("_mean"))))
        whole = F.floor(F.coalesce(rate, F.lit(1.0)))
        rest = F.coalesce(rate, F.lit(1.0)) - whole
        random = F.pmod(F.col(u), F.lit(1 << 52)) / F.lit(float(1 << 52))
        # 0 to 1: how late a document gets its extra copy as the shift grows; null: never.
        margin = F.when((whole < most) & (F.col(size) > 0), (random - rest + 1) / 2)
        point = F.least(F.floor(margin * _SCALE), F.lit(_SCALE - 1)).cast("long")
        return rows.withColumns({"_whole": whole.cast("int"), "_point": point})

    points = narrow.withColumnRenamed("source", "_of")
    points = placed(points.join(plan, same(points._of, plan._source)), "size", "u")
    counts = points.groupBy("_source", "_target", F.col("_point").alias("point")).agg(
        F.sum(F.col("size")).alias("words"), F.sum(F.col("size") * F.col("_whole")).alias("base")
    )
    counts = stored(counts, "points")
    cuts = _filled(counts, _cuts(counts))
    plan = stored(plan.join(cuts, same(plan._source, cuts.cut_source), "left").drop("cut_source"), "plan")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").alias("_of"),
        size.alias("_size"), F.xxhash64("doc_id", "text").alias("_u"),
    )
    rows = placed(rows.join(plan, same(rows["_of"], plan["_source"])), "_size", "_u")
    chosen = (F.col("_point") < F.col("_cut")) | F.array_contains("_fill", F.col("_point"))
    extra = F.coalesce(chosen.cast("int"), F.lit(0))
    return rows.select(
        "row", "_size", "_source_size", "_target", (F.col("_whole") + extra).alias("_copies")
    )


def _cuts(counts: DataFrame) -> DataFrame:
    """The point below which documents of a source get one more copy, from word counts per point.

    Counts are summed over 1,024 bins of the scale; the bin in which the target is reached is
    divided again, down to single points. Also gives the words that are then missing.
    """
    base = counts.groupBy("_source").agg(
        (F.first("_target") - F.sum("base")).alias("missing"), F.lit(0).cast("long").alias("low")
    )
    state = base.withColumnRenamed("_source", "cut_source")
    for level in range(1, _LEVELS + 1):
        width = _SCALE // _BINS**level
        inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("low") + width * _BINS)
        bins = counts.join(state, same(counts._source, state.cut_source)).where(inside)
        bins = bins.groupBy("cut_source", F.floor((F.col("point") - F.col("low")) / width).alias("bin")).agg(
            F.sum("words").alias("words")
        )
        up_to = F.sum("words").over(Window.partitionBy("cut_source").orderBy("bin"))  # at most 1,024 rows
        bins = bins.withColumn("up_to", up_to).withColumnRenamed("cut_source", "b")
        reached = bins.join(state, same(bins.b, state.cut_source)).groupBy("b").agg(
            F.max(F.when(F.col("up_to") <= F.col("missing"), F.col("up_to")).otherwise(0)).alias("taken"),
            F.min(F.when(F.col("up_to") > F.col("missing"), F.col("bin"))).alias("next_bin"),
        )
        state = state.join(reached, same(state.cut_source, reached.b), "left")
        step = F.coalesce(F.col("next_bin"), F.lit(_BINS))
        state = stored(state.select(
            "cut_source", (F.col("missing") - F.coalesce("taken", F.lit(0))).alias("missing"),
            (F.col("low") + F.when(F.col("b").isNull(), 0).otherwise(step) * width).cast("long").alias("low"),
        ), "cuts")
    return state.select("cut_source", F.col("low").alias("_cut"), "missing")


def _filled(counts: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add `_fill`, points beyond the cut whose words fill the gap that is left.

    The document at the cut may be longer than the gap. A round looks at the _PICKS points of a
    source with most words among those that still fit, and takes them in that order as long as
    their sum fits, which is one point at least. Rounds go on until no point of any source fits.
    """
    state = cuts.withColumn("_fill", F.expr("cast(array() as array<bigint>)"))
    picked, picks = None, 0
    while picked != 0:
        fits = counts.join(state, same(counts._source, state.cut_source)).where(
            (F.col("point") >= F.col("_cut")) & (F.col("words") <= F.col("missing")) & (F.col("words") > 0)
            & ~F.array_contains("_fill", F.col("point"))
        )
        largest = Window.partitionBy("cut_source").orderBy(F.desc("words"), F.desc("point"))
        best = fits.withColumn("nth", F.row_number().over(largest)).where(F.col("nth") <= _PICKS)
        best = best.withColumn("up_to", F.sum("words").over(largest.rowsBetween(Window.unboundedPreceding, 0)))
        best = best.where("up_to <= missing").groupBy(F.col("cut_source").alias("b")).agg(
            F.sum("words").alias("words"), F.collect_list("point").alias("points")  # at most _PICKS
        )
        state = state.join(best, same(state.cut_source, best.b), "left").select(
            "cut_source", "_cut", (F.col("missing") - F.coalesce("words", F.lit(0))).alias("missing"),
            F.when(F.col("b").isNull(), F.col("_fill")).otherwise(F.concat("_fill", "points")).alias("_fill"),
        )
        state = stored(state, "fill")
        total = state.agg(F.sum(F.size("_fill"))).first()[0] or 0
        picked, picks = total - picks, total
    return state.drop("missing")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with its own columns."""
    options = {"weights": WEIGHTS, "share": 1.5, "most": 2.0} | options
    rows = _rated(docs, **options).where("_copies > 0")
    rows = rows.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
