"""Which pages a run covers: listing URLs from page ranges, windows, cut-offs, link sets.

Ranges and lookup tables are small; links and pages are not. Whatever handles links or pages
aggregates before it shuffles, and joins on keys that are unique on both sides, so a URL that
half of all listings link to costs no more than any other.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelarder.functions.urls import url_key
from pagelarder.sources.spec import SourceSpec, registered_sources


def template_table(spark: SparkSession, specs: list[SourceSpec] | None = None) -> DataFrame:
    """(source, template) of every listing template; its size is that of the registry."""
    specs = registered_sources() if specs is None else specs
    rows = [(s.name, t) for s in specs for t in s.listings]
    return spark.createDataFrame(
        pa.table({"source": [r[0] for r in rows], "template": [r[1] for r in rows]})
    )


def category_table(spark: SparkSession, specs: list[SourceSpec] | None = None) -> DataFrame:
    """A row per category of the sources that have some; its size is that of the registry."""
    specs = registered_sources() if specs is None else specs
    rows = [(s.name, *row, s.categories.window, s.categories.listing)
            for s in specs if s.categories for row in s.categories.rows]
    schema = pa.schema(
        [(n, pa.string()) for n in ("source", "category", "category_id", "max_pages")]
        + [("window", pa.int32()), ("listing", pa.string())]
    )
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return spark.createDataFrame(pa.table(list(map(list, columns)), schema=schema))


def _pages(start: Column, end: Column) -> Column:
    """Inclusive range, empty when start > end (a bare sequence would count down)."""
    return F.explode(F.when(start <= end, F.sequence(start, end)))


def seed_urls(runs: DataFrame, templates: DataFrame) -> DataFrame:
    """One listing URL per run, template of its source and page of its inclusive range.

    A run of an unknown source or without a range has no URL; see `run_rejects`.
    """
    start, end = F.col("page_start").try_cast("int"), F.col("page_end").try_cast("int")
    return (
        runs.select("*", _pages(start, end).alias("page"))
        .join(templates, "source")
        .withColumn("url", F.replace("template", F.lit("%s"), F.col("page").cast("string")))
        .drop("template")
    )


def category_pages(runs: DataFrame, categories: DataFrame) -> DataFrame:
    """Listing pages of category runs with their item windows.

    The first page of a run is always visited; after it the run stops at `page_end` or at the
    number of pages the category has. A run of an unknown category or without a range has no
    page; see `run_rejects`.
    """
    start, end = F.col("page_start").try_cast("int"), F.col("page_end").try_cast("int")
    last = F.when(end.isNotNull(), F.greatest(start, F.least(end, F.col("max_pages").cast("int"))))
    first_item = (F.col("page") - 1) * F.col("window")
    return (
        runs.join(categories, [c for c in ("source", "category") if c in runs.columns])
        .withColumn("page", F.explode(F.sequence(start, last)))
        .withColumn("start_idx", first_item)
        .withColumn("end_idx", first_item + F.col("window") - 1)
        .drop("max_pages", "window")
    )


def category_urls(pages: DataFrame) -> DataFrame:
    """Add the URL under which a category listing is stored."""
    url = F.col("listing")
    for mark, column in (("{category}", "category_id"), ("{start}", "start_idx"), ("{end}", "end_idx")):
        url = F.replace(url, F.lit(mark), F.col(column).cast("string"))
    return pages.withColumn("url", url).drop("listing")


def with_run_id(runs: DataFrame) -> DataFrame:
    """Runs with a `run_id`; runs that have none are named after their source and range."""
    if "run_id" in runs.columns:
        return runs
    parts = ["source", "category", "page_start", "page_end"]
    return runs.withColumn("run_id", F.concat_ws("/", *[F.coalesce(c, F.lit("")) for c in parts]))


def _by_category(specs: list[SourceSpec]) -> Column:
    return F.coalesce(F.col("source").isin(*[s.name for s in specs if s.categories]), F.lit(False))


def run_rejects(runs: DataFrame, specs: list[SourceSpec] | None = None) -> DataFrame:
    """Runs that name no listing page, with the reason: (run_id, source, category, reason)."""
    known = registered_sources() if specs is None else specs
    by_category = _by_category(known)
    source = F.col("source").isin(*[s.name for s in known])
    category = F.lit(False)
    for s in known:
        if s.categories:
            named = F.col("category").isin(*[row[0] for row in s.categories.rows])
            category = F.when(F.col("source") == s.name, named).otherwise(category)
    number = F.col("page_start").try_cast("int").isNotNull() & F.col("page_end").try_cast("int").isNotNull()
    reason = (
        F.when(~F.coalesce(source, F.lit(False)), "unknown source")
        .when(by_category & ~F.coalesce(category, F.lit(False)), "unknown category")
        .when(~number, "no page range")
    )
    rows = with_run_id(runs).select("run_id", "source", "category", reason.alias("reason"))
    return rows.filter(F.col("reason").isNotNull())


def listing_urls(runs: DataFrame, specs: list[SourceSpec] | None = None) -> DataFrame:
    """Every listing page of every run: (run_id, source, category, page, url)."""
    spark = runs.sparkSession
    runs = with_run_id(runs)
    columns = ["run_id", "source", "category", "page", "url"]
    by_category = _by_category(registered_sources() if specs is None else specs)
    plain = seed_urls(runs.filter(~by_category), template_table(spark, specs))
    categories = category_pages(runs.filter(by_category), category_table(spark, specs))
    return plain.select(columns).unionByName(category_urls(categories).select(columns))


def is_listing(url: Column, specs: list[SourceSpec] | None = None) -> Column:
    """Is this the address of a listing page? A test that scans can push down."""
    specs = registered_sources() if specs is None else specs
    prefixes = [t.split("%s")[0] for s in specs for t in s.listings]
    prefixes += [s.categories.prefix for s in specs if s.categories]
    return reduce(Column.__or__, [url.startswith(p) for p in prefixes], F.lit(False))


def page_windows(windows: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Cut start..total into windows of `inc` pages, the last one clamped.

    A start beyond the total gives nothing, or one empty window (start, total) on request.
    """
    start, total, inc = F.col("start"), F.col("total"), F.col("inc")
    inside = F.when(start <= total, F.sequence(start, total, inc))
    starts = F.coalesce(inside, F.array(start)) if keep_empty else inside
    return windows.withColumn("w_start", F.explode(starts)).withColumn(
        "w_end", F.least(F.col("w_start") + inc - 1, total)
    )


def pages_until_empty(
    listings: DataFrame, empty: DataFrame, run: list[str], page: str
) -> DataFrame:
    """Listing pages of each run before its first empty page.

    `empty` holds the empty pages. The cut is one aggregated row per run joined back, not a
    window: the pages of a run never meet in one task. The join is adaptive and splits a run
    that holds a large share of the rows.
    """
    cuts = empty.groupBy(*run).agg(F.min(page).alias("_cut"))
    kept = listings.join(cuts, run, "left")
    return kept.filter(F.col("_cut").isNull() | (F.col(page) < F.col("_cut"))).drop("_cut")


# Bits that a column of an order takes up in a packed order: whole numbers from 0 of an int, all of a long.
_BITS = {"int": 31, "bigint": 64}


def packed_order(links: DataFrame, order: list[str]) -> Column | None:
    """One decimal that sorts as the order columns do, null as the least; None where they don't fit."""
    kinds = dict(links.dtypes)
    if any(kinds[c] not in _BITS for c in order) or sum(_BITS[kinds[c]] for c in order) > 126:
        return None
    packed = F.lit(0).cast("decimal(38,0)")
    for c in order:
        value = F.coalesce(F.col(c), F.lit(0)).cast("decimal(19,0)")
        if kinds[c] == "bigint":
            value = F.when(F.col(c).isNotNull(), value + F.lit(Decimal(1 << 63))).otherwise(F.lit(Decimal(0)))
        shift = F.lit(Decimal(1 << _BITS[kinds[c]]))
        packed = (packed * shift + value).cast("decimal(38,0)")
    return packed


def dedup_links(links: DataFrame, order: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """One link per URL key, the first one in `order`; with `within`, one per key and group.

    The order columns are packed into one number, whose minimum per key is a hash aggregate that is
    combined before the shuffle: each task sends one row per key no matter how often a link is
    repeated. The first link is then found by key and order together, which no two rows share, so
    a link that half of all listings repeat is spread over the tasks. `order` must tell the rows of
    a key apart, and `links` should be stored, as it is read twice.

    Orders that do not fit into 126 bits take the minimum of a struct instead, which sorts.
    """
    links_keyed = links.withColumn("url_key", url_key(F.col("url")))
    packed = packed_order(links, order)
    if packed is None:
        rest = [c for c in links.columns if c not in (*order, *within)]
        first = F.min(F.struct(*order, *rest)).alias("_first")
        return links_keyed.groupBy(*within, "url_key").agg(first).select(
            "url_key", *[F.col(c) if c in within else F.col("_first")[c].alias(c) for c in links.columns]
        )
    links_keyed = links_keyed.withColumn("_order", packed)
    key = [*within, "url_key"]
    least = links_keyed.groupBy(*key).agg(F.min("_order").alias("_least"))
    least = least.withColumnsRenamed({c: f"_of_{c}" for c in key})
    same = links_keyed["_order"] == least["_least"]
    for c in key:
        same &= links_keyed[c].eqNullSafe(least[f"_of_{c}"])
    return links_keyed.join(least, same, "left_semi").select("url_key", *links.columns)


def delta(links: DataFrame, done: DataFrame, enabled: bool = False) -> DataFrame:
    """Links whose page has not given a record in an earlier run; off by default.

    `links` has a `url_key`; `done` has the `url` of each earlier record. Earlier records can be
    many whatever size the planner guesses, above all if they are computed, so they are merged
    with the links and never pass through the driver.
    """
    if not enabled:
        return links
    keys = done.select(url_key(F.col("url")).alias("url_key"))
    return links.join(keys.hint("merge"), "url_key", "left_anti")


def with_url_key(pages: DataFrame) -> DataFrame:
    """Pages with their `url_key`, which a snapshot has stored."""
    return pages if "url_key" in pages.columns else pages.withColumn("url_key", url_key(F.col("url")))


def first_copies(pages: DataFrame) -> DataFrame:
    """(url_key, page_id): the first stored copy of each URL.

    Reads `page_id` and `url` only, or the `url_key` of a snapshot. Copies collapse before the
    shuffle.
    """
    keys = with_url_key(pages).select("url_key", "page_id")
    return keys.groupBy("url_key").agg(F.min("page_id").alias("page_id"))


def missing_listings(
    expected: DataFrame, pages: DataFrame, specs: list[SourceSpec] | None = None
) -> DataFrame:
    """Expected listing pages that the snapshot does not hold. Only listings are compared."""
    listings = pages.filter(is_listing(F.col("url"), specs))
    keys = with_url_key(listings).select("url_key")
    with_key = expected.withColumn("url_key", url_key(F.col("url")))
    return with_key.join(keys, "url_key", "left_anti").drop("url_key")
