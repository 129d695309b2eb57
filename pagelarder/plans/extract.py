"""Pages -> records in one pass: one scan, one shred, no shuffle, for all sources together."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelarder.functions.unicode import nfkd_each
from pagelarder.operators.links import unwrap_json_html
from pagelarder.operators.select import page
from pagelarder.operators.shred import Reads, shred
from pagelarder.sources.spec import JSON, JSON_HTML, SourceSpec, registered_sources


# Record expressions name columns only, so one per source serves every table of a session.
# Building one takes thousands of calls into the JVM, which is worth doing once.
# With each stands what its selectors read of start tags.
_RECORDS: dict[tuple[str, SourceSpec], tuple[Column, Reads]] = {}


def _record(application: str, spec: SourceSpec) -> tuple[Column, Reads]:
    key = (application, spec)
    if key not in _RECORDS:
        nodes = page("nodes")
        _RECORDS[key] = spec.record(nodes), nodes.reads
    return _RECORDS[key]


def _per_source(pairs: list[tuple[str, Column]]) -> Column:
    """The expression of the row's source; the others are not evaluated."""
    chain = F.when(F.col("source") == pairs[0][0], pairs[0][1])
    for name, value in pairs[1:]:
        chain = chain.when(F.col("source") == name, value)
    return chain


def extract(pages: DataFrame, specs: list[SourceSpec] | None = None) -> DataFrame:
    """Records of recipe pages, with `reason` set where a page is lost.

    `pages` has url, html and source, and category where a source needs it. Pages of unknown
    sources are dropped before they are parsed. The record is produced by `inline`, so that
    filters on the result cannot be pushed below it and repeat the extraction.
    """
    specs = registered_sources() if specs is None else specs
    if "category" not in pages.columns:
        pages = pages.withColumn("category", F.lit(None).cast("string"))
    known = pages.filter(F.col("source").isin(*[s.name for s in specs]))
    keep = [c for c in known.columns if c != "html"]
    application = pages.sparkSession.sparkContext.applicationId
    records = [_record(application, s) for s in specs]
    record = _per_source([(s.name, r) for s, (r, _) in zip(specs, records, strict=True)])
    reads = reduce(or_, [r for _, r in records])
    extracted = shred(known, keep=keep, reads=reads).select(*keep, F.inline(F.array(record)))
    decomposed = [s.name for s in specs if s.decompose]
    if decomposed:
        steps = nfkd_each(F.col("steps"), F.col("source").isin(*decomposed))
        extracted = extracted.withColumn("steps", steps)
    return extracted


def find_links(
    listings: DataFrame, specs: list[SourceSpec] | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(page_id, source, category, listing_url, pos, url) of each link on the listing pages.

    `listings` has page_id, url, html, source, category and the columns to carry along. Bodies that are JSON only are not
    shredded but parsed in place.
    """
    specs = [s for s in (registered_sources() if specs is None else specs) if s.links]
    if not specs:
        raise ValueError("none of the sources says how its listings link to recipes")
    source = F.col("source")
    wrapped = [s.name for s in specs if s.links.body == JSON_HTML]
    plain_json = [s.name for s in specs if s.links.body == JSON]
    body = F.col("html")
    shreddable = (
        F.when(source.isin(*wrapped), unwrap_json_html(body)) if wrapped else F.when(F.lit(False), body)
    )
    if plain_json:
        shreddable = shreddable.when(source.isin(*plain_json), F.lit(None))
    keep = ["page_id", "source", "category", "url", *carry]
    known = listings.filter(source.isin(*[s.name for s in specs])).select(
        *keep,
        F.when(source.isin(*plain_json), body).alias("body"),
        shreddable.otherwise(body).alias("html"),
    )
    nodes = page("nodes")
    urls = _per_source(
        [(s.name, s.links.find(nodes, F.col("body"), F.col("url"))) for s in specs]
    )
    return shred(known, keep=[*keep, "body"], reads=nodes.reads).select(
        "page_id", "source", "category", *carry,
        F.col("url").alias("listing_url"),
        F.posexplode(urls).alias("pos", "url"),
    )
