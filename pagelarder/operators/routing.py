"""Tell recipe pages and listing pages apart, by URL prefix or because a listing links there."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelarder.operators.frontier import is_listing, with_url_key
from pagelarder.sources.spec import SourceSpec, registered_sources

if TYPE_CHECKING:
    from pagelarder.sources.url_index import UrlIndex

RECIPE, LISTING, OTHER = "recipe", "listing", "other"


def route(pages: DataFrame, specs: list[SourceSpec] | None = None) -> DataFrame:
    """Add `source` and `kind` from the URL alone.

    Kind is "recipe" below a recipe prefix, "listing" below a listing prefix and "other"
    elsewhere; other pages of a source without a recipe prefix are recipes when a listing
    links to them (`discovered`).
    """
    specs = registered_sources() if specs is None else specs
    url = F.col("url")
    rules = [(url.startswith(s.recipe_prefix), s.name, RECIPE) for s in specs if s.recipe_prefix]
    rules += [(is_listing(url, [s]), s.name, LISTING) for s in specs]
    routed = F.struct(F.lit(None).cast("string").alias("source"), F.lit(OTHER).alias("kind"))
    for condition, source, kind in reversed(rules):
        routed = F.when(
            condition, F.struct(F.lit(source).alias("source"), F.lit(kind).alias("kind"))
        ).otherwise(routed)
    return pages.withColumn("_route", routed).select("*", "_route.*").drop("_route")


def allowed_recipe(url: Column, source: Column, specs: list[SourceSpec] | None = None) -> Column:
    """May a page of this source at this URL be a recipe? Sources without a prefix allow all."""
    specs = registered_sources() if specs is None else specs
    allowed = F.lit(True)
    for s in specs:
        if s.recipe_prefix:
            allowed = F.when(source == s.name, url.startswith(s.recipe_prefix)).otherwise(allowed)
    return allowed


def discovered(
    pages: DataFrame, links: DataFrame, carry: list[str], index: UrlIndex | None = None
) -> DataFrame:
    """Ids of the pages that `links` name, with columns of the link.

    Works on ids and keys only. With an index of the pages only the buckets of the links are
    read; else pages that no link names leave before copies are collapsed. A key has one page and
    a link for each run that has it.
    """
    links = links.select("url_key", *carry)
    if index is not None:
        return index.lookup(links).join(links, "url_key").drop("url_key")
    keyed = with_url_key(pages).select("page_id", "url_key")
    named = keyed.join(links.select("url_key").distinct(), "url_key", "left_semi")
    first = named.groupBy("url_key").agg(F.min("page_id").alias("page_id"))
    return first.join(links, "url_key").drop("url_key")


def fetch(pages: DataFrame, chosen: DataFrame) -> DataFrame:
    """URL and body of the chosen pages, by page id.

    This is the one join that touches page bodies. Ids are unique, hence evenly spread. A
    snapshot bucketed by page id (`save_snapshot`) is joined without moving or sorting the bodies:
    the ids of a bucket are hashed and its bodies pass by.
    """
    if {"url_key", "kind"} <= set(pages.columns):  # a snapshot
        chosen = chosen.hint("shuffle_hash")
    return pages.select("page_id", "url", "html").join(chosen, "page_id")
