"""Stored pages: plain files, or a snapshot laid out for large runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelarder.operators.frontier import with_url_key
from pagelarder.operators.routing import route
from pagelarder.schema import PAGES
from pagelarder.sources.spec import SourceSpec


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html). The schema is given, so nothing is read to infer it."""
    return spark.read.schema(PAGES).parquet(path)


def save_snapshot(
    pages: DataFrame,
    table: str,
    buckets: int,
    path: str | None = None,
    specs: list[SourceSpec] | None = None,
    distribute: bool = True,
    **options,
) -> None:
    """Write pages as a table partitioned by kind and bucketed by page id.

    Listing scans then skip recipe pages, and picking pages by id does not shuffle bodies.
    Choose `buckets` so that a bucket of the largest kind is a few hundred megabytes. Rows are
    distributed by page id first, so each task writes one file per kind and bucket. Without
    `distribute` no body is moved for that: each task writes its rows of every bucket, unsorted,
    which makes as many files as tasks times buckets. The key of each URL is stored, so that
    finding pages computes none; `save_url_index` sorts those keys. `options` are the writer's.
    """
    routed = route(with_url_key(pages), specs)
    if distribute:
        routed = routed.repartition(buckets, "page_id")
    writer = routed.write.options(**options).mode("errorifexists").partitionBy("kind").bucketBy(buckets, "page_id")
    if distribute:
        writer = writer.sortBy("page_id")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
