"""Tables partitioned by a hash bucket of `url_key`, of which lookups read the buckets they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def in_buckets(table: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """The rows of a bucketed table that lie in a bucket of one of the keys.

    The numbers of the buckets come to the driver, at most one for each bucket, so that the
    scan lists and opens those alone.
    """
    touched = keys.select(bucket_of(F.col("url_key"), buckets).alias("b")).distinct().collect()
    return table.where(F.col("bucket").isin([r.b for r in touched]))
