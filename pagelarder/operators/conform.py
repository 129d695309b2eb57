"""Bring the columns of any source to the one record schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelarder.schema import FEED_KEYS, FIELDS, RECIPES

Hook = Callable[[DataFrame], DataFrame]


def record(fields: dict[str, Column], lost: list[tuple[str, Column]]) -> Column:
    """One struct with every record column, `absent_keys` and the `reason` a page is lost.

    Three kinds of missing stay apart: '' is a default, null was looked for and not found,
    and a key the source never sets is null and listed in `absent_keys`.
    """
    given = dict(fields)
    absent = given.pop("absent_keys", None)
    if unknown := given.keys() - FIELDS.keys():
        raise ValueError(f"not a record column: {sorted(unknown)}")
    if absent is None:
        absent = F.array(*[F.lit(FEED_KEYS[n]) for n in FIELDS if n not in given])
    reason = F.lit(None).cast("string")
    for text, condition in reversed(lost):
        reason = F.when(condition, F.lit(text)).otherwise(reason)
    return F.struct(
        *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in FIELDS.items()],
        absent.cast("array<string>").alias("absent_keys"),
        reason.alias("reason"),
    )


def recipes(extracted: DataFrame, hooks: Iterable[Hook] = ()) -> DataFrame:
    """The records: pages that are not lost, passed through each hook in turn."""
    kept = extracted.filter(F.col("reason").isNull()).select(*RECIPES.names)
    return reduce(DataFrame.transform, hooks, kept)


def rejects(extracted: DataFrame) -> DataFrame:
    """The lost pages and why they are lost."""
    return extracted.filter(F.col("reason").isNotNull()).select("url", "source", "reason")


def combine(*tables: DataFrame) -> DataFrame:
    """All records in one table, duplicates kept."""
    return reduce(DataFrame.unionByName, tables)


def to_feed_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in FEED_KEYS.items() if k in df.columns})


def from_feed_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in FEED_KEYS.items() if v in df.columns})
