"""Ordered lists: positions, slices, positional zip, and maps with dense integer keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`.

    Common subexpressions inside higher-order functions are not eliminated by the
    optimizer; a one-element transform names the value instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def nth(items: Column, position: int) -> Column:
    """Zero-based item, null when out of range."""
    return F.get(items, F.lit(position))


def first(items: Column) -> Column:
    return nth(items, 0)


def head(items: Column, count: int) -> Column:
    return F.slice(items, 1, count)


def first_half(items: Column) -> Column:
    """First floor(n/2) items: the pages in question print each list twice."""
    return F.slice(items, F.lit(1), F.floor(F.size(items) / 2).cast("int"))


def zip_shortest(left: Column, right: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Positional zip cut to the shorter list (Spark's own zip pads with nulls)."""
    n = F.least(F.size(left), F.size(right))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(1), n), merge)


def first_non_empty(*candidates: Column) -> Column:
    """First list with at least one item, null when all are empty."""
    return F.coalesce(*[let(c, lambda x: F.when(F.size(x) > 0, x)) for c in candidates])


def indexed_map(items: Column) -> Column:
    """List -> map<int,...> with keys 0..n-1, the shape of lists in the JSON feed."""
    return F.map_from_arrays(F.transform(items, lambda _, i: i), items)


def from_indexed_map(entries: Column) -> Column:
    """Map with textual integer keys -> list in numeric key order ("10" comes after "2")."""
    ordered = F.array_sort(
        F.transform(
            F.map_entries(entries),
            lambda e: F.struct(e["key"].cast("int").alias("i"), e["value"].alias("v")),
        )
    )
    return F.transform(ordered, lambda e: e["v"])
