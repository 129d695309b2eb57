"""Declarative page sources. A new site is a new `SourceSpec`, given to `register_source`."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import let
from pagelarder.operators.conform import record
from pagelarder.operators.select import Selection

HTML, JSON_HTML, JSON = "html", "json_html", "json"


@dataclass(frozen=True)
class Links:
    """How a listing page of a source names its recipe pages.

    `body` says what the stored body is: HTML, JSON around HTML, or plain JSON. `find` maps
    the selection on the page, the stored body and the page URL to a list of URLs.
    """

    body: str
    find: Callable[[Selection, Column, Column], Column]


@dataclass(frozen=True)
class Categories:
    """Listings by category and window of items.

    `listing` is the URL template of a listing page with {category}, {start} and {end} for the
    number of the category and the first and last item; `window` is the number of items of a
    page; `rows` has the name, number and count of listing pages of each category.
    """

    listing: str
    window: int
    rows: tuple[tuple[str, str, str], ...]

    @property
    def prefix(self) -> str:
        return self.listing.split("{", 1)[0]


@dataclass(frozen=True)
class SourceSpec:
    """One source of pages.

    parts          named node lists and texts of a page, evaluated once
    fields         record columns from the parts; a column left out is an absent key.
                   "absent_keys" may be given for keys that are absent on some pages only
    lost_if        (reason, condition) pairs; a page that meets one gives no record
    links          link discovery on listing pages
    recipe_prefix  URL prefix of recipe pages; None when a page is a recipe because a
                   listing links to it
    listings       URL templates of listing pages with one %s for the page number
    categories     listings by category; a run of the source then names one
    decompose      apply NFKD to the steps
    sequential     a run over its listings ends at the first empty page
    """

    name: str
    parts: Callable[[Selection], dict[str, Column]]
    fields: Callable[[Column], dict[str, Column]]
    lost_if: Callable[[Column], list[tuple[str, Column]]] = lambda p: []
    links: Links | None = None
    recipe_prefix: str | None = None
    listings: tuple[str, ...] = ()
    categories: Categories | None = None
    decompose: bool = False
    sequential: bool = False

    def record(self, page: Selection) -> Column:
        """The record of a page as one struct with a `reason`, null unless the page is lost."""
        parts = F.struct(*[c.alias(n) for n, c in self.parts(page).items()])
        return let(parts, lambda p: record(self.fields(p), self.lost_if(p)))


_REGISTRY: dict[str, SourceSpec] = {}


def register_source(spec: SourceSpec) -> SourceSpec:
    _REGISTRY[spec.name] = spec
    return spec


def registered_sources() -> list[SourceSpec]:
    return list(_REGISTRY.values())
