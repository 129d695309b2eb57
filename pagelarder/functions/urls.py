"""URL keys for de-duplication and resolution of relative links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import let

_ORIGIN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"


def url_key(url: Column) -> Column:
    """Key under which two URLs count as the same request.

    The fragment is dropped, query pairs are sorted and have a "=", scheme and host are
    lower-cased and an empty path becomes "/". Characters are percent-encoded as UTF-8 where a
    URL can't have them, so raw and encoded spellings agree; an encoded "/" or "&" stays so.
    """
    bare = F.substring_index(url, "#", 1)
    page = F.substring_index(bare, "?", 1)
    origin = F.regexp_extract(page, _ORIGIN, 0)
    path = F.substr(page, F.length(origin) + 1)
    query = F.substr(bare, F.length(page) + 2)
    plain = path.rlike(r"^[A-Za-z0-9.*_/-]*$")
    escaped = F.array_join(F.transform(F.split(path, "/"), _escaped), "/")
    pairs = F.sort_array(F.transform(F.split(query, "&"), _escaped_pair))
    return F.concat(
        F.lower(origin),
        F.when((path == "") & (origin != ""), F.lit("/")).when(plain, path).otherwise(escaped),
        F.when(query != "", F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(F.lit("")),
    )


def _escaped(part: Column) -> Column:
    """A path segment or half a query pair in one spelling; broken escapes are text."""
    decoded = F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    return F.replace(F.url_encode(F.coalesce(decoded, part)), F.lit("+"), F.lit("%20"))


def _escaped_pair(pair: Column) -> Column:
    name = F.substring_index(pair, "=", 1)
    value = F.substr(pair, F.length(name) + 2)
    return F.concat(_escaped(name), F.lit("="), _escaped(value))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of a link found on the page `base`."""
    page = F.substring_index(F.substring_index(base, "#", 1), "?", 1)
    origin = F.regexp_extract(base, _ORIGIN, 0)
    folder = F.when(page == origin, F.concat(origin, F.lit("/"))).otherwise(
        F.regexp_replace(page, r"[^/]*$", "")
    )
    joined = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href == "", base)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^[^/]*", 0), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.substring_index(base, "#", 1), href))
        .otherwise(F.concat(folder, href))
    )
    dotted = r"^[^?#]*/\.\.?(?:[/?#]|$)"
    return let(joined, lambda url: F.when(url.rlike(dotted), _without_dots(url)).otherwise(url))


def _without_dots(url: Column) -> Column:
    """Apply "." and ".." path segments."""
    origin = F.regexp_extract(url, _ORIGIN, 0)
    path = F.regexp_extract(F.substr(url, F.length(origin) + 1), r"^[^?#]*", 0)
    tail = F.substr(url, F.length(origin) + F.length(path) + 1)
    # A dot segment at the end of a path names a folder.
    segments = F.split(F.regexp_replace(path, r"/(\.\.?)$", "/$1/"), "/")
    kept = F.aggregate(
        F.slice(segments, F.lit(2), F.size(segments)),
        F.array().cast("array<string>"),
        lambda done, s: F.when(
            s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    return F.concat(origin, F.lit("/"), F.array_join(kept, "/"), tail)
