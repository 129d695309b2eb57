"""Links from listing bodies: JSON around HTML, JSON keys, JSON arrays, containers, rules.

Each function gives one list of URLs per page. A container without a link or a result without
a URL is left out and the rest of the page is kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelarder.functions.lists import first, let
from pagelarder.functions.text import delete
from pagelarder.functions.urls import resolve_url, url_key
from pagelarder.operators.select import Selection


# White space of HTML at either end of an attribute.
_OUTER_SPACE = r"^[\t\n\f\r ]+|[\t\n\f\r ]+$"

# Endings of addresses that rule-based link extraction takes for downloads.
DOWNLOADS = (
    "7z 7zip bz2 rar tar tar.gz xz zip "
    "mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico webp "
    "mp3 wma ogg wav ra aac mid au aiff "
    "3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
    "xls xlsm xlsx xltm xltx potm potx ppt pptm pptx pps doc docb docm docx dotm dotx odt ods odg odp "
    "css pdf exe bin rss dmg iso apk jar sh rb js hta bat cpl msi msp py"
).split()


def unwrap_json_html(body: Column) -> Column:
    """HTML text inside {"data": {"html": ...}}, without line feeds and backslashes."""
    html = F.from_json(body, "data struct<html:string>")["data"]["html"]
    return delete(html, "\r\n", "\\")


def all_links(page: Selection) -> Column:
    return page.css("a").attr("href")


def json_keys(body: Column) -> Column:
    """The keys of "postflair", each once, unless "type" is "empty"."""
    parsed = F.from_json(body, "type string, postflair map<string,string>")
    return F.when(parsed["type"] != "empty", F.array_distinct(F.map_keys(parsed["postflair"])))


def is_empty_listing(body: Column) -> Column:
    return F.from_json(body, "type string")["type"] == "empty"


def json_array(body: Column, root: str) -> Column:
    """"Url" of each entry of "bodydata"."Results", below the site root."""
    parsed = F.from_json(body, "bodydata struct<Results:array<struct<Url:string>>>")
    return _below(root, parsed["bodydata"]["Results"]["Url"])


def per_container(page: Selection, tag: str, token: str, root: str = "") -> Column:
    """First link inside each container."""
    containers = page.css(tag, token)
    return _below(root, containers.map(lambda c: first(c.css("a").attr("href"))))


def by_rule(
    regions: Selection, base: Column, allow: str, deny_endings: tuple[str, ...] = tuple(DOWNLOADS)
) -> Column:
    """Absolute URLs of the links inside the regions that match `allow`, each URL once.

    Links are relative to the page's first `<base href>`, else to `base`. Paths with one of the
    endings are left out. Of links whose `url_key` and fragment agree the first one counts.
    """
    hrefs = regions.descendants(("a", "area")).attr("href")
    denied = r"(?i)^[^/?#]*//[^/?#]*/[^?#]*\.(?:" + "|".join(re.escape(e) for e in deny_endings) + r")(?:[?#]|$)"

    def allowed(url: Column) -> Column:
        return url.rlike(allow) & ~url.rlike(denied) if deny_endings else url.rlike(allow)

    def found(root: Column) -> Column:
        urls = F.transform(hrefs, lambda h: resolve_url(root, F.regexp_replace(h, _OUTER_SPACE, "")))
        return let(F.filter(urls, allowed), _unique)

    return let(_base(regions.whole_page(), base), found)


def _base(page: Selection, url: Column) -> Column:
    href = F.regexp_replace(first(page.css("base").attr("href")), _OUTER_SPACE, "")
    return let(href, lambda h: F.coalesce(resolve_url(url, h), url))


def _unique(urls: Column) -> Column:
    """The first of the URLs that ask for the same and have one fragment."""
    keys = F.transform(
        urls, lambda u: F.concat(url_key(u), F.substr(u, F.length(F.substring_index(u, "#", 1)) + 1))
    )
    return let(keys, lambda k: F.filter(urls, lambda u, i: F.array_position(k, F.get(k, i)) == i + 1))


def _below(root: str, urls: Column) -> Column:
    found = F.filter(urls, lambda u: u.isNotNull())
    return F.transform(found, lambda u: F.concat(F.lit(root), u)) if root else found
