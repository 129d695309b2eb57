"""Page ranges, windows, routing, link discovery, de-duplication and set differences of URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import expected as sql
from checks.expected import lit
from checks.render import (
    CATEGORY_NAMES,
    EMPTY_EVERY,
    PER_LISTING,
    RECIPE_URLS,
    RUN_CATEGORY,
    SITES,
    pick,
    recipe_url,
    runs,
    stored_pages,
)
from pagelarder.functions.urls import url_key
from pagelarder.operators import frontier, links
from pagelarder.operators.routing import LISTING, allowed_recipe, discovered, fetch, route
from pagelarder.plans.extract import find_links
from pagelarder.sources import (
    pingo_doce,
    receitas_portugal,
    sabor_intenso,
    sapo_sabores,
    teleculinaria,
    vaqueiro,
)
from pagelarder.sources.pages import read_pages

ONE_TEMPLATE = {
    "pingo_doce": pingo_doce.LISTING,
    "receitas_portugal": receitas_portugal.LISTING,
    "sapo_sabores": sapo_sabores.LISTING,
    "teleculinaria": teleculinaria.LISTING,
}
NOTEBOOK_TEMPLATES = [sabor_intenso.LISTING.format(n) for n in sabor_intenso.NOTEBOOKS]


def _templates_sql() -> str:
    rows = [*ONE_TEMPLATE.items(), *[("sabor_intenso", t) for t in NOTEBOOK_TEMPLATES]]
    return "templates(source, template) AS (VALUES " + ", ".join(
        f"({lit(s)}, {lit(t)})" for s, t in rows
    ) + ")"


def _categories_sql() -> str:
    return "categories(category, category_id, max_pages) AS (VALUES " + ", ".join(
        f"({lit(c)}, {lit(n)}, {m})" for c, n, m in vaqueiro.CATEGORIES
    ) + ")"


def _order_runs(spark: SparkSession, sf_dir: str, sources: list[str]) -> DataFrame:
    """One run per order, with ranges of 0 to 4 pages given as text."""
    start = F.col("o_custkey") % 9
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        pick(sources, F.col("o_orderkey")).alias("source"),
        start.cast("string").alias("page_start"),
        (start + F.col("o_orderkey") % 5 - 1).cast("string").alias("page_end"),
    )


def _order_runs_sql(sources: list[str]) -> str:
    return (
        f"runs AS (SELECT o_orderkey, {sql.pick(sources, 'o_orderkey')} AS source, "
        "o_custkey % 9 AS page_start, o_custkey % 9 + o_orderkey % 5 - 1 AS page_end FROM orders)"
    )


def seed_urls(spark, sf_dir):
    orders = _order_runs(spark, sf_dir, list(ONE_TEMPLATE))
    return frontier.seed_urls(orders, frontier.template_table(spark)).select(
        "o_orderkey", "source", "page", "url"
    )


def _seed_sql(sources: list[str]) -> str:
    return (
        f"WITH {_templates_sql()}, {_order_runs_sql(sources)}, p AS (SELECT *, "
        "unnest(range(page_start, page_end + 1))::INT AS page FROM runs) "
        "SELECT o_orderkey, source, page, replace(template, '%s', page::VARCHAR) AS url "
        "FROM p JOIN templates USING (source)"
    )


def seed_urls_templates(spark, sf_dir):
    orders = _order_runs(spark, sf_dir, ["sabor_intenso"])
    return frontier.seed_urls(orders, frontier.template_table(spark)).select(
        "o_orderkey", "source", "page", "url"
    )


def category_pages(spark, sf_dir):
    start = F.col("o_custkey") % 80 + 1
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        pick(CATEGORY_NAMES, F.col("o_orderkey")).alias("category"),
        start.cast("string").alias("page_start"),
        (start + F.col("o_orderkey") % 30 - 5).cast("string").alias("page_end"),
    )
    found = frontier.category_pages(orders, frontier.category_table(spark))
    return frontier.category_urls(found).select(
        "o_orderkey", "category", "page", "start_idx", "end_idx", "url"
    )


CATEGORY_PAGES_SQL = f"""WITH {_categories_sql()}, runs AS (SELECT o_orderkey,
{sql.pick(CATEGORY_NAMES, 'o_orderkey')} AS category, o_custkey % 80 + 1 AS ps,
o_custkey % 80 + 1 + o_orderkey % 30 - 5 AS pe FROM orders),
p AS (SELECT *, unnest(range(ps, greatest(ps, least(pe, max_pages)) + 1))::INT AS page
FROM runs JOIN categories USING (category))
SELECT o_orderkey, category, page, (page - 1) * 12 AS start_idx, page * 12 - 1 AS end_idx,
'{vaqueiro.LISTING}?category=' || category_id || '&StartIdx=' || (page - 1) * 12 || '&EndIdx=' || (page * 12 - 1) AS url
FROM p"""


def page_windows(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey",
        (F.col("p_partkey") % 40).cast("int").alias("start"),
        F.col("p_size").alias("total"),
        (F.col("p_size") % 7 + 1).alias("inc"),
    )
    plain = frontier.page_windows(part).withColumn("keep_empty", F.lit(False))
    kept = frontier.page_windows(part, keep_empty=True).withColumn("keep_empty", F.lit(True))
    return plain.unionByName(kept).select("p_partkey", "keep_empty", "w_start", "w_end")


PAGE_WINDOWS_SQL = """WITH r AS (SELECT p_partkey, (p_partkey % 40)::INT AS start, p_size AS total, p_size % 7 + 1 AS inc FROM part),
w AS (SELECT *, unnest(range(start, total + 1, inc))::INT AS w_start FROM r),
a AS (SELECT p_partkey, w_start, least(w_start + inc - 1, total)::INT AS w_end FROM w)
SELECT p_partkey, false AS keep_empty, w_start, w_end FROM a
UNION ALL SELECT p_partkey, true, w_start, w_end FROM a
UNION ALL SELECT p_partkey, true, start, total FROM r WHERE start > total"""


def run_rejects(spark, sf_dir):
    """Runs that name no listing page: an unknown source or category, or no range."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    named = orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        pick(["pingo_doce", "nowhere", "vaqueiro"], F.col("o_orderkey")).alias("source"),
        pick([CATEGORY_NAMES[0], "none"], F.col("o_custkey")).alias("category"),
        F.when(F.col("o_custkey") % 7 == 0, "x").otherwise("1").alias("page_start"),
        F.lit("3").alias("page_end"),
    )
    return frontier.run_rejects(named)


RUN_REJECTS_SQL = f"""WITH runs AS (SELECT o_orderkey::VARCHAR AS run_id,
{sql.pick(["pingo_doce", "nowhere", "vaqueiro"], 'o_orderkey')} AS source,
{sql.pick([CATEGORY_NAMES[0], "none"], 'o_custkey')} AS category, o_custkey % 7 = 0 AS bad FROM orders)
SELECT run_id, source, category, CASE WHEN source = 'nowhere' THEN 'unknown source'
WHEN source = 'vaqueiro' AND category = 'none' THEN 'unknown category' WHEN bad THEN 'no page range' END AS reason
FROM runs WHERE reason IS NOT NULL"""


def url_keys(spark, sf_dir):
    """Raw and encoded spellings of an address with the first word of each document."""
    word = F.regexp_replace(F.regexp_extract("text", r"^[^ \n]+", 0), "[#?&%=+/~]", "")
    encoded = F.url_encode(word)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        url_key(F.concat(F.lit("HTTP://Ex.com/r/"), word, F.lit("?q="), word, F.lit("&a#f"))).alias("raw"),
        url_key(F.concat(F.lit("http://ex.com/r/"), F.regexp_replace(encoded, "%C3", "%c3"), F.lit("?a=&q="), encoded)).alias("encoded"),
        word.alias("word"),
    )


URL_KEYS_SQL = """WITH w AS (SELECT doc_id,
regexp_replace(regexp_extract(text, '^[^ \\n]+'), '[#?&%=+/~]', '', 'g') AS word FROM documents),
e AS (SELECT *, replace(url_encode(word), '%2A', '*') AS x FROM w)
SELECT doc_id, word, 'http://ex.com/r/' || x || '?a=&q=' || x AS raw,
'http://ex.com/r/' || x || '?a=&q=' || x AS encoded FROM e"""


def missing_listings(spark, sf_dir):
    """Listing pages the runs expect and the stored pages do not have."""
    expected = frontier.listing_urls(runs(spark, sf_dir))
    return frontier.missing_listings(expected, read_pages(spark, stored_pages(spark, sf_dir))).select(
        "source", "page", "url"
    )


_LAST = f"(SELECT max(doc_id) // {PER_LISTING} FROM documents)"
_NUMBER = {c[0]: c[1] for c in vaqueiro.CATEGORIES}[RUN_CATEGORY]
MISSING_LISTINGS_SQL = f"""WITH {_templates_sql()}, p AS (SELECT unnest(range(2, {_LAST} + 1))::INT AS page)
SELECT source, page, replace(template, '%s', page::VARCHAR) AS url FROM p, templates
WHERE source = 'sabor_intenso' AND template <> {lit(NOTEBOOK_TEMPLATES[0])}
UNION ALL SELECT 'vaqueiro', 2, '{vaqueiro.LISTING}?category={_NUMBER}&StartIdx=12&EndIdx=23'
WHERE (SELECT max(doc_id) // {PER_LISTING} + 1 FROM documents) < 2"""


def routed_pages(spark, sf_dir):
    """Source and kind of every stored page and of every raw page."""
    stored = read_pages(spark, stored_pages(spark, sf_dir)).select("page_id", "url")
    raw = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    both = route(stored.unionByName(raw))
    return both.select(
        "page_id", "url", "source", "kind",
        allowed_recipe(F.col("url"), F.col("source")).alias("may_be_recipe"),
    )


def _routed_sql() -> str:
    by_prefix = ("pingo_doce", "sabor_intenso", "sapo_sabores")
    parts = [
        f"SELECT doc_id * 16 + {n} AS page_id, {sql.url(s)} AS url, "
        + (f"{lit(s)} AS source, 'recipe' AS kind" if s in by_prefix else "NULL AS source, 'other' AS kind")
        + ", " + ("true" if s in by_prefix else "NULL::BOOLEAN") + " AS _m FROM documents"
        for n, s in enumerate(SITES)
    ]
    listing = {**ONE_TEMPLATE, "sabor_intenso": NOTEBOOK_TEMPLATES[0]}
    pages = f"(SELECT DISTINCT (doc_id // {PER_LISTING} + 1) AS page FROM documents)"
    for n, s in enumerate(SITES):
        address = (
            f"replace({lit(listing[s])}, '%s', page::VARCHAR)" if s in listing else
            f"'{vaqueiro.LISTING}?category={_NUMBER}&StartIdx=' || (page - 1) * 12 || '&EndIdx=' || (page * 12 - 1)"
        )
        parts.append(
            f"SELECT page * 16 + {8 + n}, {address}, {lit(s)}, 'listing', "
            f"{'false' if s in by_prefix else 'true'} FROM {pages}"
        )
    parts.append("SELECT page_id, url, NULL, 'other', NULL FROM pages")
    return (
        "SELECT page_id, url, source, kind, coalesce(_m, true) AS may_be_recipe FROM ("
        + " UNION ALL ".join(parts) + ")"
    )


def listing_links(spark, sf_dir):
    """Links of all stored listing pages, each source by its own rule."""
    stored = read_pages(spark, stored_pages(spark, sf_dir))
    listings = route(stored).filter(F.col("kind") == LISTING)
    found = find_links(listings.withColumn("category", F.lit(None).cast("string")))
    return found.select("page_id", "source", "pos", "url")


def _listing_links_sql() -> str:
    parts = []
    for n, s in enumerate(SITES):
        last = {
            # A rule gives each URL of a page once; so do the keys of a JSON object.
            "teleculinaria": "AND page > 1",
            "receitas_portugal": f"AND page > 1 AND page % {EMPTY_EVERY} <> 0",
        }
        before, after = RECIPE_URLS[s]
        after = "/#top" if s == "teleculinaria" else after
        body = f"SELECT page * 16 + {8 + n} AS page_id, {lit(s)} AS source, pos, {lit(before)} || d || {lit(after)} AS url"
        own = f"{body} FROM own" + (
            f" WHERE page % {EMPTY_EVERY} <> 0" if s == "receitas_portugal" else ""
        )
        extra = f"{body.replace('|| d ||', '|| 0 ||')} FROM extra WHERE true {last.get(s, '')}"
        parts += [own, extra]
    return (
        f"WITH own AS (SELECT doc_id // {PER_LISTING} + 1 AS page, doc_id AS d, "
        f"(row_number() OVER (PARTITION BY doc_id // {PER_LISTING} ORDER BY doc_id) - 1)::INT AS pos "
        "FROM documents), extra AS (SELECT page, (max(pos) + 1)::INT AS pos FROM own GROUP BY page) "
        + " UNION ALL ".join(f"({p})" for p in parts)
    )


def _variants(spark, sf_dir) -> DataFrame:
    """Three spellings of each page URL: as it is, with a fragment, with reversed query pairs."""
    url = F.col("url")
    bare = F.substring_index(url, "#", 1)
    query = F.when(F.contains(bare, F.lit("?")), F.substring_index(bare, "?", -1))
    reversed_pairs = F.concat(
        F.substring_index(bare, "?", 1), F.lit("?"),
        F.array_join(F.reverse(F.split(query, "&")), "&"), F.lit("#x"),
    )
    pages = read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.select(
        "page_id", F.posexplode(F.array(F.concat(bare, F.lit("#a")), url, F.coalesce(reversed_pairs, url))).alias("pos", "url")
    )


def unique_links(spark, sf_dir):
    return frontier.dedup_links(_variants(spark, sf_dir), ["page_id", "pos"])


_KEY = """split_part(split_part(url, '#', 1), '?', 1) || CASE WHEN contains(split_part(url, '#', 1), '?')
THEN '?' || array_to_string(list_sort(string_split(split_part(split_part(url, '#', 1), '?', 2), '&')), '&') ELSE '' END"""
UNIQUE_LINKS_SQL = f"""WITH k AS (SELECT page_id, split_part(url, '#', 1) || '#a' AS url, {_KEY} AS url_key FROM pages)
SELECT url_key, page_id, 0 AS pos, url FROM k
QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY page_id) = 1"""


def _document_links(spark, sf_dir, table: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return rows.select("doc_id", recipe_url("pingo_doce", F.col("doc_id")).alias("url"))


def new_links(spark, sf_dir):
    """Links without an earlier record, and all of them while the filter is off."""
    found = _document_links(spark, sf_dir, "documents").withColumn("url_key", url_key(F.col("url")))
    done = _document_links(spark, sf_dir, "labels")
    on = frontier.delta(found, done, enabled=True).withColumn("enabled", F.lit(True))
    off = frontier.delta(found, done).withColumn("enabled", F.lit(False))
    return on.unionByName(off).select("doc_id", "url", "enabled")


NEW_LINKS_SQL = f"""SELECT doc_id, {sql.url('pingo_doce')} AS url, true AS enabled FROM documents ANTI JOIN labels USING (doc_id)
UNION ALL SELECT doc_id, {sql.url('pingo_doce')}, false FROM documents"""


def discovered_pages(spark, sf_dir):
    """Bodies of the documents that a label links to."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pages = documents.select(
        F.col("doc_id").alias("page_id"),
        F.concat(recipe_url("pingo_doce", F.col("doc_id")), F.lit("?b=1&a=2#t")).alias("url"),
        F.col("text").alias("html"),
    )
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.concat(recipe_url("pingo_doce", F.col("doc_id")), F.lit("?a=2&b=1")).alias("url"),
        F.col("quality").cast("string").alias("category"),
        F.col("doc_id").alias("page_id"),
    )
    unique = frontier.dedup_links(labels, ["page_id"])
    return fetch(pages, discovered(pages, unique, ["category"])).select(
        "page_id", "category", "html"
    )


DISCOVERED_PAGES_SQL = """SELECT doc_id AS page_id, quality::VARCHAR AS category, text AS html
FROM documents JOIN labels USING (doc_id)"""


def pages_until_empty(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type")
    empty = events.filter("event_type = 'error'")
    return frontier.pages_until_empty(events, empty, ["user_id"], "event_id")


PAGES_UNTIL_EMPTY_SQL = """SELECT user_id, event_id, event_type FROM events QUALIFY coalesce(max((event_type = 'error')::INT)
OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), 0) = 0"""


def json_links(spark, sf_dir):
    """Keys of a JSON map and entries of a JSON array, one body of each form per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    keys = F.format_string(
        '{"type":"%s","postflair":{"http://x/%d":%s,"http://x/u%d":["a"]}}',
        F.when(F.col("event_type") == "error", F.lit("empty")).otherwise(F.col("event_type")),
        "event_id", "props", "user_id",
    )
    array = F.format_string(
        '{"bodydata":{"Results":[{"Url":"/e/%d","n":1},{"n":2},{"Url":"/u/%d"}],"k":%s}}',
        "event_id", "user_id", "props",
    )
    return events.select(
        "event_id",
        F.array_join(links.json_keys(keys), " ").alias("keys"),
        links.is_empty_listing(keys).alias("is_empty"),
        F.array_join(links.json_array(array, "http://x"), " ").alias("entries"),
    )


JSON_LINKS_SQL = """SELECT event_id, CASE WHEN event_type <> 'error' THEN 'http://x/' || event_id || ' http://x/u' || user_id END AS keys,
event_type = 'error' AS is_empty, 'http://x/e/' || event_id || ' http://x/u/' || user_id AS entries FROM events"""

QUERIES = {
    "seed_urls": (seed_urls, _seed_sql(list(ONE_TEMPLATE))),
    "seed_urls_templates": (seed_urls_templates, _seed_sql(["sabor_intenso"])),
    "category_pages": (category_pages, CATEGORY_PAGES_SQL),
    "page_windows": (page_windows, PAGE_WINDOWS_SQL),
    "run_rejects": (run_rejects, RUN_REJECTS_SQL),
    "url_keys": (url_keys, URL_KEYS_SQL),
    "missing_listings": (missing_listings, MISSING_LISTINGS_SQL),
    "routed_pages": (routed_pages, _routed_sql()),
    "listing_links": (listing_links, _listing_links_sql()),
    "unique_links": (unique_links, UNIQUE_LINKS_SQL),
    "new_links": (new_links, NEW_LINKS_SQL),
    "discovered_pages": (discovered_pages, DISCOVERED_PAGES_SQL),
    "pages_until_empty": (pages_until_empty, PAGES_UNTIL_EMPTY_SQL),
    "json_links": (json_links, JSON_LINKS_SQL),
}
