"""Page ranges, windows, cut-offs, de-duplication, set differences, hot keys."""

import dataclasses

from pyspark.sql import functions as F

from pagelarder.functions.urls import url_key
from pagelarder.plans.crawl import chosen_pages
from pagelarder.sources import receitas_portugal
from pagelarder.sources.spec import Categories

from pagelarder.functions.urls import url_key
from pagelarder.operators import frontier
from pagelarder.operators.frontier import is_listing
from pagelarder.operators.routing import allowed_recipe, discovered, fetch, route

RUNS = "source string, page_start string, page_end string, category string"


def test_seed_urls(spark):
    runs = spark.createDataFrame(
        [("pingo_doce", "5", "7", None), ("pingo_doce", "7", "5", None),
         ("sabor_intenso", "1", " 2", None), ("unknown", "1", "2", None)], RUNS,
    )
    urls = frontier.seed_urls(runs, frontier.template_table(spark)).collect()
    assert sorted(r.page for r in urls if r.source == "pingo_doce") == [5, 6, 7]
    assert len([r for r in urls if r.source == "sabor_intenso"]) == 32
    assert len(urls) == 35
    assert "page=5&query" in min(r.url for r in urls if r.source == "pingo_doce")


def test_category_pages(spark):
    runs = spark.createDataFrame(
        [("vaqueiro", "21", "40", "sopas"), ("vaqueiro", "9", "9", "dietas"), ("vaqueiro", "3", "1", "doces")],
        RUNS,
    )
    rows = frontier.category_pages(runs, frontier.category_table(spark)).collect()
    assert sorted((r.category, r.page, r.start_idx, r.end_idx) for r in rows) == [
        ("dietas", 9, 96, 107), ("doces", 3, 24, 35), ("sopas", 21, 240, 251), ("sopas", 22, 252, 263),
    ]
    assert spark.createDataFrame([], RUNS).transform(frontier.listing_urls).count() == 0


def test_categories_of_a_users_source(spark):
    own = dataclasses.replace(
        receitas_portugal.SPEC, name="own", listings=(),
        categories=Categories("http://own/{category}?from={start}&to={end}", 5, (("soups", "7", "2"),)),
    )
    runs = spark.createDataFrame([("own", "1", "9", "soups"), ("own", "1", "1", "cakes")], RUNS)
    urls = frontier.listing_urls(runs, [own]).collect()
    assert sorted(r.url for r in urls) == ["http://own/7?from=0&to=4", "http://own/7?from=5&to=9"]
    assert [r.reason for r in frontier.run_rejects(runs, [own]).collect()] == ["unknown category"]


def test_page_windows(spark):
    windows = spark.createDataFrame([(1, 25, 10), (5, 3, 2)], "start int, total int, inc int")
    plain = sorted((r.w_start, r.w_end) for r in frontier.page_windows(windows).collect())
    assert plain == [(1, 10), (11, 20), (21, 25)]
    kept = sorted((r.w_start, r.w_end) for r in frontier.page_windows(windows, True).collect())
    assert kept == [(1, 10), (5, 3), (11, 20), (21, 25)]


def test_pages_until_empty(spark):
    rows = [("a", n, n in (4, 6)) for n in range(1, 8)] + [("b", 1, False), ("c", 1, True)]
    pages = spark.createDataFrame(rows, "run string, page int, is_empty boolean")
    empty = pages.filter("is_empty")
    kept = frontier.pages_until_empty(pages, empty, ["run"], "page")
    assert sorted((r.run, r.page) for r in kept.collect()) == [
        ("a", 1), ("a", 2), ("a", 3), ("b", 1),
    ]


def test_runs_do_not_cut_or_empty_each_other(spark):
    """Windows of one source: the empty page of one ends that window alone, and a recipe that two
    windows list is chosen for both."""
    def body(*links):
        keys = ",".join(f'"https://x/{n}":1' for n in links)
        return f'{{"type":"success","postflair":{{{keys}}}}}'

    address = "https://www.receitasportugal.test/%s"
    spec = dataclasses.replace(receitas_portugal.SPEC, name="own", listings=(address,))
    rows = [(1, address % 1, body("a", "b")), (2, address % 2, '{"type":"empty"}'), (3, address % 3, body("a", "c")),
            (11, "https://x/a", ""), (12, "https://x/b", ""), (13, "https://x/c", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    runs = spark.createDataFrame(
        [("own", "1", "2", None), ("own", "3", "3", None), ("other", "1", "1", None), ("own", "x", "1", None)], RUNS
    )
    chosen = chosen_pages(pages, runs, specs=[spec]).collect()
    assert sorted((r.run_id, r.page_id) for r in chosen) == [
        ("own//1/2", 11), ("own//1/2", 12), ("own//3/3", 11), ("own//3/3", 13),
    ]
    lost = frontier.run_rejects(runs, [spec]).collect()
    assert sorted((r.run_id, r.reason) for r in lost) == [
        ("other//1/1", "unknown source"), ("own//x/1", "no page range"),
    ]


def test_url_keys_of_raw_and_encoded_paths(spark):
    rows = [("/receitas/a\u00e7orda", "/receitas/a%C3%A7orda"), ("/a%c3%a7?b", "/a\u00e7?b="), ("/a%2Fb", "/a%2fb"),
            ("/100%", "/100%25"), ("/a b+c", "/a%20b%2Bc")]
    keys = spark.createDataFrame(rows, "a string, b string").select(
        *[url_key(F.concat(F.lit("http://h"), F.col(c))).alias(c) for c in "ab"]
    )
    assert all(r.a == r.b for r in keys.collect())


def test_a_link_that_a_third_of_all_rows_repeat(spark):
    """The hot URL is combined before the shuffle: few rows per key arrive."""
    links = spark.range(0, 90_000, 1, 6).select(
        F.col("id").alias("page_id"),
        F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit("http://h/hot#x"))
        .otherwise(F.concat(F.lit("http://h/"), (F.col("id") % 20_000).cast("string")))
        .alias("url"),
    )
    unique = frontier.dedup_links(links, ["page_id", "pos"])
    first = {}
    for page_id in range(90_000):
        url = "http://h/hot" if page_id % 3 == 0 else f"http://h/{page_id % 20_000}"
        first.setdefault(url, page_id)
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert {r.url_key: r.page_id for r in unique.collect()} == first
    assert "partial_min" in plan and plan.count("Exchange hashpartitioning") == 1


def test_copies_of_a_page_are_fetched_once(spark):
    pages = spark.createDataFrame(
        [(n, "http://h/a?b=1&a=2#" + str(n), f"body {n}") for n in range(50)] + [(99, "http://h/z", "z")],
        "page_id long, url string, html string",
    )
    links = spark.createDataFrame([("http://h/a?a=2&b=1", "s")], "url string, source string")
    found = fetch(pages, discovered(pages, links.withColumn("url_key", url_key(F.col("url"))), ["source"]))
    assert [(r.page_id, r.html, r.source) for r in found.collect()] == [(0, "body 0", "s")]


def test_delta(spark):
    links = spark.createDataFrame([("http://h/a",), ("http://h/b",)], "url string").withColumn(
        "url_key", url_key(F.col("url"))
    )
    done = spark.createDataFrame([("http://H/a#x",), (None,)], "url string")
    assert [r.url for r in frontier.delta(links, done, enabled=True).collect()] == ["http://h/b"]
    assert frontier.delta(links, done).count() == 2


def test_route(spark):
    urls = [
        ("https://www.pingodoce.pt/receitas/r1/", "pingo_doce", "recipe"),
        ("https://www.pingodoce.pt/wp-content/themes/pingodoce/ajax/pd-ajax.php?type=recipe&page=3&query=", "pingo_doce", "listing"),
        ("https://www.saborintenso.com/f20/r1", "sabor_intenso", "recipe"),
        ("https://www.saborintenso.com/chef/caderno-84/&ver=tudo&page=2/", "sabor_intenso", "listing"),
        ("https://lifestyle.sapo.pt/sabores/receitas/r1", "sapo_sabores", "recipe"),
        ("https://lifestyle.sapo.pt/pesquisar?pagina=1&q=&filtro=receitas", "sapo_sabores", "listing"),
        ("https://www.teleculinaria.pt/receitas/page/2/", "teleculinaria", "listing"),
        ("https://www.teleculinaria.pt/receitas/bolo/", None, "other"),
        ("https://www.vaqueiro.pt/Search/QueryService?category=1&StartIdx=0&EndIdx=11", "vaqueiro", "listing"),
        ("http://elsewhere/", None, "other"),
    ]
    df = spark.createDataFrame(urls, "url string, s string, k string")
    for r in route(df).withColumn("listing", is_listing(F.col("url"))).collect():
        assert (r.source, r.kind) == (r.s, r.k), r.url
        assert r.listing == (r.kind == "listing"), r.url
    allowed = df.select(allowed_recipe(F.col("url"), F.lit("pingo_doce")).alias("a"), "k", "s")
    assert [r.a for r in allowed.collect()] == [r[1] == "pingo_doce" and r[2] == "recipe" for r in urls]
