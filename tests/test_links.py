"""Listing bodies and the links they give."""

from pyspark.sql import functions as F

from pagelarder.plans.extract import find_links

LISTINGS = [
    ("pingo_doce", '{"data":{"html":"<a href=\\\\\\"https://www.pingodoce.pt/receitas/a/\\\\\\">A</a>\\r\\n<b><a href=\\\\\\"https://www.pingodoce.pt/receitas/b/\\\\\\">B</a></b>"}}',
     ["https://www.pingodoce.pt/receitas/a/", "https://www.pingodoce.pt/receitas/b/"]),
    ("receitas_portugal", '{"type":"success","postflair":{"http://x/r1":["a"],"http://x/r2":{"k":1}}}',
     ["http://x/r1", "http://x/r2"]),
    ("receitas_portugal", '{"type":"empty"}', []),
    ("receitas_portugal", "<p>no JSON", []),
    ("vaqueiro", '{"bodydata":{"Results":[{"Url":"/receitas/x"},{"n":1},{"Url":"/receitas/y"}]}}',
     ["https://www.vaqueiro.pt/receitas/x", "https://www.vaqueiro.pt/receitas/y"]),
    ("sapo_sabores", '<article class="recipe big"><a href="/sabores/receitas/r1">1</a><a href="/other">o</a></article><article class="news"><a href="/n">n</a></article><article class="recipe">none</article>',
     ["https://lifestyle.sapo.pt/sabores/receitas/r1"]),
    ("sabor_intenso", '<div class="sombra_pub"><a name="t"></a><a href="https://www.saborintenso.com/f20/r1">1</a></div>',
     ["https://www.saborintenso.com/f20/r1"]),
    ("teleculinaria", '<div class="td-block-span6"><h3 class="entry-title td-module-title"><a href="/receitas/bolo/">b</a></h3></div><div class="td-block-span6 x"><h3 class="entry-title td-module-title"><a href="/receitas/no/">n</a></h3></div><div class="td-block-span6"><h3 class="entry-title td-module-title"><a href="/receitas/">r</a><a href=" /receitas/bolo/">again</a></h3></div>',
     ["https://www.teleculinaria.pt/receitas/bolo/"]),
]


def _titles(*hrefs: str, head: str = "") -> str:
    linked = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    return f'{head}<div class="td-block-span6"><h3 class="entry-title td-module-title">{linked}</h3></div>'


SITE = "https://www.teleculinaria.pt"
RULES = [
    # Downloads are no pages; an extension counts at the end of the path alone.
    (_titles("/receitas/a.PDF", "/receitas/b.tar.gz?x=1", "/receitas/c.pdf/", "/receitas/d?f=e.pdf"),
     [f"{SITE}/receitas/c.pdf/", f"{SITE}/receitas/d?f=e.pdf"]),
    # One link of two that ask for the same, in the spelling that came first; fragments differ.
    (_titles("/receitas/a?y=2&x=1", "/receitas/a?x=1&y=2", "/receitas/a?x=1&y=2#top"),
     [f"{SITE}/receitas/a?y=2&x=1", f"{SITE}/receitas/a?x=1&y=2#top"]),
    # Links are relative to the first base of the page, which may itself be relative.
    (_titles("bolo", head='<base href="/receitas/x/"><base href="/other/">'), [f"{SITE}/receitas/x/bolo"]),
    (_titles("bolo", head='<base href="https://img.pt/receitas/">'), ["https://img.pt/receitas/bolo"]),
    (_titles("bolo", head="<base target=_top>"), [f"{SITE}/receitas/page/1/bolo"]),
]


def test_links_by_rule(spark):
    rows = [(n, "teleculinaria", f"{SITE}/receitas/page/1/", body) for n, (body, _) in enumerate(RULES)]
    pages = spark.createDataFrame(rows, "page_id long, source string, url string, html string")
    found = find_links(pages.withColumn("category", F.lit("c")).coalesce(1)).collect()
    for n, (_, expected) in enumerate(RULES):
        assert sorted((r.pos, r.url) for r in found if r.page_id == n) == list(enumerate(expected)), n


def test_links(spark):
    rows = [
        (n, source, f"https://www.{source}.pt/receitas/page/1/", body)
        for n, (source, body, _) in enumerate(LISTINGS)
    ]
    pages = spark.createDataFrame(rows, "page_id long, source string, url string, html string")
    found = find_links(pages.withColumn("category", F.lit("c")).coalesce(1)).collect()
    for n, (_, _, expected) in enumerate(LISTINGS):
        links = sorted((r.pos, r.url) for r in found if r.page_id == n)
        assert links == list(enumerate(expected)), n
