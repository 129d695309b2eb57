"""A source of the users' own, through a whole run and through the registry."""

import pytest
from pyspark.sql import functions as F

from pagelarder import Links, SourceSpec, recipes, register_source, registered_sources, run
from pagelarder.functions.lists import first
from pagelarder.operators import links
from pagelarder.plans.extract import extract, find_links
from pagelarder.sources import spec as registry

MINE = SourceSpec(
    name="mine",
    parts=lambda doc: {"title": first(doc.css("h1").text()), "items": doc.css("li").strings()},
    fields=lambda p: {"name": F.upper(p["title"]), "steps": p["items"]},
    lost_if=lambda p: [("no title", p["title"].isNull())],
    links=Links("html", lambda doc, body, url: links.by_rule(doc.css("nav"), url, r"/item/")),
    listings=("http://my.site/list/%s/",),
)

PAGES = [
    (1, "http://my.site/list/1/", "<nav><a href='/item/a'>a</a><a href='../../item/b#x'>b</a><a href='/o'>o</a></nav>"),
    (2, "http://my.site/list/2/", "<nav><a href='/item/a#again'>a</a><a href='/item/c'>c</a></nav>"),
    (3, "http://my.site/list/3/", "<nav><a href='/item/d'>d</a></nav>"),
    (4, "http://my.site/item/a", "<h1>a</h1><li>1<li>2"),
    (5, "http://my.site/item/b", "<li>lost"),
    (6, "http://my.site/item/c", "<h1>c</h1>"),
    (7, "http://my.site/item/c#copy", "<h1>copy</h1>"),
    (8, "http://my.site/item/d", "<h1>d</h1>"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [("mine", "1", "2", None)],
        "source string, page_start string, page_end string, category string",
    )


def test_run(pages, runs):
    extracted = run(pages, runs, specs=[MINE])
    rows = {(r.page_id, r.name, tuple(r.steps), r.reason) for r in extracted.collect()}
    assert rows == {
        (4, "A", ("1", "2"), None), (5, None, ("lost",), "no title"), (6, "C", (), None),
    }
    record = recipes(extracted).filter("name = 'A'").first()
    assert record.vegan is None and "vegan" in record.absent_keys and "name" not in record.absent_keys


def test_run_skips_earlier_records(spark, pages, runs):
    done = spark.createDataFrame([("http://my.site/item/a?",)], "url string")
    assert {r.page_id for r in run(pages, runs, done=done, specs=[MINE]).collect()} == {5, 6}


def test_registered_source_is_used_by_default(spark, pages, monkeypatch):
    monkeypatch.setattr(registry, "_REGISTRY", dict(registry._REGISTRY))
    register_source(MINE)
    assert MINE in registered_sources()
    found = extract(pages.filter("page_id = 4").withColumn("source", F.lit("mine")))
    assert found.first().name == "A"


def test_mistakes_are_named(pages):
    wrong = SourceSpec(name="w", parts=lambda d: {"x": d.css("a").at}, fields=lambda p: {"title": p["x"]})
    with pytest.raises(ValueError, match="title"):
        extract(pages.withColumn("source", F.lit("w")), [wrong])
    with pytest.raises(ValueError, match="link"):
        find_links(pages, [wrong])
