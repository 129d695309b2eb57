"""Incremental runs: the same rows as a batch, nothing twice, late copies skipped."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagelarder.operators.conform import recipes, rejects
from pagelarder.operators.routing import fetch, route
from pagelarder.plans.crawl import chosen_pages, run
from pagelarder.plans.extract import extract
from pagelarder.session import shared_folder
from pagelarder.streaming import incremental
from pagelarder.schema import RECIPES
from pagelarder.streaming.incremental import (
    _packed,
    _unpacked,
    append_batch,
    compact,
    distinct_urls,
    open_state,
    read_done,
    read_links,
    read_seen,
    read_stream,
    start_distinct,
    start_incremental,
)
from pagelarder.streaming.state import State
from tests.test_feed import shuffle_files
from tests.test_sources import INTENSO, PINGO, PORTUGAL, SAPO, VAQUEIRO

LOST = PINGO.replace("instruction-body", "q")


@pytest.fixture
def landing(spark):
    folder = shared_folder(spark, "landing")

    def land(*rows):
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        df.coalesce(1).write.mode("append").parquet(folder)

    return folder, land


P = "https://www.pingodoce.pt/receitas/"
FIRST = [
    (1, P + "a", PINGO),
    (2, P + "a#copy", PINGO),
    (3, P + "lost", LOST),
    (4, "https://www.saborintenso.com/f1", INTENSO),
    (5, "http://elsewhere/", PINGO),
]
SECOND = [(6, P + "a", SAPO), (7, P + "lost", PINGO), (8, "https://lifestyle.sapo.pt/sabores/receitas/x", SAPO)]


def test_a_batch_moves_bodies_of_the_kind_it_looks_for(spark, landing, monkeypatch):
    folder, land = landing
    ahead = [(page_id + 100, url, html) for page_id, url, html in (SEQUENCE[0], *SEQUENCE[4:])]
    land(*FIRST, *ahead)
    given = []

    def spy(pages, chosen):
        given.append({r.kind for r in route(pages.select("url")).select("kind").distinct().collect()})
        return fetch(pages, chosen)

    monkeypatch.setattr(incremental, "fetch", spy)
    out = shared_folder(spark, "out")
    append_batch(spark.read.parquet(folder), out)
    monkeypatch.undo()
    assert {"recipe"} in given and {"other"} in given and all(len(kinds) == 1 for kinds in given)
    assert {r.url for r in read_done(spark, out).collect()} >= {P + "a", POST % 1, POST % 5}
    assert all(".zstd." in name for name in open_state(spark, out).read("done").inputFiles())


def test_incremental_runs(spark, landing):
    folder, land = landing
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")

    def run():
        stream = read_stream(spark, folder)
        start_incremental(stream, out, checkpoint).awaitTermination()
        return read_done(spark, out)

    assert read_done(spark, out).count() == 0
    land(*FIRST)
    done = run()
    assert {r.url for r in recipes(done).collect()} == {FIRST[0][1], FIRST[3][1]}
    assert {r.url for r in rejects(done).collect()} == {P + "lost"}

    batch = extract(route(spark.createDataFrame([FIRST[0], FIRST[3]], "page_id long, url string, html string")))
    assert sorted(recipes(done).collect()) == sorted(recipes(batch).collect())

    assert run().count() == done.count()
    land(*SECOND)
    after = run()
    assert {r.url for r in recipes(after).collect()} == {
        FIRST[0][1], FIRST[3][1], P + "lost", SECOND[2][1],
    }
    # A batch that is run again, as after a lost executor, adds nothing.
    count = after.count()
    append_batch(spark.createDataFrame([SECOND[0], SECOND[2]], "page_id long, url string, html string"), out)
    assert read_done(spark, out).count() == count


def test_pages_that_an_earlier_listing_links_to(spark, landing):
    folder, land = landing
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")

    def run():
        start_incremental(read_stream(spark, folder), out, checkpoint).awaitTermination()
        return {(r.url, r.source, r.dish_type) for r in recipes(read_done(spark, out)).collect()}

    listing = "https://www.vaqueiro.pt/Search/QueryService?category=1&StartIdx=0&EndIdx=11"
    body = '{"bodydata":{"Results":[{"Url":"/receitas/x"},{"Url":"/receitas/y"}]}}'
    site = "https://www.vaqueiro.pt/receitas/"
    land((1, listing, body), (2, site + "x", VAQUEIRO), (3, site + "z", VAQUEIRO))
    assert run() == {(site + "x", "vaqueiro", "sopas")}
    land((4, site + "y", VAQUEIRO), (5, site + "x#2", VAQUEIRO), (6, listing, body))
    assert run() == {(site + "x", "vaqueiro", "sopas"), (site + "y", "vaqueiro", "sopas")}
    assert read_links(spark, out).count() == 2


def test_distinct_urls_across_batches(spark, landing):
    folder, land = landing
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")
    for rows in (FIRST, SECOND):
        land(*rows)
        query = (
            distinct_urls(read_stream(spark, folder)).select("url_key").writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        )
        query.awaitTermination()
    keys = [r.url_key for r in spark.read.parquet(out).orderBy("url_key").collect()]
    assert len(keys) == len(set(keys)) == 5
    assert spark.read.parquet(out).filter(F.col("url_key").contains("#")).count() == 0


def test_recipes_that_land_before_their_listing(spark, landing):
    folder, land = landing
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")

    def run():
        start_incremental(read_stream(spark, folder), out, checkpoint).awaitTermination()
        return sorted((r.url, r.dish_type) for r in recipes(read_done(spark, out)).collect())

    listing = "https://www.vaqueiro.pt/Search/QueryService?category=1&StartIdx=0&EndIdx=11"
    body = '{"bodydata":{"Results":[{"Url":"/receitas/x"},{"Url":"/receitas/y"}]}}'
    site = "https://www.vaqueiro.pt/receitas/"
    land((1, site + "x", VAQUEIRO), (2, site + "z", VAQUEIRO))
    assert run() == []
    land((3, site + "x#late", VAQUEIRO))
    assert run() == []
    land((4, listing, body))
    assert run() == [(site + "x", "sopas")]
    land((5, site + "y", VAQUEIRO), (6, listing, body))
    assert run() == [(site + "x", "sopas"), (site + "y", "sopas")]


SAPO_SITE = "https://lifestyle.sapo.pt"


def _listing(*paths):
    return "".join(f'<article class="recipe"><a href="{p}">t</a></article>' for p in paths)


# The listing names a dossier, which names a second one and a recipe, which names the first again.
NESTED = [
    (1, SAPO_SITE + "/pesquisar?pagina=1&q=&filtro=receitas", _listing("/sabores/dossier/1")),
    (2, SAPO_SITE + "/sabores/dossier/1", _listing("/sabores/dossier/2", "/sabores/receitas/x")),
    (3, SAPO_SITE + "/sabores/dossier/2", _listing("/sabores/dossier/1", "/sabores/receitas/y")),
    (4, SAPO_SITE + "/sabores/dossier/3", _listing("/sabores/receitas/z")),
    (5, SAPO_SITE + "/sabores/receitas/x", SAPO),
    (6, SAPO_SITE + "/sabores/receitas/y", SAPO),
    (7, SAPO_SITE + "/sabores/receitas/z", SAPO),
]


def test_nested_listings_of_a_run(spark):
    pages = spark.createDataFrame(NESTED, "page_id long, url string, html string")
    runs = spark.createDataFrame([("sapo_sabores", "1", "1", None)],
                                 "source string, page_start string, page_end string, category string")
    assert sorted(r.page_id for r in chosen_pages(pages, runs).collect()) == [5, 6]


@pytest.mark.parametrize("order", [(2, 1, 0), (0, 1, 2), (1, 2, 0)])
def test_nested_listings_land_in_any_order(spark, landing, order):
    folder, land = landing
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")
    for at in order:
        land(NESTED[at])
        start_incremental(read_stream(spark, folder), out, checkpoint).awaitTermination()
    urls = {r.url for r in read_links(spark, out).collect()}
    assert urls == {SAPO_SITE + "/sabores/" + p for p in ("dossier/1", "dossier/2", "receitas/x", "receitas/y")}
    assert read_done(spark, out).count() == 0


EMPTY = '{"type":"empty"}'
POSTS = "http://www.receitasdeportugal.com/?infinity=scrolling&page=%d"
POST = "http://www.receitasdeportugal.com/receita-%d/"


def _posts(*numbers):
    return '{"type":"success","postflair":{%s}}' % ",".join(f'"{POST % n}":["a"]' for n in numbers)


# Pages 1 to 4 of a sequence whose third page is empty; receita-2 stands on both sides of the cut.
SEQUENCE = [
    (1, POSTS % 1, _posts(1, 5)),
    (2, POSTS % 2, _posts(2)),
    (3, POSTS % 3, EMPTY),
    (4, POSTS % 4, _posts(2, 3, 4)),
    *[(10 + n, POST % n, PORTUGAL) for n in (1, 2, 3, 4, 5)],
]
CUT_ORDERS = [([4, 5, 6, 7, 8], [3], [2, 1, 0]), ([2], [3, 6, 7], [0, 1, 4, 5, 8])]


@pytest.mark.parametrize("order", CUT_ORDERS)
def test_a_cut_takes_links_back_in_any_order(spark, landing, order):
    folder, land = landing
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")
    for at, batch in enumerate(order):
        land(*[SEQUENCE[i] for i in batch])
        start_incremental(read_stream(spark, folder), out, checkpoint, buckets=4).awaitTermination()
        if at == 1:
            compact(spark, out)
    assert {r.url for r in recipes(read_done(spark, out)).collect()} == {POST % n for n in (1, 2, 5)}
    assert {r.url for r in read_links(spark, out).collect()} == {POST % n for n in (1, 2, 5)}


def test_a_batch_run_is_cut_at_the_same_page(spark):
    pages = spark.createDataFrame(SEQUENCE, "page_id long, url string, html string")
    runs = spark.createDataFrame([("receitas_portugal", "1", "9", None)],
                                 "source string, page_start string, page_end string, category string")
    assert {r.url for r in recipes(run(pages, runs)).collect()} == {POST % n for n in (1, 2, 5)}


def test_a_cut_that_lands_late_and_a_link_that_brings_a_page_back(spark, landing):
    folder, land = landing
    out, checkpoint = shared_folder(spark, "out"), shared_folder(spark, "checkpoint")

    def run_batch(*rows):
        land(*rows)
        start_incremental(read_stream(spark, folder), out, checkpoint, buckets=4).awaitTermination()
        return {r.url for r in recipes(read_done(spark, out)).collect()}

    assert run_batch(SEQUENCE[0], SEQUENCE[3], *SEQUENCE[4:]) == {POST % n for n in (1, 2, 3, 4, 5)}
    assert run_batch(SEQUENCE[2]) == {POST % n for n in (1, 5)}
    rows = open_state(spark, out).read("done").count()
    assert run_batch(SEQUENCE[1]) == {POST % n for n in (1, 2, 5)}
    assert open_state(spark, out).read("done").count() == rows  # nothing is extracted again


def _files_read(df) -> int:
    """Files that the scans of an executed query opened."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_lookups_read_the_buckets_of_their_keys(spark):
    state = State(spark, shared_folder(spark, "state"), {"t": "url_key string, n int"}, 16)
    rows = spark.range(2000).selectExpr("concat('u', id) AS url_key", "cast(id AS int) AS n")
    for part in range(3):
        state.append("t", rows.where(F.col("n") % 3 == part))
    one = rows.where("n = 7")
    whole, found = state.read("t"), state.read("t", one)
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().toString()
    assert _files_read(found) <= 3 < 16 <= _files_read(whole)
    assert found.where("url_key = 'u7'").count() == 1 and whole.count() == 2000
    state.replace({"t": whole.drop("bucket")})
    again = State(spark, state.folder, {"t": "url_key string, n int"})
    assert again.buckets == 16 and _files_read(again.read("t", one)) == 1 and again.read("t").count() == 2000
    again.replace({"t": again.read("t").where("n < 10")})
    assert State(spark, state.folder, {"t": "url_key string, n int"}).read("t").count() == 10
    with pytest.raises(ValueError):
        State(spark, state.folder, {"t": "url_key string, n int"}, 8)


def test_bounded_duplicate_filter(spark):
    """Two batches with the same URLs and a third one later, when the stream has forgotten them."""
    landing, out, checkpoint = (shared_folder(spark, p) for p in ("landing", "urls", "checkpoint"))
    states = []
    for batch in range(3):
        rows = [(f"http://x/{i % 30}#{batch}", "2024-01-01") for i in range(40)] if batch != 1 else [("http://x/new", "2024-01-02")]
        spark.createDataFrame(rows, "url string, landed string").withColumn(
            "landed", F.col("landed").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("url string, landed timestamp").parquet(landing)
        query = start_distinct(stream, out, checkpoint, "1 second", buckets=4)
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(2)
    assert sorted(r.url_key for r in read_seen(spark, out).collect()) == sorted(
        [f"http://x/{i}" for i in range(30)] + ["http://x/new"]
    )
    assert states[1] < states[0] and max(states) <= 31


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_a_batch_leaves_no_shuffle_files_and_done_is_read_without_moving(spark):
    out, setting = shared_folder(spark, "out"), spark.conf.get(CLEANUP)
    batch = spark.createDataFrame([*FIRST, *SEQUENCE], "page_id long, url string, html string")
    before = shuffle_files(spark)
    append_batch(batch, out, until_empty=False)
    compact(spark, out)
    assert shuffle_files(spark) <= before and spark.conf.get(CLEANUP) == setting
    done = read_done(spark, out)
    assert "Exchange" not in done._jdf.queryExecution().toString()
    assert {r.url for r in recipes(done).collect()} >= {P + "a", POST % 1}


def test_lists_of_done_are_stored_as_one_text_and_read_as_they_were(spark):
    empty = {f.name: None for f in RECIPES}
    lists = [(["a", None, "é\n\u0001"], [], ["x" * 21_000_000]), (None, ["q"], []), (None, None, None)]
    rows = [empty | dict(zip(("ingredients", "quantities", "steps"), row, strict=True)) for row in lists]
    table = spark.createDataFrame([tuple(r.values()) for r in rows], RECIPES).select("ingredients", "quantities", "steps")
    packed = _packed(table)
    assert packed.where("ingredients IS NULL AND quantities IS NULL AND steps IS NULL").count() == 3
    assert [tuple(r) for r in _unpacked(packed).collect()] == lists
    # Rows that an earlier version has stored have their lists in columns.
    assert [tuple(r) for r in _unpacked(table.withColumn("lists", F.lit(None).cast("string"))).collect()] == lists


def test_compaction_leaves_records_alone_if_none_came(spark):
    out = shared_folder(spark, "out")

    def batch(*rows):
        append_batch(spark.createDataFrame(rows, "page_id long, url string, html string"), out, buckets=2)
        compact(spark, out)
        return open_state(spark, out).path("done").rsplit("-", 1)[-1], {r.url for r in recipes(read_done(spark, out)).collect()}

    def kept():
        return sorted(p.name for p in (Path(out) / "done").iterdir() if p.name.startswith("generation"))

    assert batch(FIRST[0], FIRST[1]) == ("1", {P + "a"})
    assert batch((90, SAPO_SITE + "/sabores/receitas/x", SAPO)) == ("2", {P + "a", SAPO_SITE + "/sabores/receitas/x"})
    assert kept() == ["generation-1", "generation-2"]
    assert batch((91, "http://nowhere/", SAPO)) == ("2", {P + "a", SAPO_SITE + "/sabores/receitas/x"})
    assert kept() == ["generation-2"]
    assert batch((92, P + "b", PINGO))[0] == "3" and kept() == ["generation-2", "generation-3"]
