"""Plans: what is read, what is moved, and what is evaluated twice."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from checks import record_queries, render
from checks.render import PARTS, SITES, runs, stored_pages
from pagelarder.operators.conform import recipes, rejects
from pagelarder.operators.frontier import dedup_links, delta, first_copies, is_listing, packed_order
from pagelarder.operators.routing import discovered, fetch
from pagelarder.plans.crawl import chosen_pages, listing_pages, run
from pagelarder.operators.select import page
from pagelarder.operators.shred import Reads, _Nodes, shred
from pagelarder.plans.extract import extract
from pagelarder.session import shared_folder
from pagelarder.sources.pages import read_pages, save_snapshot
from pagelarder.sources.spec import registered_sources
from pagelarder.sources.url_index import read_url_index, save_url_index
from tests.test_streaming import SAPO, SAPO_SITE, _files_read, _listing

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    return read_pages(spark, stored_pages(spark, SF))


def test_a_query_stores_the_parts_it_reads(spark):
    """One site costs a site, in files that are packed well and that scans can split; then the rest."""
    sf_dir = shared_folder(spark, "sf")
    spark.range(0, 100, 1, 3).selectExpr(
        "id AS doc_id", "'a<b\nc' AS text", "'pt' AS lang", "'s' AS source", "5L AS n_chars"
    ).write.parquet(f"{sf_dir}/documents.parquet")

    def parts(folder):
        found = spark.read.parquet(folder).select("site", F.input_file_name().alias("file")).distinct()
        return {r.site: r["count"] for r in found.groupBy("site").count().collect()}

    folder = stored_pages(spark, sf_dir, ["vaqueiro"])
    assert parts(folder) == {"vaqueiro": 3}  # the tasks that read the documents wrote the pages
    assert all(".zstd." in name for name in spark.read.parquet(folder).inputFiles())
    assert stored_pages(spark, sf_dir) == folder and parts(folder).keys() == set(PARTS)
    assert read_pages(spark, folder).count() == 6 * 100 + 6 * 5


def _small_tables(spark) -> str:
    sf_dir = shared_folder(spark, "sf")
    spark.range(0, 20, 1, 2).selectExpr(
        "id AS doc_id", "concat('x', id, '\n', 'y') AS text", "'pt' AS lang", "'s' AS source", "5L AS n_chars"
    ).write.parquet(f"{sf_dir}/documents.parquet")
    return sf_dir


def test_records_of_all_sites_need_no_stored_pages(spark):
    sf_dir = _small_tables(spark)
    found = record_queries.conformed_records(spark, sf_dir)
    assert found.count() > 20 and (spark.sparkContext.applicationId, sf_dir) not in render._STORED
    pages = record_queries.all_pages(spark, sf_dir)
    stored = [record_queries.site_pages(spark, sf_dir, s) for s in SITES]
    assert sorted(pages.collect()) == sorted(r for part in stored for r in part.collect())


def test_job_parts_need_no_stored_pages(spark):
    sf_dir = _small_tables(spark)
    assert record_queries.committed_parts(spark, sf_dir).count() > 0
    assert (spark.sparkContext.applicationId, sf_dir) not in render._STORED


def test_extraction_moves_nothing_and_parses_once(stored):
    extracted = extract(stored.withColumn("source", F.lit("pingo_doce")))
    for df in (recipes(extracted), rejects(extracted), extracted.filter("name = 'x'")):
        text = plan(df)
        assert "Exchange" not in text
        assert text.count("MapInArrow") == 2  # once in the tree, once in the details
        assert text.count("Generate (") == 1 or text.count("Generate inline") <= 1
    narrow = plan(extracted.select("url", "name"))
    assert "page_id:bigint,url:string,html:string" in narrow
    assert "ArrowEvalPython" not in narrow


def test_keys_are_found_without_reading_bodies(stored):
    text = plan(first_copies(stored))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in text
    assert "partial_min" in text and "SortAggregate" not in text


def test_listings_are_filtered_in_the_scan(stored):
    assert "StringStartsWith(url" in plan(stored.filter(is_listing(F.col("url"))))


def test_run_reads_bodies_in_one_scan_without_moving_them(spark, stored):
    text = plan(recipes(run(stored, runs(spark, SF))))
    assert text.count("html:string>") == 1
    assert "Exchange hashpartitioning" not in text
    assert "BroadcastExchange" in text  # the ids, whose table is known to be small


@contextlib.contextmanager
def no_size_based_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def test_bodies_move_by_page_id_only(spark, stored):
    with no_size_based_broadcast(spark):
        text = plan(listing_pages(stored, runs(spark, SF)))
    exchange = r"\(\d+\) Exchange\s*\nInput [^\n]*\bhtml#[^\n]*\nArguments: ([^\n]*)"
    moved = re.findall(exchange, text)
    assert moved
    assert all(m.startswith("hashpartitioning(page_id") for m in moved)


def test_bucketed_snapshot_is_joined_in_place(spark, stored):
    table = "snapshot_" + shared_folder(spark, "t").rsplit("-", 1)[-1]
    save_snapshot(stored, table, buckets=4)
    snapshot = spark.table(table)
    assert snapshot.count() == stored.count()
    with no_size_based_broadcast(spark):
        ids = snapshot.select("page_id").filter("page_id % 2 = 0").repartition(3)
        joined = fetch(snapshot, ids)
        assert plan(joined).count("Arguments: hashpartitioning(page_id") == 1  # the ids
        assert joined.count() == stored.filter("page_id % 2 = 0").count()
    listing = plan(snapshot.filter("kind = 'listing'"))
    assert "PartitionFilters: [isnotnull(kind" in listing


def test_a_snapshot_written_in_place_is_hashed_by_ids(spark):
    """Bodies are neither moved to be stored nor moved or sorted to be picked, by Spark's own settings."""
    table = "snapshot_" + shared_folder(spark, "t").rsplit("-", 1)[-1]
    pages = spark.range(0, 90, 1, 3).selectExpr(
        "id AS page_id", "concat('https://www.pingodoce.pt/receitas/r', id) AS url", "concat('<p>', id) AS html"
    )
    save_snapshot(pages, table, buckets=2, distribute=False, compression="zstd")
    snapshot = spark.table(table)
    assert len(snapshot.inputFiles()) == 3 * 2  # tasks times buckets
    chosen = spark.createDataFrame([(n, "r") for n in range(0, 90, 2)], "page_id long, run_id string").repartition(3)
    key = "spark.sql.join.preferSortMergeJoin"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        with no_size_based_broadcast(spark):
            picked = fetch(snapshot, chosen)
            assert "ShuffledHashJoin" in plan(picked) and "Sort" not in plan(picked)
            assert plan(picked).count("Arguments: hashpartitioning(page_id") == 1  # the ids
            assert {(r.page_id, r.html) for r in picked.collect()} == {(n, f"<p>{n}") for n in range(0, 90, 2)}
    finally:
        spark.conf.set(key, before)


def test_a_run_on_a_snapshot_gives_the_same_records(spark, stored):
    table = "snapshot_" + shared_folder(spark, "t").rsplit("-", 1)[-1]
    save_snapshot(stored, table, buckets=3)
    scans = plan(listing_pages(spark.table(table), runs(spark, SF)))
    assert scans.count("PartitionFilters: [isnotnull(kind") == scans.count("Scan parquet spark_catalog") // 2
    again = recipes(run(spark.table(table), runs(spark, SF)))
    assert sorted(again.collect(), key=str) == sorted(
        recipes(run(stored, runs(spark, SF))).collect(), key=str
    )


def test_chosen_pages_are_unique(spark, stored):
    chosen = chosen_pages(stored, runs(spark, SF))
    assert chosen.count() == chosen.select("page_id").distinct().count() > len(SITES)


def test_links_are_made_unique_by_hash(spark):
    rows = [(1, 7, "http://x/a#1"), (1, 3, "http://x/a"), (-5, 9, "http://x/a#2"), (2, 0, "http://X/b"), (None, 4, "http://x/b")]
    links = spark.createDataFrame(rows, "page_id long, pos int, url string")
    found = dedup_links(links, ["page_id", "pos"])
    assert "SortAggregate" not in plan(found)
    assert {(r.url_key, r.page_id, r.pos) for r in found.collect()} == {("http://x/a", -5, 9), ("http://x/b", None, 4)}
    wide = spark.createDataFrame([(1, 2, 3, "http://x/a")], "a long, b long, c long, url string")
    assert packed_order(wide, ["a", "b", "c"]) is None and dedup_links(wide, ["a", "b", "c"]).count() == 1
    numbers = [None, -(1 << 63), -1, 0, 1, (1 << 63) - 1]
    pairs = spark.createDataFrame([(a, b) for a in numbers for b in (0, 1, (1 << 31) - 1)], "a long, b int")
    packed = pairs.select("a", "b", packed_order(pairs, ["a", "b"]).alias("p")).collect()
    order = sorted(packed, key=lambda r: (r.p, (-(1 << 64)) if r.a is None else r.a))
    assert [(r.a, r.b) for r in order[6:]] == [(a, b) for a in numbers[2:] for b in (0, 1, (1 << 31) - 1)]


def test_an_index_finds_pages_without_computing_keys(spark, stored):
    table = "snapshot_" + shared_folder(spark, "t").rsplit("-", 1)[-1]
    save_snapshot(stored, table, buckets=3)
    snapshot = spark.table(table)
    assert "url_key" in snapshot.columns and "regexp" not in plan(first_copies(snapshot))
    save_url_index(snapshot, folder := shared_folder(spark, "index"), 16)
    index = read_url_index(spark, folder)
    assert index.table().count() == stored.select("url").distinct().count()
    links = index.table().select("url_key").limit(1)
    found = discovered(snapshot, links, [], index)
    text = plan(found)
    assert "regexp" not in text and "PartitionFilters: [isnotnull(bucket" in text
    assert "In(url_key" in text or "EqualTo(url_key" in text
    assert found.count() == 1 and _files_read(index.lookup(links)) == 1 < _files_read(index.table())


def test_rounds_read_the_buckets_of_their_links(spark):
    """A chain of dossiers: a run with an index reaches the same pages as one without."""
    site = SAPO_SITE + "/sabores/"
    pages = [(1, SAPO_SITE + "/pesquisar?pagina=1&q=&filtro=receitas", _listing("/sabores/dossier/0"))]
    for n in range(4):
        pages.append((10 + n, f"{site}dossier/{n}", _listing(f"/sabores/dossier/{n + 1}", f"/sabores/receitas/{n}")))
        pages.append((50 + n, f"{site}receitas/{n}", SAPO))
    table = spark.createDataFrame(pages + [(99, site + "receitas/none", SAPO)], "page_id long, url string, html string")
    wanted = spark.createDataFrame([("sapo_sabores", "1", "1", None)],
                                   "source string, page_start string, page_end string, category string")
    index = save_url_index(table, shared_folder(spark, "index"), 8)
    assert sorted(r.page_id for r in chosen_pages(table, wanted, index=index).collect()) == [50, 51, 52, 53]


def test_only_what_selectors_read_leaves_the_shredder(stored):
    """Attributes and classes no source asks for stay in Python, and records are the same."""
    reads = Reads()
    for spec in registered_sources():
        nodes = page("nodes")
        spec.record(nodes)
        assert not nodes.reads.everything, spec.name
        reads |= nodes.reads
    whole, read = _Nodes(), _Nodes(reads)
    for row in stored.where("html LIKE '<%'").limit(300).collect():
        whole.add_page(row.html)
        read.add_page(row.html)
    assert len(whole) == len(read)
    kept, all_of_it = (
        sum(x.flatten().field(c).nbytes for c in ("cls", "classes", "attrs")) for x in (read.to_arrow(), whole.to_arrow())
    )
    print("bytes of attributes and classes:", kept, "of", all_of_it)
    assert kept < 0.5 * all_of_it


def test_selections_note_what_they_read(spark):
    nodes = page("nodes")
    nodes.css("div", "body").map(lambda b: b.child("a").attr("href"))
    nodes.xclass("x y").where_attr("id", "1").not_class("z").head(lambda at: at).strings()
    assert nodes.reads == Reads({"href", "id"}, {"x y", "z"}, {"body"})
    df = spark.createDataFrame([('<p class="a b" id="1" href="2" title="3">t</p>',)], "html string")
    node = shred(df, reads=nodes.reads | Reads(tokens={"b"})).first().nodes[0]
    assert (node.tag, node.cls, node.classes, node.attrs) == ("p", None, ["b"], {"id": "1", "href": "2"})
    # Whoever takes the bare nodes may look at anything.
    assert nodes.nodes is not None and nodes.reads.everything
    node = shred(df, reads=nodes.reads).first().nodes[0]
    assert node.cls == "a b" and len(node.attrs) == 4


def test_earlier_records_do_not_pass_through_the_driver(spark):
    """A table that is small as a file can hold many records: six URLs for each row here."""
    done = spark.range(1000).select(F.explode(F.array(*[F.concat(F.lit(f"http://x{n}/"), "id") for n in range(6)])).alias("url"))
    links = spark.createDataFrame([("http://x1/7",), ("http://x1/no",), (None,)], "url_key string")
    left = delta(links, done, enabled=True)
    assert "Broadcast" not in plan(left) and "SortMergeJoin" in plan(left)
    assert {r.url_key for r in left.collect()} == {"http://x1/no", None}


def test_pages_of_long_ranges_do_not_pass_through_the_driver(spark, stored):
    found = listing_pages(stored, runs(spark, SF))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") >= 2
    assert found.count() > 0
