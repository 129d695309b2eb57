"""The JSON Lines feed."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagelarder.operators.conform import combine, from_feed_names, to_feed_names
from pagelarder.schema import RECIPES
from pagelarder.session import drop_folder, shared_folder
from pagelarder.sources.feed import (
    damaged_parts,
    feed_lines,
    parse_feed,
    read_committed_parts,
    read_job_parts,
    read_manifest,
    read_recipes,
    write_job_part,
    write_recipes,
)

LONG = [str(n) for n in range(12)]


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        ("pingo_doce", "u1", 'a "q" \\ \n é', True, "", None, None, "t", None, "", "", LONG, LONG, ["s"], []),
        ("teleculinaria", "u2", None, None, "", "d", None, " ", "1", None, "", [], [], [], ["vegan"]),
        ("sapo_sabores", "u3", "n", False, None, "d", None, "x", "4", None, None, ["a"], ["b"], [], ["gastronomia", "custo"]),
    ]
    return spark.createDataFrame(rows, RECIPES).coalesce(1)


def test_lines(records):
    lines = [json.loads(r.value) for r in feed_lines(records).collect()]
    assert lines[0]["name"] == 'a "q" \\ \n é' and lines[0]["vegan"] is True
    assert lines[0]["ingredients"] == {str(n): str(n) for n in range(12)}
    assert lines[0]["porção"] is None and lines[0]["custo"] == ""
    assert "vegan" not in lines[1] and lines[1]["custo"] is None and lines[1]["ingredients"] == {}
    assert "gastronomia" not in lines[2] and "custo" not in lines[2] and lines[2]["vegan"] is False
    assert list(lines[0]) == [
        "name", "url", "vegan", "gastronomia", "tipo", "dificuldade", "tempo", "porção", "custo",
        "calorias", "ingredients", "quantidade", "preparação",
    ]


@pytest.mark.parametrize("compact", [False, True])
def test_round_trip(spark, records, compact):
    folder = shared_folder(spark, "feed")
    write_recipes(records, folder, compact=compact)
    again = read_recipes(spark, folder)
    assert sorted(again.collect()) == sorted(records.collect())


def test_job_parts(spark, records):
    root = shared_folder(spark, "jobs")
    lines = feed_lines(records).select("value")
    for job in (13, 15, 16):
        lines.withColumn("value", F.replace("value", F.lit(':"u'), F.lit(f':"{job}-u'))).write.text(
            f"{root}/p/2/{job}"
        )
    found = read_job_parts(spark, root, "p", 2, 13, 15)
    assert {r.url.split("-")[0] for r in found.collect()} == {"13", "15"}
    assert found.count() == 6
    for nothing in (("p", 2, 15, 13), ("p", 2, 17, 40), ("p", 3, 1, 99), ("none", 2, 13, 15)):
        assert read_job_parts(spark, root, *nothing).isEmpty()
    assert read_job_parts(spark, root, "p", 2, 0, 10**12).count() == 9
    one, both = (_files(read_job_parts(spark, root, "p", 2, 13, n)) for n in (13, 15))
    assert both == 2 * one > 0


def test_committed_parts(spark, records):
    root = shared_folder(spark, "committed")
    assert read_committed_parts(spark, root, "p", 2, 0, 99).isEmpty()
    assert damaged_parts(spark, root, "p", 2, 0, 99).isEmpty()
    numbered = records.repartition(3)
    for job in (3, 4, 12):
        write_job_part(numbered.withColumn("name", F.lit(f"job {job}")), root, "p", 2, job)
    broken = numbered.withColumn(
        "name", F.when(F.col("url") == "u3", F.raise_error(F.lit("lost")).cast("string")).otherwise("partial")
    )
    with pytest.raises(Exception, match="lost"):
        write_job_part(broken, root, "p", 2, 5)
    # A job whose files are written and whose manifest is not, as when the driver is lost in between.
    feed_lines(numbered).select("value").write.text(f"{root}/p/2/6/deadbeef")

    def names(*jobs):
        return sorted(r.name for r in read_committed_parts(spark, root, "p", 2, *jobs).collect())

    assert names(0, 99) == ["job 12"] * 3 + ["job 3"] * 3 + ["job 4"] * 3
    assert names(4, 11) == ["job 4"] * 3 and names(11, 4) == [] and names(5, 6) == []
    write_job_part(numbered.limit(1).withColumn("name", F.lit("again")), root, "p", 2, 4)
    write_job_part(numbered.where("false"), root, "p", 2, 12)
    assert names(0, 99) == ["again"] + ["job 3"] * 3
    assert damaged_parts(spark, root, "p", 2, 0, 99).isEmpty()
    part = read_manifest(spark, root, "p", 2, 3, 3).where("file is not null").first()
    drop_folder(spark, f"{root}/p/2/3/{part.attempt}/{part.file}")
    assert [tuple(r) for r in damaged_parts(spark, root, "p", 2, 0, 99).collect()] == [(3, part.file, part.lines, 0)]


def _files(df) -> int:
    """Files that the scan of a query opens, after those of other jobs have been left out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.children().apply(0)
    return node.metrics().apply("numFiles").value()


def test_key_order_of_maps_is_numeric(spark):
    line = '{"name":"x","ingredients":{"10":"k","2":"c","0":"a"}}'
    row = parse_feed(spark.createDataFrame([(line,)], "value string")).first()
    assert row.ingredients == ["a", "c", "k"]
    assert "vegan" in row.absent_keys and "ingredients" not in row.absent_keys
    assert row.quantities is None


def test_names_and_union(records):
    renamed = to_feed_names(records)
    assert "porção" in renamed.columns and "servings" not in renamed.columns
    assert from_feed_names(renamed).columns == records.columns
    assert combine(records, records.select(*reversed(records.columns))).count() == 6


def test_compressed_files_are_read_and_counted(spark, records):
    folder, root = shared_folder(spark, "feed"), shared_folder(spark, "parts")
    write_recipes(records, folder, compression="gzip")
    write_job_part(records, root, "p", 2, 1, "gzip")
    back, named = read_recipes(spark, folder), read_manifest(spark, root, "p", 2, 1, 1).where("file is not null")
    assert sorted(back.collect(), key=str) == sorted(records.collect(), key=str)
    assert all(f.endswith(".gz") for f in spark.read.text(folder).inputFiles())
    assert [(r.file[-3:], r.lines) for r in named.collect()] == [(".gz", 3)]
    assert read_committed_parts(spark, root, "p", 2, 1, 1).count() == 3
    assert damaged_parts(spark, root, "p", 2, 1, 1).count() == 0


def shuffle_files(spark) -> int:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(blocks.apply(i).getName().startswith("shuffle_") for i in range(blocks.size()))


def test_a_compact_feed_moves_no_lines(spark, records):
    """Ten small tasks give one file per source, without a shuffle, and nothing is left beside the feed."""
    folder, many = shared_folder(spark, "feed"), records.union(records).repartition(10).cache()
    many.count()
    before = shuffle_files(spark)
    write_recipes(many, folder)
    assert shuffle_files(spark) <= before
    files = [f.rsplit("/", 2)[1] for f in spark.read.text(folder).inputFiles()]
    assert len(files) <= 4 * 3 and set(files) == {f"source={s}" for s in ("pingo_doce", "teleculinaria", "sapo_sabores")}
    assert sorted(read_recipes(spark, folder).collect(), key=str) == sorted(many.collect(), key=str)
    assert not [p for p in Path(folder).parent.iterdir() if p.name.startswith(Path(folder).name + ".")]
    many.unpersist()
