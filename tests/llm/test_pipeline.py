"""The pipeline's stages on the small tables, and the queries next to their SQL."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from checks.compare import difference
from pagelarder.llm import quality
from pagelarder.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(spark, name):
    query, sql = QUERIES[name]
    assert difference(spark, SF, query, sql) is None


def test_stages(spark):
    """Each stage keeps, drops or repeats whole rows as its operator says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = {tuple(r) for r in docs.collect()}
    weights = quality.fit(docs, labels)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality classifier", "near-duplicates", "benchmark decontamination", "source mixing", "token shards"
    ]
    good = stages["quality classifier"](spark, docs, SF)
    assert {tuple(r) for r in good.collect()} == {
        r for r in before if quality.score(weights, r[1]) >= quality.THRESHOLD
    }
    unique = stages["near-duplicates"](spark, docs, SF)
    assert unique.columns == docs.columns
    kept = {r[0] for r in QUERIES["op10_near_dedup"][0](spark, SF).where("kept").collect()}
    assert {r.doc_id for r in unique.collect()} <= kept
    clean = {r.doc_id for r in stages["benchmark decontamination"](spark, docs, SF).collect()}
    bad = {r.doc_id for r in QUERIES["op1_decontamination"][0](spark, SF).collect()}
    assert clean == {r[0] for r in before} - bad
    mix = Counter(r.doc_id for r in stages["source mixing"](spark, docs, SF).collect())
    assert max(mix.values()) == 2
    docs.unpersist()
