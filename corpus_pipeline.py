"""From documents to token shards: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelarder.llm import contamination, mixing, odd_sketch, quality, token_shards
from pagelarder.llm.common import same, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good stay."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the one with the least doc_id stays."""
    found = odd_sketch.near_duplicates(docs.select("doc_id", "text"), similarity=80)
    gone = found.where(~found.kept).selectExpr("doc_id AS _gone").distinct()
    gone = stored(gone, "gone")
    return docs.join(gone, same(docs["doc_id"], gone["_gone"]), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of the shingles of a benchmark item go."""
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; a row for each sequence of tokens."""
    return token_shards.materialised(spark, docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("source mixing", mixing_stage),
    ("token shards", token_stage),
]

# Training and permutations can't be told in SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
