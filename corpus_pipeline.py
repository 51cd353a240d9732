"""From raw documents to training shards: five stages, each one operator of ``panelweave.llm``.

Every stage works on all documents that the one before kept; its result is written and
read again. All but the last return the columns of ``documents``; the last adds shard and slot.

Null keys, null and empty texts, repeated rows, empty tables and columns of any name pass through every
stage: documents without words are scored like others, are copies and leaks of nothing and stay in the
mix; of rows equal in key and text one stays; a source may be null; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import decontaminate, feistel, jaccard_forest, learning, mixing, quality_mil
from panelweave.llm.common import table
from panelweave.llm.queries import GOOD
from panelweave.session import delete_folder, new_folder, owned_stages, written

SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(learning.fold(F.col("doc_id"), 5) != 0)
    model = quality_mil.learn(docs, labels, name="pipeline-quality")
    scored = quality_mil.score(docs, model, carry=tuple(docs[f"`{c}`"] for c in docs.columns))
    return scored.where(F.col("score") >= GOOD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each family of near duplicates."""
    return jaccard_forest.one_of_each(docs, name="pipeline-near")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), name="pipeline-leaks")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents of an epoch repeated, the last one of a budget cut."""
    return mixing.mixed(docs, name="pipeline-mix")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot, which take the place of columns so named."""
    placed = feistel.shard(docs, SHARDS, name="pipeline-shards")
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return placed.select(*(F.col("row")[c].alias(c) for c in kept), "shard", "slot")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mix", mix),
    ("sharding", shards),
]

#: A trained model decides in the first stage, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, as a written table.

    What a stage writes on its way is deleted when its result is written, and that when the next one is.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for i, (_, step) in enumerate(STAGES):
        before, path = path, new_folder(spark, f"pipeline-{i}")
        with owned_stages(spark):
            docs = written(step(spark, docs, sf_dir), path)
        if before is not None:
            delete_folder(spark, before)
    return docs
