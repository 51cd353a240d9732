"""Operators give the same rows whether their small sides are sent to the tasks or shuffled."""

import pytest
from pyspark.sql import functions as F

from panelweave.llm import common, decontaminate, feistel, jaccard_forest, mixing, quality_mil, spelling

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents")


def runs(spark, docs):
    yield "near", lambda: jaccard_forest.near_duplicates(docs).select("doc_id", "class_id", "copies", "n_links")
    yield "leaks", lambda: decontaminate.leaks(docs, common.table(spark, SF, "benchmark"))
    yield "clean", lambda: decontaminate.clean(docs, common.table(spark, SF, "benchmark")).select("doc_id")
    yield "mix", lambda: mixing.mix(docs, carry=("doc_id",)).select("row.doc_id", "size", "target", "taken")
    yield "shards", lambda: feistel.shard(docs, 5, carry=("doc_id",)).select("row.doc_id", "shard", "slot")
    yield "spelling", lambda: spelling.variants(docs, living=64)
    labels = common.table(spark, SF, "labels")
    yield "quality", lambda: quality_mil.score(docs, quality_mil.learn(docs, labels), carry=(F.col("doc_id"),)).select("row.doc_id", F.round("score", 6))


@pytest.mark.parametrize("bound", ["BROADCAST_ROWS", "BROADCAST_BYTES"])
def test_beyond_either_bound(spark, docs, rows, monkeypatch, bound):
    want = {name: rows(run()) for name, run in runs(spark, docs)}
    monkeypatch.setattr(common, bound, -1)
    for name, run in runs(spark, docs):
        assert rows(run()) == want[name], name
    side = common.small_side(docs.select("doc_id"), "side")
    assert "Hint broadcast" not in side._jdf.queryExecution().logical().toString()


def test_within_both_bounds(docs):
    side = common.small_side(docs.select("doc_id"), "side")
    assert "Hint broadcast" in side._jdf.queryExecution().logical().toString()
