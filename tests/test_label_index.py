"""Searches by the trigram index against the scan."""

import random

import pytest
from pyspark.sql import functions as F

from panelweave.operators import codebook, label_index


@pytest.fixture(scope="module")
def book(spark):
    draw = random.Random(8)
    words = ["home", "office", "Arbeit", "ÜBER", "zz", "a", "income", "in", "come", "%x_", "work", "'q'"]
    rows = [(f"s{i % 3}", f"d{i % 3}", f"V{i}", " ".join(draw.choice(words) for _ in range(draw.randint(0, 5))), "x", i) for i in range(400)]
    return spark.createDataFrame([*rows, ("s0", "d0", "", "", "", 400)], "source string, dataset string, variable string, label string, label_de string, position int")


@pytest.fixture(scope="module")
def index(book, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index") / "labels")
    label_index.build(book, folder)
    return folder


@pytest.mark.parametrize("named", [0, 10_000])
@pytest.mark.parametrize("any_", [False, True])
@pytest.mark.parametrize("query", ["home office", "HOME", "ome off", "incomework", "income zz", "zz a", "v39 über", "e o", "nothing here", "", "%x_ 'q'", "home home"])
def test_results_of_the_scan(spark, book, index, rows, monkeypatch, query, any_, named):
    monkeypatch.setattr(label_index, "NAMED", named)
    for source in (None, "s1"):
        want = codebook.search_variables(book, query, source, any_)
        assert rows(label_index.search(spark, index, query, source, any_)) == rows(want)


def test_only_the_lists_of_the_trigrams_are_read(spark, index):
    found = label_index._rows_with(spark, index, ["office"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [shard" in plan
    files = spark.read.parquet(f"{index}/trigrams")
    trigrams = ["off", "ffi", "fic", "ice"]
    shards = [r[0] for r in files.where(F.col("trigram").isin(trigrams)).select("shard").distinct().collect()]
    assert 1 <= len(shards) <= 4 < files.select("shard").distinct().count()


def test_an_empty_codebook(spark, book, tmp_path):
    label_index.build(book.limit(0), str(tmp_path / "none"))
    assert label_index.search(spark, str(tmp_path / "none"), "home").count() == 0
