"""The pipeline's stages against brute force, each on what the one before kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelweave.llm import learning, quality_mil
from panelweave.session import stage
from tests.llm import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        out.append(stage(step(spark, out[-1], SF), f"chain-{i}"))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_columns(chain):
    for df in chain[1:5]:
        assert df.dtypes == chain[0].dtypes
    assert chain[5].dtypes == [*chain[0].dtypes, ("shard", "int"), ("slot", "bigint")]


def test_quality(spark, chain):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(learning.fold(F.col("doc_id"), 5) != 0)
    model = quality_mil.learn(chain[0], labels)
    docs = chain[0].collect()
    x, begin, words, edges = quality_mil.encode([(r.text or "").encode() for r in docs])
    p, _ = quality_mil.forward(model, x, begin, quality_mil.meanings(model[-1].astype(np.float32), words, edges))
    sure = np.abs(p - 0.3) > 1e-6
    kept = {tuple(r) for r in chain[1].collect()}
    assert all((tuple(r) in kept) == (s >= 0.3) for r, s, ok in zip(docs, p, sure, strict=True) if ok)
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    assert len(bad & {r.doc_id for r in docs}) > 40 > len(bad & {r[0] for r in kept})


def test_near_duplicates(chain):
    texts = [(r.doc_id, r.text) for r in chain[1].collect()]
    want = {i for i, (family, _, _) in brute.families(texts).items() if family == i}
    assert sorted(r.doc_id for r in chain[2].collect()) == sorted(want)
    assert set(rows(chain[2])) <= set(rows(chain[1]))


def test_decontamination(spark, chain):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in chain[2].collect()]
    found = {i for i, _ in brute.leaks(docs, items)}
    assert found and rows(chain[3]) == [r for r in rows(chain[2]) if r[0] not in found]


def test_mix(chain):
    words = lambda t: len(brute.WORD.findall(t or ""))
    before, after = chain[3].collect(), chain[4].collect()
    sizes = {s: sum(words(r.text) for r in before if r.source == s) for s in {r.source for r in before}}
    taken = {s: sum(words(r.text) for r in after if r.source == s) for s in sizes}
    assert taken == {s: int(t + 1e-9) for s, t in brute.mix_targets(sizes).items()}
    texts = {r.doc_id: r for r in before}
    cut = 0
    for r in after:
        whole = texts[r.doc_id]
        assert whole.text.startswith(r.text) and (r.text != whole.text) == (words(r.text) < words(whole.text))
        assert r.n_chars == (whole.n_chars if r.text == whole.text else len(r.text))
        cut += r.text != whole.text
    assert cut <= len(sizes)


def test_shards(chain):
    got = chain[5]
    assert rows(got.drop("shard", "slot")) == rows(chain[4])
    counts = [r.n for r in got.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).where("n = m + 1").collect()]
    assert len(counts) == 24 and max(counts) - min(counts) <= 1
    assert got.select("shard", "slot").distinct().count() == got.count()


def test_run_gives_the_last_stage(spark, chain):
    again = corpus_pipeline.run(spark, SF)
    assert rows(again) == rows(chain[5])
