"""The trained operators on documents that they did not learn from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import language_id, learning, quality_rules
from panelweave.llm.queries import op2, op8, op10

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_fold(spark):
    import zlib
    ids = [0, 1, 17, 123456789, None]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select("i", learning.fold(F.col("i"), 3).alias("f")).collect()
    assert {r.i: r.f for r in got} == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 3 for i in ids}


def test_language(spark, docs):
    got = op8(spark, SF).cache()
    held = got.where("held_out").join(docs.where("lang is not null"), "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("right"))
    n, right = held.agg(F.count("*"), F.sum("right")).first()
    assert n > 200 and right >= 0.97 * n
    assert got.where("score < 0 or score > 1").count() == 0 and got.count() == docs.count()
    again = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in op8(spark, SF).collect()}
    assert again == {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in got.collect()}


def test_language_reads_text_only(spark, docs):
    """Neither the held-out fold nor other columns change a prediction."""
    taught = docs.select(F.col("doc_id").alias("key"), "text", "lang").where(learning.fold(F.col("doc_id"), 3) != 1)
    model = language_id.learn(taught)
    assert model.languages == ["de", "en", "es", "fr"] and (model.table == 0).mean() > 0.5
    moved = docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 1_000_000).withColumn("source", F.lit(None))
    a = {r.n: r.lang_pred for r in language_id.identify(docs, model, carry=(F.md5("text").alias("n"),)).select("row.n", "lang_pred").collect()}
    b = {r.n: r.lang_pred for r in language_id.identify(moved, model, carry=(F.md5("text").alias("n"),)).select("row.n", "lang_pred").collect()}
    assert a == b


def test_grams_do_not_cross_documents():
    features, begin = language_id.grams(["ab1", "", "Ab!", "??", "é"])
    alone = [language_id.grams([t]) for t in ("ab1", "", "Ab!", "??", "é")]
    for i, (own, size) in enumerate(alone):
        assert begin[i + 1] - begin[i] == size[1]
        assert all((f[begin[i]:begin[i + 1]] == g).all() for f, g in zip(features, own, strict=True))


def test_quality(spark, labels):
    got = op10(spark, SF).cache()
    held = got.where("held_out").join(labels, "doc_id")
    n, right = held.agg(F.count("*"), F.sum((F.col("quality") == F.col("predicted")).cast("int"))).first()
    assert n > 50 and right >= 0.95 * n
    assert got.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    ours = {r.doc_id: r.score for r in got.collect()}
    assert ours == pytest.approx({r.doc_id: r.score for r in op10(spark, SF).collect()}, abs=1e-6)


def test_quality_from_a_few_labels(spark):
    """Some seventy labels, a ninth of them bad, are enough."""
    few = "/root/testdata/sf0.001"
    got = op10(spark, few).join(spark.read.parquet(f"{few}/labels.parquet"), "doc_id")
    assert got.where("quality = 0").count() > 5
    assert got.where("quality <> predicted").count() <= 1


def test_rules(spark, docs, labels):
    judged = op2(spark, SF).join(labels, "doc_id")
    wrong_out = judged.where("quality = 1 and not kept and not base_failed").count()
    missed = judged.where("quality = 0 and kept").count()
    assert wrong_out <= 0.02 * labels.where("quality = 1").count()
    assert missed <= 0.15 * labels.where("quality = 0").count()


def test_rules_find_a_planted_conjunction(spark):
    """Bad if long and repetitive; nothing else matters."""
    draw = np.random.default_rng(6)
    rows = []
    for i in range(3000):
        values = dict.fromkeys(quality_rules.FEATURES, 0.0) | {f: float(draw.random()) for f in quality_rules.FEATURES}
        bad = values["n_words"] > 0.6 and values["repeat_share"] > 0.5
        rows.append((i, tuple(values[f] for f in quality_rules.FEATURES), not bad))
    struct = ", ".join(f"{f}: double" for f in quality_rules.FEATURES)
    df = spark.createDataFrame(rows, f"key long, features struct<{struct}>, good boolean")
    learned = quality_rules.learn(df, "planted")
    got = df.select("good", learned.kept().alias("kept"), learned.reason().alias("reason"))
    assert got.where("good <> kept").count() <= 150
    assert {(c.feature, c.above) for c in learned.rules[0]} == {("n_words", True), ("repeat_share", True)}
    assert got.where("not kept and reason is null").count() == 0
