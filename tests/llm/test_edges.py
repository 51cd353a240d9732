"""Every operator and stage on odd rows, and on tables without rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelweave.llm import (
    decontaminate, feistel, jaccard_forest, language_id, line_dedup, mixing, quality_mil, quality_rules, secret_scan,
    tool_calls,
)


def test_line_dedup_on_odd_rows(odd_documents):
    got = line_dedup.dedup_lines(odd_documents).select("row.doc_id", "row.key", "n_lines", "n_dropped", "text").collect()
    assert len(got) == 15 and all(r.key.startswith("x") for r in got)
    by = {r.key: r for r in got}
    assert by["x4"].text is None and by["x4"].n_lines == 0 and by["x5"].text is None
    assert by["x6"].text == "" and by["x7"].text == " \t\n " and by["x7"].n_lines == 2
    # copies of one key and text keep the same lines; the copy under a later key goes
    assert by["x0"].text == by["x1"].text != "" and by["x0"].n_dropped == by["x1"].n_dropped == 0
    assert by["x10"].text and by["x11"].text == "" and by["x11"].n_dropped == 1
    # one word differs: within the bound
    assert by["x12"].n_dropped == 0 and by["x13"].n_dropped == 1


def test_quality_rules_on_odd_rows(odd_documents, labels):
    judged, learned = quality_rules.judge(odd_documents, labels)
    got = {r.key: r for r in judged.select("row.key", "n_words", "base_failed", "kept", "n_repeat_words").collect()}
    assert len(got) == 15
    assert got["x4"].n_words == got["x6"].n_words == 0 and got["x4"].base_failed and not got["x4"].kept
    assert got["x10"].n_repeat_words == 60_000 and not got["x10"].kept
    assert got["x0"].kept and got["x0"].n_words == 11


def test_near_duplicates_on_odd_rows(odd_documents):
    got = jaccard_forest.near_duplicates(odd_documents).collect()
    assert len(got) == 15
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.class_id for r in by[7] + by[8]} == {7} and by[7][0].copies == 2 and by[7][0].n_links == 0
    assert {(r.class_id, r.n_links) for r in by[9] + by[10]} == {(9, 1)}
    assert {(r.class_id, r.family) for r in by[2] + by[3] + by[4] + by[5]} == {(i, None) for i in (2, 3, 4, 5)}
    assert len({r.family for r in by[1]}) == 2
    assert sorted((r.family is None, r.class_id) for r in by[None]) == [(False, None), (True, None)]


def test_one_of_each_on_odd_rows(odd_documents):
    kept = jaccard_forest.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    rows = sorted(r.key for r in kept.collect())
    # of x0 and x1, equal in key and text, one stays; x11 copies x10 and x13 is near x12
    assert [r for r in rows if r not in ("x0", "x1")] == ["x10", "x12", "x14", *(f"x{i}" for i in range(2, 10))]
    assert len(rows) == 12


def test_secret_scan_on_odd_rows(odd_documents):
    got = secret_scan.scan(odd_documents).select("row.key", F.size("known").alias("n"), "random").collect()
    assert len(got) == 15 and all(r.n == 0 and r.random == [] for r in got)


def test_shards_on_odd_rows(odd_documents):
    got = feistel.shard(odd_documents, 4).select("row.key", "size", "text_crc32", "number", F.col("shard"), F.col("slot")).collect()
    assert sorted(r.number for r in got) == list(range(15))
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s, n in enumerate((4, 4, 4, 3)) for i in range(n)]
    by = {r.key: r for r in got}
    assert by["x4"].size == 8 and by["x4"].text_crc32 == 0 and by["x4"].number in (13, 14)


def test_leaks_on_odd_rows(odd_documents, benchmark):
    got = {(r.doc_id, r.item_id, r.n_words): r for r in decontaminate.leaks(odd_documents, benchmark).collect()}
    assert set(got) == {(1, 1, 10), (9, 1, 7), (10, 1, 7), (9, None, 30), (10, None, 30)}
    assert got[1, 1, 10].similarity == 1.0 and got[9, None, 30].first_word == 20
    left = decontaminate.clean(odd_documents, benchmark)
    assert left.columns == odd_documents.columns
    assert sorted(r.key for r in left.collect()) == sorted(f"x{i}" for i in range(15) if i not in (0, 1, 12, 13))


def test_language_on_odd_rows(odd_documents):
    model = language_id.learn(odd_documents.select(F.col("doc_id").alias("key"), "text", "lang"))
    assert model.languages == ["en", "fr"]
    got = {r.key: r for r in language_id.identify(odd_documents, model, carry=(odd_documents["key"],)).select("row.key", "lang_pred", "score").collect()}
    assert len(got) == 15 and all(0 <= r.score <= 1 for r in got.values())
    assert {k for k, r in got.items() if r.lang_pred == "und"} == {"x4", "x5", "x6", "x7", "x8"}


def test_mix_on_odd_rows(odd_documents):
    got = mixing.mix(odd_documents).select("row.key", "row.source", F.col("size"), "source_size", "target", "taken").collect()
    assert len(got) == 15
    total = {r.source: r for r in got}
    taken = {s: sum(r.taken for r in got if r.source == s) for s in total}
    assert all(taken[s] == int(total[s].target) for s in total) and total[None].target == total["c"].target == 0
    assert all(r.taken <= 2 * r.size for r in got)
    whole = mixing.mixed(odd_documents)
    assert whole.columns == odd_documents.columns
    from panelweave.llm.common import word_count
    assert whole.agg(F.sum(word_count(F.col("text"))).alias("n")).first().n == sum(taken.values())


def test_quality_on_odd_rows(odd_documents, labels):
    model = quality_mil.learn(odd_documents, labels)
    got = quality_mil.score(odd_documents, model, carry=(odd_documents["key"],)).collect()
    assert len(got) == 15 and all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, odd_documents, sf, name, stage):
    got = stage(spark, odd_documents, sf)
    if name == "sharding":
        assert set(got.columns) == set(odd_documents.columns)
        assert got.count() == 15
    else:
        assert got.columns == odd_documents.columns and got.dtypes == odd_documents.dtypes
        assert got.count() > 0


def test_no_documents(spark, no_documents, labels, benchmark):
    assert line_dedup.dedup_lines(no_documents).count() == 0
    judged, learned = quality_rules.judge(no_documents, labels)
    assert judged.count() == 0 and learned.rules == []
    assert jaccard_forest.near_duplicates(no_documents).count() == 0
    assert jaccard_forest.one_of_each(no_documents).count() == 0
    assert secret_scan.scan(no_documents).count() == 0
    assert feistel.shard(no_documents, 3).count() == 0
    assert decontaminate.leaks(no_documents, benchmark).count() == 0
    assert mixing.mixed(no_documents).count() == 0
    model = language_id.learn(no_documents.select(F.col("doc_id").alias("key"), "text", "lang"))
    assert model.languages == [] and language_id.identify(no_documents, model, carry=(F.col("doc_id"),)).count() == 0
    trained = quality_mil.learn(no_documents, labels)
    assert quality_mil.score(no_documents, trained, carry=(F.col("doc_id"),)).count() == 0


def test_nothing_to_compare_with(spark, odd_documents, labels, benchmark):
    assert decontaminate.leaks(odd_documents, benchmark.limit(0)).count() == 0
    judged, learned = quality_rules.judge(odd_documents, labels.limit(0))
    assert learned.rules == [] and judged.where("kept <> (not base_failed)").count() == 0
    scored = quality_mil.score(odd_documents, quality_mil.learn(odd_documents, labels.limit(0)))
    assert scored.count() == 15
    nobody = language_id.learn(odd_documents.where("false").select(F.col("doc_id").alias("key"), "text", "lang"))
    got = language_id.identify(odd_documents, nobody, carry=(F.col("doc_id"),))
    assert got.where("lang_pred <> 'und' or score <> 0").count() == 0


def test_no_messages(spark):
    calls = spark.createDataFrame([], "conv_id long, call_id string, after_id string, name string, arguments string, turn long")
    results = spark.createDataFrame([], "conv_id long, call_id string, content string, turn long")
    assert tool_calls.link(calls, results, {}).count() == 0
