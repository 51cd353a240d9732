"""Registered queries against brute force on the small tables."""

import pytest
from pyspark.sql import functions as F

from panelweave.llm import secret_scan
from panelweave.llm.queries import CHECKS, QUERIES, op3, op4, op7
from tests.llm import brute
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def more_texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]


def test_all_thirteen_are_registered():
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_as_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), connect(sf), CHECKS[name]) is None


def test_near_duplicates(spark, more_texts):
    got = {r.doc_id: (r.class_id, r.copies, r.n_links) for r in op3(spark, "/root/testdata/sf0.01").collect()}
    assert got == brute.families(more_texts)
    assert any(links for _, _, links in got.values())


def test_leaks(spark, more_texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in op7(spark, "/root/testdata/sf0.01").collect()}
    assert got == pytest.approx(brute.leaks(more_texts, items)) and got


def test_statistics(spark, sf, texts):
    rows = QUERIES["op2_quality_rules"](spark, sf).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert got == {i: brute.statistics(t) for i, t in texts}
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_known_secrets(spark, more_texts):
    rows = op4(spark, "/root/testdata/sf0.01").collect()
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows}
    assert got == {i: brute.known_secrets(t) for i, t in more_texts}
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows)


@pytest.mark.parametrize("text", [
    'token = "abcdef" secret=token:abcdefgh PASSWORD: x', "api_key:'AKIA" + "A1" * 9 + "' ſecret=abcdefgh Key",
    "0123456789abcdef" * 4 + " ÄÖ passwd=ü secret = 'ééé' apikey=------ token==abcdef", "", "password=" * 500, "AKIA" * 8,
    "\U0001f600 token:abcdef0123456789abcdef0123456789",
])
def test_known_spans(spark, text):
    df = spark.createDataFrame([(text,)], "text string").select(secret_scan.known_spans(F.col("text")).alias("s"))
    df = df.select(*(F.expr(f"size(filter(s, x -> x.kind = {k}))") for k in range(3)), F.sha2(secret_scan.digest(F.col("s")), 256))
    assert tuple(df.first()) == brute.known_secrets(text)


def test_random_tokens(spark):
    """Drawn keys are found, words and numbers are not, whatever the alphabet."""
    import random
    draw = random.Random(5)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    prose = "thequickbrownfoxjumpsoverthelazydogandrunsawayintotheforestwhereitsleeps"
    rows = [(i, "key " + "".join(draw.choice(base64) for _ in range(44)) + " end") for i in range(40)]
    rows += [(100 + i, "see " + prose[i:i + 30] + prose[:i] + " end") for i in range(20)]
    rows += [(200 + i, "no " + str(10 ** 30 + i) + " end") for i in range(20)]
    rows += [(300 + i, "Http/" * 9 + " end") for i in range(20)]
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "known", "random").collect()
    hit = {r.doc_id for r in found if r.random}
    assert len(hit & set(range(40))) >= 36 and not hit & set(range(100, 400))
    spans = {r.doc_id: [(s.start, s.end) for s in r.random] for r in found if r.doc_id in hit}
    assert all(s == [(4, 48)] for s in spans.values())
