"""The decision list against a learner in plain Python, and cuts of features that are mostly zero."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import quality_rules as Q
from tests.llm import brute

STRUCT = ", ".join(f"{f}: double" for f in Q.FEATURES)


def frame(spark, rows):
    return spark.createDataFrame([(i, tuple(float(v[f]) for f in Q.FEATURES), bool(g)) for i, (v, g) in enumerate(rows)],
                                 f"key long, features struct<{STRUCT}>, good boolean").repartition(3)


def draws(seed, n):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        values = {f: float(draw.random()) if i % 2 else float(draw.integers(0, 6)) for i, f in enumerate(Q.FEATURES)}
        values["symbol_share"] = float(draw.random() * 0.3) if draw.random() < 0.1 else 0.0
        bad = values["symbol_share"] > 0.02 or (values["n_words"] <= 1 and values["repeat_share"] <= 3) or draw.random() < 0.03
        rows.append((values, not bad))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_list_equals_plain_python(spark, seed):
    rows = draws(seed, 400)
    df = frame(spark, rows)
    pruning = {r.key: r.p for r in df.select("key", (F.pmod(F.xxhash64("key"), F.lit(3)) == 0).alias("p")).collect()}
    want = brute.learn_rules([(v, pruning[i], g) for i, (v, g) in enumerate(rows)], Q.cuts_of(df), Q.MOST_CONDITIONS, Q.MOST_RULES,
                             Q.LEAST_COVERED, Q.LEAST_PRECISION)
    got = [tuple((c.feature, c.above, c.cut) for c in rule) for rule in Q.learn(df, "plain").rules]
    assert got == want and len(got) >= 2


def test_cuts_of_a_feature_that_is_mostly_zero(spark):
    """Nearly all zeros: cuts go down to the least value, and there are enough of them among the rest."""
    rows = [({f: 0.0 for f in Q.FEATURES} | {"symbol_share": 0.01 + i / 1000 if i < 100 else 0.0}, i >= 100) for i in range(3000)]
    cuts = Q.cuts_of(frame(spark, rows))
    assert cuts["symbol_share"][0] == pytest.approx(0.005) and 20 <= len(cuts["symbol_share"]) <= 2 * Q.CUTS + 2
    assert cuts["n_words"] == []
    learned = Q.learn(frame(spark, rows), "zero")
    judged = frame(spark, rows).select("good", learned.kept().alias("kept"))
    assert judged.where("good <> kept").count() == 0


def test_bad_rows_have_cuts_however_few_they_are(spark):
    draw = np.random.default_rng(7)
    rows = [({f: float(draw.random()) for f in Q.FEATURES} | {"digit_share": float(draw.random() * 0.2)}, True) for _ in range(3000)]
    rows += [({f: float(draw.random()) for f in Q.FEATURES} | {"digit_share": 0.3 + 0.001 * i}, False) for i in range(15)]
    cuts = Q.cuts_of(frame(spark, rows))["digit_share"]
    assert any(0.2 < c < 0.3 for c in cuts) and sum(c > 0.3 for c in cuts) >= 10


def test_no_rows_and_no_bad_rows(spark):
    assert Q.learn(frame(spark, draws(1, 5)).where("key < 0"), "none").rules == []
    assert Q.learn(frame(spark, [(v, True) for v, _ in draws(1, 50)]), "good").rules == []
