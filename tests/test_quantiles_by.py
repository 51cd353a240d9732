"""Quantiles of many variables and groups against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.operators import quantiles as Q

AT = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)


def frame(spark, n, seed):
    draw = np.random.default_rng(seed)
    rows = [(None if draw.random() < 0.1 else int(draw.integers(2009, 2012)), float(draw.normal()), float(draw.integers(0, 4)),
             None if draw.random() < 0.5 else float(draw.choice([-1.0, -5.0, 2.5, 7.0])), float(np.exp(draw.normal() * 4))) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "syear int, a double, b double, c double, d double").repartition(5)


@pytest.mark.parametrize("n, accuracy", [(1, 2000), (7, 2000), (500, 2000), (500, 10), (6000, 50), (6000, 2000)])
def test_equal_to_numpy(spark, n, accuracy):
    rows, df = frame(spark, n, n + accuracy)
    got = {(r.syear, r.variable, r.q): (r.n, r.value) for r in Q.quantiles_by(df, ["a", "b", "c", "d"], AT, ["syear"], accuracy).collect()}
    want = {}
    for year in {r[0] for r in rows}:
        for i, v in enumerate("abcd", 1):
            values = [r[i] for r in rows if r[0] == year and r[i] is not None and r[i] not in range(-8, 0)]
            if values:
                want |= {(year, v, q): (len(values), pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-12)) for q in AT}
    assert got == want


def test_without_groups_and_without_values(spark):
    _, df = frame(spark, 300, 2)
    one = {(r.variable, r.q): r.value for r in Q.quantiles_by(df, ["a", "b"]).collect()}
    assert one[("b", 0.5)] == df.selectExpr("percentile(b, 0.5)").first()[0] and len(one) == 6
    assert Q.quantiles_by(df.limit(0), ["a"]).collect() == [] == Q.quantiles_by(df, []).collect()
    assert Q.quantiles_by(df.withColumn("a", F.lit(-2.0)), ["a"], by=["syear"]).collect() == []


def test_only_values_in_brackets_are_shuffled(spark):
    """Second scan: values within brackets one by one, the rest as a few counts."""
    df = spark.range(200_000).select((F.col("id") % 3).cast("int").alias("g"), F.rand(1).alias("x"))
    assert Q.quantiles_by(df, ["x"], (0.5,), ["g"]).count() == 3
    for r in Q.sketches(df, ["x"], (0.5,), ["g"], 2000).collect():
        low, high = r.brackets[0]
        assert df.where((F.col("g") == r.g) & F.col("x").between(low, high)).count() < 0.005 * r.n


def test_a_bracket_that_misses_fails(spark, monkeypatch):
    sketch = Q.sketches

    def wrong(*args):
        return sketch(*args).withColumn("brackets", F.transform("brackets", lambda b: F.struct((b["low"] - 5).alias("low"), (b["high"] - 5).alias("high"))))

    monkeypatch.setattr(Q, "sketches", wrong)
    with pytest.raises(Exception, match="outside its bracket"):
        Q.quantiles_by(frame(spark, 900, 1)[1], ["a"], (0.5,)).collect()
