"""Tables from mergeable states against the separate passes."""

import random

import pytest
from pyspark.sql import functions as F

from panelweave.operators import describe, states


@pytest.fixture(scope="module")
def df(spark):
    draw = random.Random(2)
    pick = lambda *v: draw.choice(v)
    rows = [(pick(2009, 2010, 2011, None), pick(None, -1.0, 1e9 + draw.random()), pick(None, 0.0, 1.0, 2.0, -5.0),
             float(draw.randint(0, 9)), pick(True, False, None)) for _ in range(600)]
    return spark.createDataFrame(rows, "syear int, a double, b double, c double, chosen boolean").repartition(3)


def test_merged_states_are_those_of_all_rows(df, rows):
    found = states.moment_states(df, ["a", "b", "c"], ["b", "c"], {"all": F.lit(True), "some": F.col("chosen"), "none": F.lit(False)})
    tidy = lambda d: rows(d.select("variable", "n", F.round("mean", 4), F.round("sd", 4), "min", "max"))
    for name, part in (("all", df), ("some", df.where("chosen")), ("none", df.limit(0))):
        mine = found.where(F.col("sample") == name)
        assert tidy(states.summary(mine)) == tidy(describe.summarise(part, ["a", "b", "c"]))
        assert rows(states.counts_by_year(mine), "variable", "syear", "n") == rows(describe.count_by_year(part, ["a", "b", "c"]), "variable", "syear", "n")
        assert rows(states.distributions(mine), "variable", "distribution") == rows(describe.category_distribution(part, ["b", "c"]), "variable", "distribution")


def test_large_values_keep_their_digits(spark):
    base = spark.range(1000).select((F.col("id") % 7).cast("int").alias("syear"), (1e12 + F.col("id") % 10).alias("a"))
    got = states.summary(states.moment_states(base, ["a"])).first()
    assert got.sd == pytest.approx(2.8737, abs=1e-3) and got.mean == pytest.approx(1e12 + 4.5, abs=1e-3)


def test_one_scan_and_one_shuffle(df, monkeypatch):
    plans = []
    stage = states.stage
    monkeypatch.setattr(states, "stage", lambda d, name: plans.append(d._jdf.queryExecution().executedPlan().toString()) or stage(d, name))
    states.moment_states(df, ["a", "b", "c"], ["b"], {"x": F.col("chosen"), "y": F.lit(True)})
    assert plans[0].count("Exchange") == 1 + plans[0].count("REPARTITION_BY_NUM") and plans[0].count("Scan") == 1


def test_no_rows(df):
    found = states.moment_states(df.limit(0), ["a"], ["a"])
    assert found.count() == 0 and states.summary(found).count() == 0 and states.distributions(found).count() == 0
