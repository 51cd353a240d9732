"""Descriptive statistics on their edge cases."""

import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.operators import describe, panel, ranges, sample, shares


def years(spark):
    return spark.createDataFrame(
        [(2000, 1.0), (2000, None), (2001, None), (2002, -1.0), (None, 4.0), (2003, 2.0)], "syear int, x double"
    )


def test_summary(spark, rows):
    got = describe.summarise(years(spark), ["x"]).first()
    assert (got.variable, got.n, got.min, got.max) == ("x", 3, 1.0, 4.0)
    assert got.sd == pytest.approx(statistics.stdev([1, 4, 2]))
    one = describe.summarise(years(spark).filter("syear = 2003"), ["x"]).first()
    assert (one.n, one.mean, one.sd) == (1, 2.0, None)


def test_count_by_year(spark, rows):
    # a year of empty answers counts 0, a year of missing codes is absent, a null year is no year
    assert rows(describe.count_by_year(years(spark), ["x"]), "syear", "n") == [(2000, 1), (2001, 0), (2003, 1)]


def test_stats_by_year(spark, rows):
    assert rows(describe.stats_by_year(years(spark), "x"), "syear", "n", "mean") == [(2000, 1, 1.0), (2003, 1, 2.0)]


def test_distribution(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)] + [(0.0, 9.0)] * 3 + [(None, -1.0)], "a double, b double")
    got = dict(tuple(r) for r in describe.category_distribution(df, ["a", "b"]).collect())
    assert got == {"a": "0:38% / 1:62%", "b": "--"}  # 37.5 and 62.5 go to the even number


@pytest.mark.parametrize("most", [1, 5, 256])
@pytest.mark.parametrize("items", [[3.0], [1.0, 2.0], [5.0] * 7, list(range(101)), [1.0, 1.0, 2.0, 9.0, 9.0, 9.5]])
def test_quantiles(spark, items, most):
    df = spark.createDataFrame([(float(v),) for v in items] + [(None,), (-1.0,)], "x double")
    at = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    kept = [float(v) for v in items if not -8 <= v <= -1]
    got = {r.q: r.value for r in describe.quantiles(df, "x", at, most).collect()}
    assert got == pytest.approx({q: float(np.quantile(kept, q)) for q in at})


def test_quantiles_of_nothing(spark):
    got = describe.quantiles(spark.createDataFrame([(None,)], "x double"), "x").collect()
    assert [r.value for r in got] == [None, None, None]


def test_missing_rate(spark):
    assert tuple(describe.missing_rate(years(spark), "x").first()) == (6, 3, 3, 50.0)
    empty = describe.missing_rate(years(spark).limit(0), "x").first()
    assert (empty.total, empty.missing_pct) == (0, None)


def test_shares(spark, rows):
    df = spark.createDataFrame(
        [(2000, 1.0, 1.0), (2000, 0.0, 1.0), (2000, 3.0, 2.0), (2001, None, None), (2001, 3.0, 2.0)],
        "syear int, y double, state double",
    )
    assert rows(shares.share_by_year(df, {"y": "share"})) == [(2000, 0.5), (2001, 0.0)]
    got = shares.share_by_region(df, [2000, 2001], "y", "state", {1: "One"})
    assert rows(got, "state", "y", "state_name") == [(1.0, 50.0, "One")]


def test_panel_structure(spark, rows):
    df = spark.createDataFrame([(1, 2000), (1, 2001), (2, 2000)], "pid long, syear int")
    waves = spark.createDataFrame([(y,) for y in (2000, 2001, 2002)], "syear int")
    size = panel.panel_size(df, waves).first()
    assert (size.observations, size.individuals, size.mean_obs, size.min_obs, size.max_obs) == (3, 2, 1.5, 1, 2)
    assert size.balance == pytest.approx(0.5)
    assert rows(panel.wave_histogram(df)) == [(1, 1, 50.0), (2, 1, 50.0)]


def test_ranges(spark, rows):
    df = spark.createDataFrame([("a", c) for c in (5, 1, 2, 2, 9)] + [("b", 7), ("c", None)], "g string, code int")
    assert rows(ranges.collapse_ranges(df, ["g"], "code")) == [("a", "1--2, 5, 9"), ("b", "7")]


def test_funnel(spark, rows):
    df = spark.createDataFrame([(1.0, 1), (1.0, None), (2.0, 1), (None, 1)], "a double, b int")
    got = sample.funnel(df, {"a is 1": F.col("a") == 1, "b known": F.col("b").isNotNull()})
    assert rows(got) == [(0, "all rows", 4, 0, 4), (1, "a is 1", 4, 2, 2), (2, "b known", 2, 1, 1)]


def test_small_reports(spark):
    df = spark.createDataFrame([(1, 2009, 3.0), (1, 2014, None), (2, 2010, 3.0)], "pid long, syear int, s double")
    assert describe.period_label(df).first()[0] == "2009–2014"
    assert describe.period_label(df, "--").first()[0] == "2009--2014"
    assert [r[0] for r in describe.distinct_years(df).collect()] == [2009, 2010, 2014]
    assert tuple(describe.distinct_people(df).first()) == (3, 2)
    assert tuple(describe.category_coverage(df, "s").first()) == (2, 1)
