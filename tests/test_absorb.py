"""Absorbed effects against models with dummies, numpy and each other."""

import numpy as np
import pytest

from panelweave.estimation.absorb import _Sums, fit_absorbed
from panelweave.estimation.fit import EstimationError, ModelSpec, fit_models


def panel(n, levels, seed=2, persons=300):
    rng = np.random.default_rng(seed)
    level = rng.integers(0, levels, n)
    pid, a, b = rng.integers(0, persons, n), rng.normal(size=n) + 0.3 * (level % 5), rng.integers(0, 2, n).astype(float)
    eta = 0.7 * a - 0.4 * b + rng.normal(size=levels)[level] * 0.5
    return pid, level, a, b, (eta + rng.logistic(size=n) > 0).astype(float)


def frame(spark, pid, level, a, b, y):
    rows = zip(pid.tolist(), level.astype(float).tolist(), a.tolist(), b.tolist(), y.tolist(), strict=True)
    return spark.createDataFrame(list(rows), "pid long, sector double, a double, b double, y double").repartition(5)


@pytest.mark.parametrize("link", ["logit", "probit", "linear"])
def test_equals_the_model_with_dummies(spark, link):
    df = frame(spark, *panel(1500, 15))
    spec = ModelSpec("(2)", "M", link, "y", ("a", "b"), sector=True)
    dense, got = fit_models(df, [spec])[0], fit_absorbed(df, spec)
    assert got.terms == ["a", "b"] and got.levels == 15 and (got.n, got.clusters) == (dense.n, dense.clusters)
    np.testing.assert_allclose(got.beta, dense.beta[1:3], rtol=1e-9)
    np.testing.assert_allclose(got.cov, dense.cov[1:3, 1:3], rtol=1e-7)
    np.testing.assert_allclose([got.log_lik, got.r2, got.density], [dense.log_lik, dense.r2, dense.density], rtol=1e-9)
    for mine, theirs in zip(got.effects(), dense.effects(["a", "b"]), strict=True):
        assert mine[0] == theirs[0]
        np.testing.assert_allclose(mine[1:], theirs[1:], rtol=1e-6, atol=1e-9)


def test_a_hundred_thousand_levels(spark):
    """Two rows of different outcome a level: a logit with effects is then a logit of differences with twice the coefficient."""
    from pyspark.sql import functions as F

    levels = 100_000
    base = spark.range(levels).select(F.col("id").alias("sector"), F.randn(3).alias("u"), F.randn(4).alias("v"), F.rand(5).alias("w"))
    flip = (F.col("w") < 1 / (1 + F.exp(-0.8 * (F.col("u") - F.col("v"))))).cast("double")
    df = base.select("sector", F.inline(F.array(
        F.struct((F.col("sector") % 5000).alias("pid"), F.col("u").alias("a"), flip.alias("y")),
        F.struct((F.col("sector") % 5000).alias("pid"), F.col("v").alias("a"), (1 - flip).alias("y")))))
    fit = fit_absorbed(df, ModelSpec("", "L", "logit", "y", ("a",)))
    assert fit.levels == levels and fit.n == 2 * levels and fit.clusters == 5000
    z = np.array([(r.d, r.f) for r in base.select((F.col("u") - F.col("v")).alias("d"), flip.alias("f")).collect()])
    d, f, beta = z[:, 0], z[:, 1], 0.0
    for _ in range(30):
        mu = 1 / (1 + np.exp(-beta * d))
        beta += (d * (f - mu)).sum() / (d * d * mu * (1 - mu)).sum()
    assert fit.beta[0] == pytest.approx(2 * beta, rel=1e-8) and abs(beta - 0.8) < 0.05


def test_text_levels_and_one_level_with_half_of_the_rows(spark):
    pid, level, a, b, y = panel(1200, 6)
    level[::2] = 3
    df = frame(spark, pid, level, a, b, y)
    spec = ModelSpec("", "M", "logit", "y", ("a", "b"), sector=True)
    named = df.selectExpr("pid", "concat('level ', sector) AS sector", "a", "b", "y")
    np.testing.assert_allclose(fit_absorbed(named, spec).cov, fit_models(df, [spec])[0].cov[1:3, 1:3], rtol=1e-7)


def test_models_with_many_levels_are_absorbed(spark, monkeypatch):
    df = frame(spark, *panel(1200, 12))
    specs = [ModelSpec("(1)", "L", "logit", "y", ("a", "b")), ModelSpec("(2)", "L", "logit", "y", ("a",), sector=True),
             ModelSpec("(3)", "P", "probit", "y", ("a", "b"))]
    dense = fit_models(df, specs)
    monkeypatch.setattr("panelweave.estimation.fit.MOST_LEVELS", 11)
    got = fit_models(df, specs)
    assert [f.spec for f in got] == specs and got[1].terms == ["a"] and got[0].terms == dense[0].terms
    np.testing.assert_allclose(got[2].beta, dense[2].beta)
    np.testing.assert_allclose(got[1].effects()[0][1:], dense[1].effects(["a"])[0][1:], rtol=1e-6)


def test_samples_that_cannot_be_fitted(spark):
    pid, level, a, b, y = panel(400, 4)
    spec = ModelSpec("", "M", "logit", "y", ("a", "b"))
    with pytest.raises(EstimationError, match="1 of 4 levels of sector have only one value of y, such as 2"):
        fit_absorbed(frame(spark, pid, level, a, b, np.where(level == 2, 1.0, y)), spec)
    with pytest.raises(EstimationError, match="b is constant within the levels"):
        fit_absorbed(frame(spark, pid, level, a, level * 2.0, y), spec)
    with pytest.raises(EstimationError, match="empty"):
        fit_absorbed(frame(spark, pid, level, a, b, y).where("a > 1e9"), spec)
    # rows without a level are no part of the sample
    df = frame(spark, pid, level, a, b, y)
    more = df.unionByName(df.selectExpr("pid", "CAST(NULL AS DOUBLE) AS sector", "a", "b", "y"))
    np.testing.assert_allclose(fit_absorbed(more, spec).beta, fit_absorbed(df, spec).beta, rtol=1e-9)


def test_an_overshooting_step_is_halved(spark, monkeypatch):
    df = frame(spark, *panel(600, 5))
    spec = ModelSpec("", "M", "logit", "y", ("a", "b"))
    want, step, calls = fit_absorbed(df, spec), _Sums.step, []

    def far(self):
        calls.append(1)
        found, last = step(self)
        return (found * 30, False) if len(calls) == 1 else (found, last)

    monkeypatch.setattr(_Sums, "step", far)
    np.testing.assert_allclose(fit_absorbed(df, spec).cov, want.cov, rtol=1e-7)
    assert len(calls) > 4


def test_nothing_that_was_written_stays(spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    fit_absorbed(frame(spark, *panel(300, 3)), ModelSpec("", "M", "probit", "y", ("a",)))
    assert not {f for f in set(os.listdir(folder)) - before if f.startswith(("absorb", "levels"))}
