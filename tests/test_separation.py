"""Separating combinations: planted ones are named, and overlap is recognised."""

import numpy as np
import pytest

from panelweave.estimation.fit import EstimationError, ModelSpec, fit_models
from panelweave.estimation.separation import find_separation

SPEC = ModelSpec("(1)", "Logit", "logit", "y", ("a", "b", "c"))


def frame(spark, y, a, b, c, sector=None):
    n = len(y)
    sector = np.ones(n) if sector is None else sector
    rows = [(int(i % 50), *map(float, r)) for i, r in enumerate(zip(y, a, b, c, sector, strict=True))]
    return spark.createDataFrame(rows, "pid long, y double, a double, b double, c double, sector double").repartition(4)


def draws(n=800, seed=3):
    rng = np.random.default_rng(seed)
    return rng, rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)


def test_complete_separation_by_a_combination(spark):
    """No single regressor separates; a - 2 b does."""
    _, a, b, c = draws()
    y = a - 2 * b > 0
    gap = np.where(y, 0.2, -0.2)
    found = find_separation(frame(spark, y, a + gap, b, c), SPEC)
    assert found.complete and found.n == 800
    assert found.weights["b"] == -1 and found.weights["a"] == pytest.approx(0.5, abs=0.1)
    assert abs(found.weights.get("c", 0)) < 0.1


def test_quasi_separation_names_only_what_decides(spark):
    """Where c is not 0 its sign is the outcome; elsewhere a and b overlap."""
    rng, a, b, _ = draws()
    y = rng.random(800) < 0.5
    c = np.where(rng.random(800) < 0.1, np.where(y, 1.0, -2.0), 0.0)
    found = find_separation(frame(spark, y, a, b, c), SPEC)
    assert found.weights == {"c": 1.0} and found.rows == int((c != 0).sum()) and not found.complete
    assert str(found) == f"1 c decides {found.rows} of 800 rows"


def test_a_dummy_with_one_outcome_and_one_of_a_sector(spark):
    rng, a, b, _ = draws()
    y = rng.random(800) < 0.5
    rare = ((rng.random(800) < 0.05) & y).astype(float)
    found = find_separation(frame(spark, y, a, b, rare), SPEC)
    assert found.weights == {"c": 1.0} and found.rows == rare.sum()
    sector = np.where(rare, 3.0, rng.integers(1, 3, 800))
    found = find_separation(frame(spark, y, a, b, rng.normal(size=800), sector), ModelSpec("", "P", "probit", "y", ("a", "b"), sector=True))
    assert found.weights == {"sector_3": 1.0}


@pytest.mark.parametrize("strength", [0.0, 1.0, 4.0])
def test_overlap(spark, strength):
    rng, a, b, c = draws()
    y = strength * (a + b) + rng.logistic(size=800) > 0
    assert find_separation(frame(spark, y, a, b, c), SPEC) is None


def test_one_row_out_of_order_is_overlap(spark):
    _, a, b, c = draws()
    y = a > 0
    a = a + np.where(y, 0.3, -0.3)
    assert find_separation(frame(spark, y, a, b, c), SPEC).complete
    y[np.argmax(a)] = False
    y[np.argmin(a)] = True
    assert find_separation(frame(spark, y, a, b, c), SPEC) is None


def test_collinear_and_constant_regressors_do_no_harm(spark):
    rng, a, _, _ = draws()
    y = a + rng.logistic(size=800) > 0
    assert find_separation(frame(spark, y, a, 2 * a, np.zeros(800)), SPEC) is None
    found = find_separation(frame(spark, a > 0, a, 2 * a, np.zeros(800)), SPEC)
    assert found.rows >= 795 and found.weights["b"] > 0 and abs(found.weights["Intercept"]) < 0.1


@pytest.mark.parametrize("link", ["logit", "probit"])
def test_fits_name_what_separates(spark, link):
    rng, a, b, _ = draws()
    y = a + rng.logistic(size=800) > 0
    c = np.where((rng.random(800) < 0.1) & y, 1.0, 0.0)
    df = frame(spark, y, a, b, c)
    with pytest.raises(EstimationError, match=r"M\(7\): the outcome is separated: 1 c decides \d+ of 800 rows"):
        fit_models(df, [ModelSpec("(6)", "M", link, "y", ("a", "b")), ModelSpec("(7)", "M", link, "y", ("a", "b", "c"))])
    with pytest.raises(EstimationError, match="empty"):
        find_separation(df.where("a > 99"), SPEC)
