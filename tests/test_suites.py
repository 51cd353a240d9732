"""The published model suites on the derived panel, against numpy fits of the same rows taken from the SQL check."""

import math
import os

import numpy as np
import pytest

from panelweave.estimation import report
from panelweave.fixed_values import ACTUAL, CONTROLS, TIME_VARYING, WILLING
from panelweave.operators.sample import PREFERENCE, REALIZATION, REALIZATION_FULL
from panelweave.plans import suites
from tests.oracle import connect
from tests.test_estimation import clustered, likelihood, numeric_fit
from workload import inputs
from workload.frames import check_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def master(spark):
    return inputs.stored_master(spark, SF_DIR)


def sample_rows(name, outcome, regressors):
    """pid, outcome, regressors, person means, sector dummies as numpy arrays."""
    columns = ", ".join(["pid", outcome, "sector", *regressors])
    data = connect(SF_DIR).sql(check_sql(f"SELECT {columns} FROM {name}")).fetchnumpy()
    data = {k: np.asarray(v, dtype=float) for k, v in data.items()}
    pid = data["pid"]
    x = np.column_stack([np.ones(len(pid)), *[data[r] for r in regressors]])
    _, person = np.unique(pid, return_inverse=True)
    mean = lambda v: (np.bincount(person, v) / np.bincount(person))[person]
    means = np.column_stack([mean(data[v]) for v in TIME_VARYING])
    dummies = np.column_stack([data["sector"] == s for s in np.unique(data["sector"])[1:]]).astype(float)
    within = np.column_stack([data[v] - mean(data[v]) for v in TIME_VARYING])
    return pid, data[outcome], x, means, dummies, within, data[outcome] - mean(data[outcome])


def check_binary(fit, pid, y, x, regressors):
    link = fit.spec.link
    beta, s, w = numeric_fit(link, y, x)
    cov = clustered(x, s, (x * w[:, None]).T @ x, pid)
    np.testing.assert_allclose(fit.beta, beta, rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(np.diag(fit.cov), np.diag(cov), rtol=1e-6)
    np.testing.assert_allclose(fit.cov, fit.cov.T, rtol=1e-9, atol=1e-15)
    assert np.linalg.eigvalsh(fit.cov).min() > 0
    eta = x @ beta
    assert fit.log_lik == pytest.approx(likelihood(link, y, eta), rel=1e-10)
    if link == "logit":
        f = np.exp(-eta) / (1 + np.exp(-eta)) ** 2
        slope = f * (1 - 2 / (1 + np.exp(-eta)))
    else:
        f = np.exp(-eta ** 2 / 2) / math.sqrt(2 * math.pi)
        slope = -eta * f
    jacobian = f.mean() * np.eye(len(beta)) + np.outer(beta, (slope[:, None] * x).mean(0))
    errors = np.sqrt(np.diag(jacobian @ cov @ jacobian.T))
    effects = fit.effects(regressors)
    assert [r[0] for r in effects] == list(regressors)
    for i, (_, ame, se, _, _) in enumerate(effects, 1):
        assert ame == pytest.approx(f.mean() * beta[i], rel=1e-6, abs=1e-10)
        assert se == pytest.approx(errors[i], rel=1e-6)


@pytest.mark.parametrize("which", ["preference", "realization", "full"])
def test_suite(master, spark, which):
    rows, outcome, design, run = {
        "preference": ("s1", WILLING, PREFERENCE, suites.preference_models),
        "realization": ("s2", ACTUAL, REALIZATION, suites.realization_models),
        "full": ("s2full", ACTUAL, REALIZATION_FULL, suites.realization_full_models),
    }[which]
    regressors = design.regressors
    pid, y, x, means, dummies, within, y_within = sample_rows(rows, outcome, regressors)
    fits = run(master)
    assert [f.spec.number for f in fits] == [f"({i})" for i in range(1, 8 if which == "realization" else 7)]
    for fit in fits[:6]:
        blocks = [x]
        if "CRE" in fit.spec.label:
            blocks.append(means)
        if fit.spec.sector:
            blocks.append(dummies)
        assert (fit.n, fit.clusters) == (len(y), len(np.unique(pid)))
        check_binary(fit, pid, y, np.column_stack(blocks), regressors)
        wald = fit.wald_of_means()
        assert (wald is None) == ("CRE" not in fit.spec.label)
        if wald:
            at = slice(x.shape[1], x.shape[1] + len(TIME_VARYING))
            b = fit.beta[at]
            assert wald[:2] == (pytest.approx(b @ np.linalg.inv(fit.cov[at, at]) @ b, rel=1e-8), 9)
    if which == "realization":
        linear = fits[6]
        beta = np.linalg.lstsq(within, y_within, rcond=None)[0]
        residual = y_within - within @ beta
        assert linear.terms == list(TIME_VARYING)
        np.testing.assert_allclose(linear.beta, beta, rtol=1e-7, atol=1e-11)
        np.testing.assert_allclose(linear.cov, clustered(within, residual, within.T @ within, pid), rtol=1e-6, atol=1e-14)
        assert linear.r2 == pytest.approx(1 - residual @ residual / (y_within @ y_within), rel=1e-9)
        table = report.comparison_table(spark, fits).collect()
        by_label = {r.label: r for r in table if r.label}
        assert by_label["Female"]["(7)"] == "---" and by_label["Age"]["(7)"] != "---"
        assert by_label["Log-likelihood"]["(7)"] == "---" and by_label["Mundlak means (p)"]["(1)"] == "---"
        assert by_label["N"]["(1)"] == f"{len(y):,}"
        assert by_label["Age"]["(1)"].rstrip("*") == f"{fits[0].effects(['age'])[0][1]:.4f}"


def test_specifications(spark):
    specs = [*suites.binary_specs(REALIZATION), suites.within_spec(REALIZATION, "(7)")]
    got = [(r.model_no, r.model, r.sector_fe, r.person_means, r.regressors)
           for r in report.specifications(spark, "Realization", specs).collect()]
    k, m = len(CONTROLS), len(TIME_VARYING)
    assert got == [
        ("(1)", "Logit", "No", False, k), ("(2)", "Logit", "Yes", False, k),
        ("(3)", "Probit", "No", False, k), ("(4)", "Probit", "Yes", False, k),
        ("(5)", "CRE Probit", "No", True, k + m), ("(6)", "CRE Probit", "Yes", True, k + m),
        ("(7)", "FE LPM", "No", False, m),
    ]
    assert [s.number for s in suites.binary_specs(PREFERENCE, sector=False)] == ["(1)", "(3)", "(5)"]


def test_between_effects(spark, master):
    specs = [s for s in suites.binary_specs(PREFERENCE, False) if s.label == "CRE Probit"]
    fit = suites.fit_models(suites.estimation_table(master, PREFERENCE), specs)[0]
    got = {r.term: r for r in report.between_effects(report.coefficients(spark, "Preference", [fit])).collect()}
    assert set(got) == set(TIME_VARYING)
    beta = dict(zip(fit.terms, fit.beta))
    for term, row in got.items():
        assert row.between == pytest.approx(beta[term] + beta[f"{term}_mean"])
