"""Estimators against independent numpy fits and closed forms."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.estimation import kernels, report
from panelweave.estimation.fit import (
    EstimationError, ModelSpec, chi2_tail, fit_models, gram, normal_p, null_log_lik, tree_sum,
)

CDF = np.vectorize(lambda x: 0.5 * math.erfc(-x / math.sqrt(2)))


def data(n=600, persons=200, seed=3):
    rng = np.random.default_rng(seed)
    pid = rng.integers(0, persons, n)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n).astype(float)])
    sector = rng.integers(1, 4, n).astype(float)
    effect = rng.normal(size=persons)[pid]
    y = (0.3 + 0.8 * x[:, 0] - 0.5 * x[:, 1] + 0.2 * sector + effect + rng.normal(size=n) > 0.5).astype(float)
    return pid, x, sector, y


def table(spark, pid, x, sector, y):
    rows = [(int(p), float(a), float(b), float(s), float(v)) for p, (a, b), s, v in zip(pid, x, sector, y)]
    return spark.createDataFrame(rows, "pid long, a double, b double, sector double, y double").repartition(5)


def likelihood(link, y, eta):
    mu = 1 / (1 + np.exp(-eta)) if link == "logit" else CDF(eta)
    return float(np.sum(np.log(np.where(y == 1, mu, 1 - mu))))


def numeric_fit(link, y, x):
    """Newton with the plain textbook formulas."""
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        eta = x @ beta
        if link == "logit":
            mu = 1 / (1 + np.exp(-eta))
            s, w = y - mu, mu * (1 - mu)
        else:
            phi, mu = np.exp(-eta ** 2 / 2) / math.sqrt(2 * math.pi), CDF(eta)
            s = y * phi / mu - (1 - y) * phi / (1 - mu)
            w = s * (s + eta)
        beta = beta + np.linalg.solve((x * w[:, None]).T @ x, x.T @ s)
    return beta, s, w


def clustered(x, s, h, pid):
    bread = np.linalg.inv(h)
    u = np.array([(x[pid == g] * s[pid == g][:, None]).sum(0) for g in np.unique(pid)])
    g, (n, k) = len(u), x.shape
    return g / (g - 1) * (n - 1) / (n - k) * bread @ (u.T @ u) @ bread


@pytest.fixture(scope="module")
def fitted(spark):
    pid, x, sector, y = data()
    specs = [
        ModelSpec("(1)", "Logit", "logit", "y", ("a", "b")),
        ModelSpec("(2)", "Probit", "probit", "y", ("a", "b"), sector=True),
    ]
    return (pid, x, sector, y), fit_models(table(spark, pid, x, sector, y), specs)


def design(x, sector, dummies):
    columns = [np.ones(len(x)), x[:, 0], x[:, 1]]
    return np.column_stack(columns + ([sector == 2.0, sector == 3.0] if dummies else []))


@pytest.mark.parametrize("which, link", [(0, "logit"), (1, "probit")])
def test_against_numpy(fitted, which, link):
    (pid, x, sector, y), fits = fitted
    fit, xm = fits[which], design(x, sector, which == 1)
    beta, s, w = numeric_fit(link, y, xm)
    cov = clustered(xm, s, (xm * w[:, None]).T @ xm, pid)
    assert fit.terms == ["Intercept", "a", "b"] + (["sector_2", "sector_3"] if which else [])
    np.testing.assert_allclose(fit.beta, beta, rtol=1e-9, atol=1e-11)
    np.testing.assert_allclose(fit.cov, cov, rtol=1e-8, atol=1e-13)
    assert fit.log_lik == pytest.approx(likelihood(link, y, xm @ beta), rel=1e-11)
    assert fit.r2 == pytest.approx(1 - fit.log_lik / likelihood("logit", y, np.full(len(y), math.log(y.mean() / (1 - y.mean())))))
    assert (fit.n, fit.clusters) == (len(y), len(np.unique(pid)))
    np.testing.assert_allclose(xm.T @ s, 0, atol=1e-8)


@pytest.mark.parametrize("which, link", [(0, "logit"), (1, "probit")])
def test_effects(fitted, which, link):
    (pid, x, sector, y), fits = fitted
    fit, xm = fits[which], design(x, sector, which == 1)

    def effects(beta):
        eta = xm @ beta
        f = np.exp(-eta) / (1 + np.exp(-eta)) ** 2 if link == "logit" else np.exp(-eta ** 2 / 2) / math.sqrt(2 * math.pi)
        return f.mean() * beta

    step = 1e-6
    jacobian = np.column_stack([
        (effects(fit.beta + step * e) - effects(fit.beta - step * e)) / (2 * step) for e in np.eye(len(fit.beta))
    ])
    errors = np.sqrt(np.diag(jacobian @ fit.cov @ jacobian.T))
    for i, (term, ame, se, z, p) in enumerate(fit.effects(), 1):
        assert term == fit.terms[i]
        assert ame == pytest.approx(effects(fit.beta)[i], rel=1e-10)
        assert se == pytest.approx(errors[i], rel=1e-6)
        assert z == pytest.approx(ame / se) and p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    assert [row[0] for row in fit.effects(["b", "a", "zzz"])] == ["b", "a"]


def test_result_does_not_depend_on_partitions(spark, fitted):
    (pid, x, sector, y), fits = fitted
    again = fit_models(table(spark, pid, x, sector, y).coalesce(1), [fits[0].spec])[0]
    np.testing.assert_allclose(again.beta, fits[0].beta, rtol=1e-10)
    np.testing.assert_allclose(again.cov, fits[0].cov, rtol=1e-9)


def test_one_row_clusters_give_the_rowwise_sandwich(spark):
    _, x, sector, y = data(300)
    pid = np.arange(300)
    fit = fit_models(table(spark, pid, x, sector, y), [ModelSpec("", "L", "logit", "y", ("a",))])[0]
    xm = np.column_stack([np.ones(300), x[:, 0]])
    _, s, w = numeric_fit("logit", y, xm)
    np.testing.assert_allclose(fit.cov, clustered(xm, s, (xm * w[:, None]).T @ xm, pid), rtol=1e-8)


@pytest.mark.parametrize("cuts", [(), (1,), (3, 7, 8), (2, 4, 6, 10, 11), tuple(range(1, 12))])
@pytest.mark.parametrize("files", [(12,), (5, 12), (1, 4, 7, 12)])
def test_groups_cut_by_files_and_batches(cuts, files):
    """However rows come in batches and files, whole groups and pieces add up to the groups."""
    import pyarrow as pa

    group = np.array([1, 1, 1, 2, 3, 3, 3, 3, 3, 4, 4, 5])
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=12), rng.normal(size=12)
    row = np.concatenate([np.arange(b - a) for a, b in zip((0, *files), files)])
    plan = kernels.Design(["x"], others=["y"])
    equations = {0: kernels.Equation("linear", ("y",), [0, 1])}
    bounds = [0, *cuts, 12]
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(group[a:b]), pa.array(row[a:b]), pa.array([[p, q] for p, q in zip(x[a:b], y[a:b])], pa.list_(pa.float64()))],
        ["group", "row", "x"]) for a, b in zip(bounds, bounds[1:])]
    square, count, pieces = np.zeros((2, 2)), 0, {}
    for out in kernels.group_scores(plan, equations, {0: np.zeros(2)})(iter(batches)):
        for key, vector, sums in zip(*(out.column(i).to_pylist() for i in range(3))):
            if sums is None:
                pieces[key] = pieces.get(key, 0) + np.array(vector)
            else:
                (n,), _, part = kernels.unpack(np.frombuffer(sums), 2, 1, 0)
                square, count = square + part, count + n
    square = square + sum((np.outer(u, u) for u in pieces.values()), np.zeros((2, 2)))
    u = np.array([[y[group == g].sum(), (x * y)[group == g].sum()] for g in range(1, 6)])
    np.testing.assert_allclose(square, u.T @ u, rtol=1e-12)
    assert count + len(pieces) == 5
    assert len(files) > 1 or set(pieces) == {1, 5}


def test_one_person_with_a_third_of_all_rows(spark):
    pid, x, sector, y = data(900)
    pid[::3] = 5
    fit = fit_models(table(spark, pid, x, sector, y), [ModelSpec("", "P", "probit", "y", ("a", "b"))])[0]
    xm = design(x, sector, False)
    _, s, w = numeric_fit("probit", y, xm)
    np.testing.assert_allclose(fit.cov, clustered(xm, s, (xm * w[:, None]).T @ xm, pid), rtol=1e-8)


def test_linear(spark):
    pid, x, sector, y = data()
    fit = fit_models(table(spark, pid, x, sector, y), [ModelSpec("", "OLS", "linear", "a", ("b", "y"))])[0]
    xm = np.column_stack([np.ones(len(y)), x[:, 1], y])
    beta = np.linalg.lstsq(xm, x[:, 0], rcond=None)[0]
    residual = x[:, 0] - xm @ beta
    np.testing.assert_allclose(fit.beta, beta, rtol=1e-10)
    np.testing.assert_allclose(fit.cov, clustered(xm, residual, xm.T @ xm, pid), rtol=1e-9)
    assert fit.r2 == pytest.approx(1 - residual @ residual / ((x[:, 0] - x[:, 0].mean()) ** 2).sum())
    assert [r[1] for r in fit.effects()] == pytest.approx(list(fit.beta[1:]))


def test_within_deviations_are_differences_of_columns(spark):
    pid, x, sector, y = data()
    rows = table(spark, pid, x, sector, y)
    means = rows.groupBy("pid").agg(*[F.avg(c).alias(f"{c}_mean") for c in ("a", "b", "y")])
    spec = ModelSpec("", "FE", "linear", "y_within", ("a_within", "b_within"), intercept=False)
    fit = fit_models(rows.join(means, "pid"), [spec])[0]
    demean = lambda v: v - np.array([v[pid == g].mean(axis=0) for g in pid])
    xm, ym = demean(x), demean(y)
    beta = np.linalg.lstsq(xm, ym, rcond=None)[0]
    np.testing.assert_allclose(fit.beta, beta, rtol=1e-9)
    np.testing.assert_allclose(fit.cov, clustered(xm, ym - xm @ beta, xm.T @ xm, pid), rtol=1e-8)
    assert fit.r2 == pytest.approx(1 - ((ym - xm @ beta) ** 2).sum() / (ym ** 2).sum())


def test_wald(fitted):
    fit = fitted[1][1]
    chi2, df, p = fit.wald(["sector_2", "sector_3"])
    b, v = fit.beta[3:], fit.cov[3:, 3:]
    assert chi2 == pytest.approx(b @ np.linalg.inv(v) @ b) and df == 2 and p == pytest.approx(math.exp(-chi2 / 2))
    assert fit.wald_of_means() is None


def test_refusals(spark):
    pid, x, sector, y = data(200)
    separated = table(spark, pid, x, sector, np.where(sector == 3, 1.0, y))
    with pytest.raises(EstimationError, match="only one value"):
        fit_models(separated, [ModelSpec("", "L", "logit", "y", ("a",), sector=True)])
    twice = table(spark, pid, x, sector, y).withColumn("a2", F.col("a") * 2)
    with pytest.raises(EstimationError, match="collinear"):
        fit_models(twice, [ModelSpec("", "L", "logit", "y", ("a", "a2"))])
    with pytest.raises(EstimationError, match="constant zero"):
        fit_models(twice.withColumn("o", F.lit(0.0)), [ModelSpec("", "L", "logit", "y", ("o",))])
    with pytest.raises(EstimationError, match="empty"):
        fit_models(twice.filter("false"), [ModelSpec("", "L", "logit", "y", ("a",))])


@pytest.mark.parametrize("tasks", [1, 7, 300])
def test_tree_sum_adds_one_row_of_each_task(spark, tasks, monkeypatch):
    monkeypatch.setattr("panelweave.estimation.fit.MOST_ADDED", 2)
    rng = np.random.default_rng(tasks)
    parts = rng.normal(size=(tasks, 5))
    rows = spark.createDataFrame([(p.tobytes(),) for p in parts], "sums binary").repartition(tasks)
    first = tree_sum(rows)
    np.testing.assert_allclose(first, parts.sum(0), rtol=1e-9, atol=1e-12)
    assert (tree_sum(rows) == first).all()
    assert tree_sum(rows.where("sums IS NULL")) is None


def test_sums_travel_as_one_row_a_task(spark, capsys):
    """No cell of a matrix is a row: a step's plan has exchanges of numbered byte rows only, and no Generate."""
    pid, x, sector, y = data()
    df = table(spark, pid, x, sector, y)
    packed = df.select(F.array("a", "b").alias("x")).mapInArrow(kernels.cross_products({0: 2}), "sums binary")
    assert packed.count() == df.rdd.getNumPartitions()
    gram(df, ["a", "b"])
    numbered = packed.select(F.spark_partition_id().alias("task"), "sums").repartition(4, F.pmod("task", F.lit(4)))
    numbered.mapInArrow(kernels.add_sums, "sums binary").explain("formatted")
    plan = capsys.readouterr().out
    assert "Generate" not in plan and "Aggregate" not in plan and "[task#" in plan


def test_gram(spark):
    pid, x, sector, y = data(100)
    n, square = gram(table(spark, pid, x, sector, y), ["a", "b", "sector"])
    xm = np.column_stack([x, sector])
    assert n == 100
    np.testing.assert_allclose(square, xm.T @ xm, rtol=1e-12)


def test_normal_functions():
    x = np.concatenate([np.linspace(-37, 9, 4001), [-1.4142135, -1.4142136, 0.0, 1.4142135, 1.4142136]])
    log_cdf, hazard = kernels.log_normal_cdf(x)
    half = [0.5 * math.erfc(abs(v) / math.sqrt(2)) for v in x]
    want = np.array([math.log(h) if v < 0 else math.log1p(-h) for v, h in zip(x, half)])
    np.testing.assert_allclose(log_cdf, want, rtol=2e-13, atol=1e-18)
    density = np.exp(-x ** 2 / 2) / math.sqrt(2 * math.pi)
    np.testing.assert_allclose(hazard, density / np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x]), rtol=1e-12)
    far, far_hazard = kernels.log_normal_cdf(np.array([-60.0]))
    assert far[0] == pytest.approx(-0.5 * 3600 - math.log(60 * math.sqrt(2 * math.pi)), rel=1e-5)
    assert far_hazard[0] == pytest.approx(60, rel=1e-3)


@pytest.mark.parametrize("df", range(1, 13))
def test_chi2_tail(df):
    for x in (0.3, 2.0, 9.0, 30.0):
        grid = np.linspace(0, math.sqrt(x), 200001)  # substitute t = u² to tame df = 1
        density = 2 * grid ** (df - 1) * np.exp(-grid ** 2 / 2) / (2 ** (df / 2) * math.gamma(df / 2))
        assert chi2_tail(x, df) == pytest.approx(1 - np.trapezoid(density, grid), abs=1e-8)
    assert chi2_tail(0, df) == 1.0


def test_small_functions():
    assert normal_p(1.959963984540054) == pytest.approx(0.05)
    assert null_log_lik(10, 4) == pytest.approx(4 * math.log(0.4) + 6 * math.log(0.6))
    assert null_log_lik(10, 10) == 0


def test_reports(spark, fitted):
    fits = fitted[1]
    effects = report.effects(spark, "Preference", fits, ("b", "a", "c"))
    assert [(r.model_no, r.term_no, r.term) for r in effects.collect()] == [
        ("(1)", 0, "b"), ("(1)", 1, "a"), ("(2)", 0, "b"), ("(2)", 1, "a")]
    stats = report.model_stats(spark, "Preference", fits)
    assert [r.sector_fe for r in stats.collect()] == ["No", "Yes"]
    matrix = report.effect_matrix(spark, {"Preference": fits}, ("b", "a", "c")).collect()
    assert len(matrix) == 2 and matrix[0].scale_max >= abs(fits[0].effects(["a"])[0][1])
