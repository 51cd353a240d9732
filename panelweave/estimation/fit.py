"""Binary-choice and within estimators with cluster-robust inference.

All models of a suite are fitted together: one pass over the rows per Newton
step serves every model that has not converged, and one more pass adds up the
score vectors per person. Rows are written once, sorted by person over the whole
cluster, so that pass needs no shuffle of scores: a task sums up whole persons, and
only persons cut by the end of a file are put together afterwards. Only sums as
large as the coefficient vector squared reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from math import ceil, erfc, exp, lgamma, log, pi, sqrt

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.estimation import kernels
from panelweave.session import staged

# workers need not have the package installed
cloudpickle.register_pickle_by_value(kernels)

MAX_STEPS = 200
# steps after which separation is looked for; a fit without it takes about ten
MANY_STEPS = 15
# squared length of a Newton step in standard errors below which the step taken is the last
DECREMENT = 1e-12
MAX_CONDITION = 1e12
# levels that become columns of the design; effects of more are eliminated
MOST_LEVELS = 200
# rows that the driver adds up itself
MOST_ADDED = 16


class EstimationError(ValueError):
    """The model cannot be estimated on this sample."""


@dataclass(frozen=True)
class ModelSpec:
    """One column of a model table."""

    number: str
    label: str
    link: str  # logit, probit or linear
    outcome: str
    regressors: tuple[str, ...]
    sector: bool = False
    intercept: bool = True


@dataclass
class Fit:
    spec: ModelSpec
    terms: list[str]
    beta: np.ndarray
    cov: np.ndarray
    n: int
    clusters: int
    log_lik: float
    null_log_lik: float | None
    r2: float
    density: float
    slope: np.ndarray
    steps: int
    condition: float

    def coefficients(self) -> list[tuple]:
        """(term, estimate, standard error, z, p) of all coefficients."""
        return _inference(self.terms, self.beta, self.cov)

    def effects(self, terms: Iterable[str] | None = None) -> list[tuple]:
        """Average marginal effects over the sample with delta-method errors."""
        jacobian = self.density * np.eye(len(self.beta)) + np.outer(self.beta, self.slope)
        rows = _inference(self.terms, self.density * self.beta, jacobian @ self.cov @ jacobian.T)
        by_term = {row[0]: row for row in rows}
        wanted = [t for t in self.terms if t != "Intercept"] if terms is None else terms
        return [by_term[t] for t in wanted if t in by_term]

    def wald(self, terms: Iterable[str]) -> tuple[float, int, float] | None:
        """Joint test that the coefficients of ``terms`` are zero: χ², df, p."""
        wanted = set(terms)
        index = [i for i, t in enumerate(self.terms) if t in wanted]
        if not index:
            return None
        b = self.beta[index]
        chi2 = float(b @ np.linalg.solve(self.cov[np.ix_(index, index)], b))
        return chi2, len(index), chi2_tail(chi2, len(index))

    def wald_of_means(self) -> tuple[float, int, float] | None:
        return self.wald(t for t in self.terms if t.endswith("_mean"))


def normal_p(z: float) -> float:
    """Two-sided normal p-value."""
    return erfc(abs(z) / sqrt(2.0))


def chi2_tail(x: float, df: int) -> float:
    """P(χ² > x): finite sums for even and odd degrees of freedom."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    if df % 2 == 0:
        return sum(exp(-half + k * log(half) - lgamma(k + 1)) for k in range(df // 2))
    term, total = sqrt(2.0 * x / pi) * exp(-half), erfc(sqrt(half))
    for k in range(1, (df - 1) // 2 + 1):
        total += term
        term *= x / (2 * k + 1)
    return min(total, 1.0)


def _inference(terms, estimates, cov) -> list[tuple]:
    errors = np.sqrt(np.diag(cov))
    rows = []
    for term, b, se in zip(terms, estimates, errors):
        z = b / se
        rows.append((term, float(b), float(se), float(z), normal_p(z)))
    return rows


def _inverse(h: np.ndarray, what: str) -> tuple[np.ndarray, float]:
    """Inverse of a positive definite matrix, scaled to unit diagonal first, and its condition."""
    diagonal = np.diag(h)
    if not np.all(diagonal > 0):
        raise EstimationError(f"{what}: a regressor is constant zero")
    scale = 1.0 / np.sqrt(diagonal)
    unit = h * np.outer(scale, scale)
    condition = float(np.linalg.cond(unit))
    if not condition < MAX_CONDITION:
        raise EstimationError(f"{what}: regressors are collinear (condition {condition:.1e})")
    lower = np.linalg.inv(np.linalg.cholesky(unit))
    return (lower.T @ lower) * np.outer(scale, scale), condition


def _tasks(df: DataFrame) -> int | None:
    """Number of tasks of a plan that exchanges nothing, which is known before it runs; None for others."""
    execution = df._jdf.queryExecution()
    return None if "Exchange" in execution.executedPlan().toString() else execution.toRdd().getNumPartitions()


def tree_sum(partials: DataFrame) -> np.ndarray | None:
    """Sum of the arrays in ``sums`` (bytes of doubles, one row a task), None without rows.

    Tasks hand their row to a few tasks that add them up, those to at most MOST_ADDED, and the driver adds what is left; it
    adds the rows of that few tasks by itself. The order of adding is that of the tasks, so the same layout gives the same
    sum to the last bit.
    """
    tasks = _tasks(partials)
    adders = ceil(2 * sqrt(tasks or int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    levels = (adders, MOST_ADDED) if adders > MOST_ADDED else (adders,)
    for width in () if tasks is not None and tasks <= MOST_ADDED else levels:
        numbered = partials.select(F.spark_partition_id().alias("task"), "sums")
        partials = numbered.repartition(width, F.pmod("task", F.lit(width))).sortWithinPartitions("task").mapInArrow(
            kernels.add_sums, "sums binary")
    rows = [np.frombuffer(r.sums, dtype=np.float64) for r in partials.collect()]
    return sum(rows[1:], rows[0].copy()) if rows else None


def _add_up(partials: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """The summed arrays of all models, whose lengths are ``sizes``; empty without rows."""
    total = tree_sum(partials)
    return {} if total is None else dict(zip(sizes, np.split(total, np.cumsum(list(sizes.values()))[:-1]), strict=True))


def gram(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray]:
    """Number of rows and XᵀX of the columns."""
    packed = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    k = len(columns)
    sums = tree_sum(packed.mapInArrow(kernels.cross_products({0: k}), "sums binary"))
    if sums is None:
        return 0, np.zeros((k, k))
    scalars, _, square = kernels.unpack(sums, k, 1, 0)
    return int(scalars[0]), square


def _levels(table: DataFrame, category: str, outcomes: list[str]) -> list[float] | None:
    """Levels of the category in ascending order, each a coefficient; None if there are more than MOST_LEVELS.

    A level whose rows all have the same outcome has no finite coefficient.
    """
    ends = [f(o).alias(f"{f.__name__}_{o}") for o in outcomes for f in (F.min, F.max)]
    rows = table.groupBy(category).agg(*ends).limit(MOST_LEVELS + 1).collect()
    if len(rows) > MOST_LEVELS:
        return None
    for row in rows:
        for o in outcomes:
            if row[f"min_{o}"] == row[f"max_{o}"]:
                raise EstimationError(f"{category} {row[category]:g}: only one value of {o}")
    return sorted(row[category] for row in rows)


def _parts(name: str) -> tuple[str, ...]:
    """``<v>_within`` stands for v minus its group mean; the difference is taken where it is used."""
    base = name.removesuffix("_within")
    return (name,) if base == name else (base, f"{base}_mean")


def value_of(name: str) -> Column:
    """A regressor or outcome as a number, ``<v>_within`` as the difference."""
    first, *mean = _parts(name)
    value = F.col(first).cast("double")
    return value - F.col(mean[0]).cast("double") if mean else value


def fit_models(
    table: DataFrame, specs: list[ModelSpec], cluster: str = "pid", category: str = "sector", by_cluster: bool = False
) -> list[Fit]:
    """Fit all specs on the rows of ``table``, clustered by ``cluster``.

    ``table`` is read once or twice; the columns that the models need are written,
    sorted by cluster, and read once per Newton step. With ``by_cluster`` a cluster goes to one
    task as a whole, which moves no rows if they lie by cluster, as those of a person layout do. A regressor or outcome
    ``<v>_within`` needs the columns ``<v>`` and ``<v>_mean``. Models with sector effects of
    more than MOST_LEVELS levels have them eliminated (``absorb.fit_absorbed``) and report no dummies.
    """
    used = list(dict.fromkeys(c for s in specs for c in s.regressors))
    differences = {c: _parts(c) for c in used if len(_parts(c)) == 2}
    outcomes = [c for s in specs for c in _parts(s.outcome)]
    by_sector = [category] if any(s.sector for s in specs) else []
    needed = dict.fromkeys([c for u in used for c in _parts(u)] + outcomes + by_sector)
    narrow = table.select(cluster, *[F.col(c).cast("double").alias(c) for c in needed])
    # rows of one cluster lie next to each other; one with very many rows goes over several files
    order = [F.col(cluster), F.xxhash64(*needed)]
    if by_cluster:
        # a window asks for clusters as a whole, and sorted; Spark sees whether they lie so already
        counted = narrow.withColumn("_rows", F.count("*").over(Window.partitionBy(cluster)))
        placed = counted.where("_rows > 0").drop("_rows")
    else:
        placed = narrow.repartitionByRange(*order).sortWithinPartitions(cluster)
    with staged(placed, "design") as rows:
        return _fitted(rows, specs, cluster, category, used, differences, outcomes)


def _fitted(rows, specs, cluster, category, used, differences, outcomes) -> list[Fit]:
    levels: list[float] | None = []
    by_sector = [s for s in specs if s.sector]
    if by_sector:
        levels = _levels(rows, category, sorted({s.outcome for s in by_sector}))
    if levels is None:
        from panelweave.estimation.absorb import fit_absorbed

        others = iter(_fitted(rows, [s for s in specs if not s.sector], cluster, category, used, differences, outcomes)
                      if len(by_sector) < len(specs) else [])
        return [fit_absorbed(rows, s, cluster, category) if s.sector else next(others) for s in specs]
    columns = [c for c in used if c not in differences]
    design = kernels.Design(columns, differences, outcomes, category, levels[1:])
    place = {t: i for i, t in enumerate(design.terms)}
    dummies = design.terms[1 + len(used):]
    terms = [
        [*(["Intercept"] if s.intercept else []), *s.regressors, *(dummies if s.sector else ())] for s in specs
    ]
    equations = {
        m: kernels.Equation(s.link, _parts(s.outcome), [place[t] for t in terms[m]]) for m, s in enumerate(specs)
    }
    # written as plain columns, which compress; packed on the way to Python
    packed = rows.select(F.array(*design.packed).alias("x"))
    def not_separated(moving):
        """An error that names what separates the outcome of a model that does not converge."""
        from panelweave.estimation.separation import find_separation

        for m in moving:
            if specs[m].link != "linear" and (found := find_separation(rows, specs[m], category)) is not None:
                raise EstimationError(f"{specs[m].label}{specs[m].number}: the outcome is separated: {found}")

    betas, sums, steps, condition = _newton(packed, design, equations, [s.label + s.number for s in specs], not_separated)
    # rows that follow each other in a file, and only they, have numbers that do
    file = F.shiftleft(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 29)), 34)
    placed = rows.select(
        F.col(cluster).cast("long").alias("group"), (file + F.col("_metadata.row_index")).alias("row"),
        F.array(*design.packed).alias("x"))
    meat, clusters = _meat(placed, design, equations, betas)

    fits = []
    for m, spec in enumerate(specs):
        k = len(terms[m])
        (n, ll, y, y2, density), (_, slope), h = kernels.unpack(sums[m], k)
        bread, _ = _inverse(h, spec.label)
        correction = clusters / (clusters - 1.0) * (n - 1.0) / (n - k)
        if spec.link == "linear":
            null, r2 = None, 1.0 + 2.0 * ll / (y2 if not spec.intercept else y2 - y * y / n)
        else:
            null = null_log_lik(n, y)
            r2 = 1.0 - ll / null
        cov = correction * bread @ meat[m] @ bread
        fits.append(Fit(
            spec, terms[m], betas[m], (cov + cov.T) / 2.0, int(n), clusters, float(ll), null,
            float(r2), float(density / n), slope / n, steps[m], condition[m],
        ))
    return fits


def null_log_lik(n: float, ones: float) -> float:
    """Log-likelihood of the constant-only binary model."""
    return float(sum(part * log(part / n) for part in (ones, n - ones) if part > 0))


def _newton(rows, design, equations, names, not_separated):
    """Maximise every likelihood; models that have converged drop out of later passes.

    ``not_separated`` is asked about models that take many steps or whose Hessian becomes singular on the way.
    """
    betas = {m: np.zeros(e.size) for m, e in equations.items()}
    sums, steps, condition = {}, dict.fromkeys(equations, 0), {}
    best: dict[int, tuple] = {}
    moving, last = dict(equations), set()
    for taken in range(MAX_STEPS):
        if taken == MANY_STEPS:
            not_separated(moving)
        at = {m: betas[m] for m in moving}
        sizes = {m: kernels.packed_size(e.size) for m, e in moving.items()}
        found = _add_up(rows.mapInArrow(kernels.likelihood_sums(design, moving, at), "sums binary"), sizes)
        if not found:
            raise EstimationError("the sample is empty")
        for m in list(moving):
            (n, ll, *_), (gradient, _), h = kernels.unpack(found[m], len(betas[m]))
            if m in last:
                sums[m] = found[m]
                del moving[m]
                continue
            if m in best and not ll >= best[m][0] - 1e-9 * abs(best[m][0]):
                betas[m] = 0.5 * (betas[m] + best[m][1])  # overshot: halve the step
                continue
            best[m] = (ll, betas[m])
            try:
                inverse, condition[m] = _inverse(h, names[m])
            except EstimationError:
                if taken:
                    not_separated([m])
                raise
            step = inverse @ gradient
            betas[m] = betas[m] + step
            steps[m] += 1
            if float(gradient @ step) < DECREMENT:
                last.add(m)
        if not moving:
            return betas, sums, steps, condition
    raise EstimationError(f"no convergence: {', '.join(names[m] for m in moving)}")


def _meat(rows, design, equations, betas):
    """Σ u uᵀ over clusters, u the summed score vector of a cluster, for all models at once.

    Tasks return the sum over the clusters they hold whole and the vectors of those
    that may go on in another file: two a file at most, whatever the number of rows.
    """
    widths = {m: e.size for m, e in equations.items()}
    sizes = {m: kernels.packed_size(k, 1, 0) for m, k in widths.items()}
    found = rows.mapInArrow(
        kernels.group_scores(design, equations, betas), "group long, vector array<double>, sums binary")
    with staged(found, "scores") as found:
        cut = found.filter("sums IS NULL").groupBy("group").agg(
            *[F.expr(f"sum(vector[{i}]) AS u{i}") for i in range(sum(widths.values()))])
        put_together = cut.select(F.array(*cut.columns[1:]).alias("x")).mapInArrow(kernels.cross_products(widths), "sums binary")
        total = _add_up(found.filter("sums IS NOT NULL").select("sums").unionByName(put_together), sizes)
    meat = {}
    for m, k in widths.items():
        (clusters,), _, meat[m] = kernels.unpack(total[m], k, 1, 0)
    return meat, int(clusters)
