"""Binary-choice and linear models with one effect for each level of a category, however many levels.

The effects make the Hessian an arrow: a small block of regressors, a diagonal of levels
and a border between them. The levels are eliminated one by one: their sums (weight, score,
border) are rows of a table spread over the cluster, and what reaches the driver are the
regressors' Schur complement and right-hand side, K x K numbers. Its step goes back to the table,
where every level solves for its own effect.

Rows are written sorted by category, so a task's rows are few levels and its sums few rows.
Rows meet the effects of their levels by a join that Spark plans by the size of the table of
levels: sent to the tasks while small, sorted and merged beyond that.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.estimation import absorb_kernels, kernels
from panelweave.estimation.fit import (
    DECREMENT,
    MAX_STEPS,
    EstimationError,
    Fit,
    ModelSpec,
    _inference,
    _inverse,
    null_log_lik,
    tree_sum,
    value_of,
)
from panelweave.session import staged

cloudpickle.register_pickle_by_value(absorb_kernels)

# least share of a regressor's curvature that the effects must leave
LEAST_LEFT = 1e-10


@dataclass
class AbsorbedFit(Fit):
    """Coefficients of the regressors; the effects are eliminated.

    ``cov`` belongs to the regressors. ``joint`` has one more row for the sum of all effects, each times the slope of the
    density over its level, which marginal effects depend on.
    """

    levels: int = 0
    joint: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def effects(self, terms=None):
        k = len(self.beta)
        jacobian = np.hstack([self.density * np.eye(k), (self.beta / self.n)[:, None]])
        rows = _inference(self.terms, self.density * self.beta, jacobian @ self.joint @ jacobian.T)
        by_term = {row[0]: row for row in rows}
        return [by_term[t] for t in (self.terms if terms is None else terms) if t in by_term]


def fit_absorbed(table: DataFrame, spec: ModelSpec, cluster: str = "pid", category: str = "sector") -> AbsorbedFit:
    """Fit one model with an effect for each level of ``category``, clustered by ``cluster``.

    Estimates, errors and marginal effects of the regressors are those of the model with a constant and a dummy for every level but
    one. Rows without a level are not in the sample. A level whose rows all have one outcome raises an error unless the model is
    linear, as does a regressor that the levels determine.
    """
    columns = [spec.outcome, *spec.regressors]
    narrow = table.where(F.col(category).isNotNull()).select(
        F.col(cluster).alias("cluster"), F.col(category).alias("level"), F.array(*map(value_of, columns)).alias("x"))
    order = [F.col("level"), F.xxhash64("cluster", "x")]  # a level with very many rows goes over several files
    with staged(narrow.repartitionByRange(*order).sortWithinPartitions("level"), "absorb") as rows:
        y = F.col("x")[0]
        start = rows.groupBy("level").agg(F.min(y).alias("low"), F.max(y).alias("high"))
        with staged(start, "levels") as start:
            levels, flat, example = start.agg(
                F.count("*"), F.count_if(F.col("low") == F.col("high")), F.min(F.when(F.col("low") == F.col("high"), F.col("level")))).first()
            if not levels:
                raise EstimationError("the sample is empty")
            if flat and spec.link != "linear":
                raise EstimationError(f"{flat} of {levels} levels of {category} have only one value of {spec.outcome}, such as {example}")
            return _Absorbed(rows, spec, levels).fit(start.select("level", F.lit(0.0).alias("effect")))


class _Absorbed:
    def __init__(self, rows: DataFrame, spec: ModelSpec, levels: int):
        self.rows, self.spec, self.levels, self.k = rows, spec, levels, len(spec.regressors)
        self.done: list[_Sums] = []

    def fit(self, effects: DataFrame) -> AbsorbedFit:
        beta, best, last = np.zeros(self.k), None, False
        try:
            for steps in range(MAX_STEPS):
                with _Sums(self, beta, effects) as now:
                    if last:
                        return self._result(now, steps)
                    if best is not None and not now.log_lik >= best.log_lik - 1e-9 * abs(best.log_lik):
                        # overshot: half way back, regressors and effects alike; written before the point is left
                        beta, effects, before = 0.5 * (beta + best.beta), now.halfway(best), now.keep()
                    else:
                        step, last = now.step()
                        beta, effects, before, best = beta + step, now.moved(step), best, now.keep()
                # the next point is worked out from the tables of this one and of the best one
                if before is not None and before is not best:
                    self.done.append(before)
            raise EstimationError(f"no convergence: {self.spec.label}")
        finally:
            for point in [*self.done, *([best] if best is not None else [])]:
                point.drop()

    def _result(self, now: _Sums, steps: int) -> AbsorbedFit:
        spec, k = self.spec, self.k
        bread, condition = now.inverse, now.condition
        meat, clusters = self._meat(now)
        # one influence a cluster: of the regressors by the Schur complement, of the weighted sum of effects besides
        turn = np.zeros((k + 1, k + 1))
        turn[:k, :k], turn[k, :k], turn[k, k] = bread, now.pull @ bread, 1.0
        n, size = now.n, k + self.levels
        joint = clusters / (clusters - 1.0) * (n - 1.0) / (n - size) * turn @ meat @ turn.T
        joint = (joint + joint.T) / 2.0
        if spec.link == "linear":
            null, r2 = None, 1.0 + 2.0 * now.log_lik / (now.yy - now.y * now.y / n)
        else:
            null = null_log_lik(n, now.y)
            r2 = 1.0 - now.log_lik / null
        return AbsorbedFit(
            spec, list(spec.regressors), now.beta, joint[:k, :k], int(n), clusters, now.log_lik, null, float(r2), float(now.density / n),
            np.zeros(k), steps, condition, self.levels, joint)

    def _meat(self, now: _Sums):
        k = self.k
        centred = now.table.select("level", "effect", F.transform("border", lambda b: b / F.col("weight")).alias("centre"),
                                   (F.col("slope") / F.col("weight")).alias("pull"))
        scored = self.rows.join(centred, "level").select("cluster", "x", "effect", "centre", "pull").mapInArrow(
            absorb_kernels.influences(self.spec.link, now.beta), f"cluster {self.rows.schema['cluster'].dataType.simpleString()}, z array<double>")
        by_cluster = scored.groupBy("cluster").agg(*[F.sum(F.col("z")[i]).alias(f"z{i}") for i in range(k + 1)])
        total = tree_sum(by_cluster.select(F.array(*by_cluster.columns[1:]).alias("x")).mapInArrow(
            kernels.cross_products({0: k + 1}), "sums binary"))
        (clusters,), _, meat = kernels.unpack(total, k + 1, 1, 0)
        return meat, int(clusters)


class _Sums:
    """The sums at one point: those of levels as a written table, those of regressors on the driver."""

    def __init__(self, model: _Absorbed, beta: np.ndarray, effects: DataFrame):
        self.model, self.beta, self.kept, k = model, beta, False, model.k
        parts = model.rows.select("level", "x").join(effects, "level").mapInArrow(
            absorb_kernels.level_sums(model.spec.link, beta),
            f"level {model.rows.schema['level'].dataType.simpleString()}, v array<double>, sums binary")
        with staged(parts, "absorb-parts") as parts:
            total = tree_sum(parts.where("sums IS NOT NULL").select("sums"))
            (self.n, self.log_lik, self.y, self.yy, self.density), (self.gradient, slope), hessian = kernels.unpack(total, k)
            by_level = parts.where("sums IS NULL").groupBy("level").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(k + 3)])
            table = by_level.join(effects, "level").select(
                "level", "effect", F.col("v0").alias("weight"), F.col("v1").alias("score"), F.col("v2").alias("slope"),
                F.array(*(F.col(f"v{i + 3}") for i in range(k))).cast("array<double>").alias("border"))
            self.stage = staged(table, "absorb-levels")
            self.table = self.stage.__enter__()
        try:
            total = tree_sum(self.table.mapInArrow(absorb_kernels.eliminated(k), "sums binary"))
            (self.own,), (border, pull), square = kernels.unpack(total, k, 1)
            self.rest = self.gradient - border
            self.pull = slope - pull
            schur = hessian - square
            left = np.diag(schur) / np.where(np.diag(hessian) > 0, np.diag(hessian), 1.0)
            if (left < LEAST_LEFT).any():
                raise EstimationError(f"{model.spec.label}: {model.spec.regressors[int(left.argmin())]} is constant within the levels")
            self.inverse, self.condition = _inverse(schur, model.spec.label) if k else (np.zeros((0, 0)), 1.0)
        except BaseException:
            self.drop()
            raise

    def __enter__(self) -> _Sums:
        return self

    def __exit__(self, *_) -> None:
        if not self.kept:
            self.drop()

    def keep(self) -> _Sums:
        self.kept = True
        return self

    def drop(self) -> None:
        self.stage.__exit__(None, None, None)

    def step(self) -> tuple[np.ndarray, bool]:
        """The regressors' Newton step, and whether it is the last: its squared length in standard errors, effects included."""
        step = self.inverse @ self.rest
        return step, float(self.rest @ step) + self.own < DECREMENT

    def moved(self, step: np.ndarray) -> DataFrame:
        """Every level's effect after the step: what is left of its score over its weight."""
        along = sum((F.col("border")[i] * float(b) for i, b in enumerate(step)), F.lit(0.0))
        return self.table.select("level", (F.col("effect") + (F.col("score") - along) / F.col("weight")).alias("effect"))

    def halfway(self, other: _Sums) -> DataFrame:
        back = other.table.select("level", F.col("effect").alias("before"))
        return self.table.select("level", "effect").join(back, "level").select(
            "level", (0.5 * (F.col("effect") + F.col("before"))).alias("effect"))
