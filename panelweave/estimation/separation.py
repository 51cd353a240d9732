"""Separated outcomes: combinations of regressors that tell some outcomes for sure.

A binary model has no finite estimate if some combination z of its regressors is never negative where the
outcome is 1, never positive where it is 0, and not zero everywhere. With rows turned round where the outcome is 0, z is
a vector of the regressors' space without a negative entry. The iterative rectifier looks for one: it begins with
all ones, fits the regressors to it, sets what is negative to zero, fits again, and so on, with momentum. The vector stays
away from zero exactly if the model is separated. Every step is one pass over the rows that returns as
many numbers as there are regressors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.estimation import kernels, separation_kernels
from panelweave.estimation.fit import MOST_LEVELS, EstimationError, ModelSpec, tree_sum, value_of
from panelweave.session import staged

cloudpickle.register_pickle_by_value(separation_kernels)

#: Steps before the answer is "none found", and the share of a combination's length that counts as zero.
MOST_STEPS, ZERO = 300, 1e-5


@dataclass(frozen=True)
class Separation:
    """``weights`` of the regressors in the combination, the largest of them 1 or -1; the rows that it decides, out of ``n``."""

    weights: dict[str, float]
    rows: int
    n: int

    @property
    def complete(self) -> bool:
        return self.rows == self.n

    def __str__(self) -> str:
        terms = " ".join(f"{'-' if w < 0 else '+'} {abs(w):.4g} {t}" for t, w in self.weights.items())
        return f"{terms.removeprefix('+ ')} decides {self.rows} of {self.n} rows"


def find_separation(table: DataFrame, spec: ModelSpec, category: str = "sector") -> Separation | None:
    """The combination of regressors that separates the outcome of a logit or probit; None if there is none.

    Sector effects take part as dummies. None also stands for a combination that only just separates and is not
    found in MOST_STEPS passes; data sets that overlap or leave a gap take one to some dozens.
    """
    columns, names = [value_of(spec.outcome), *map(value_of, spec.regressors)], [*(["Intercept"] if spec.intercept else []), *spec.regressors]
    if spec.sector:
        levels = sorted(r[0] for r in table.select(category).distinct().limit(MOST_LEVELS + 1).collect())
        if len(levels) > MOST_LEVELS:
            raise ValueError(f"more than {MOST_LEVELS} levels of {category}")
        columns += [(F.col(category) == v).cast("double") for v in levels[1:]]
        names += [f"{category}_{int(v)}" for v in levels[1:]]
    k = len(names)
    with staged(table.select(F.array(*columns).alias("x")), "separation") as packed:
        total = tree_sum(packed.mapInArrow(separation_kernels.turned_squares(spec.intercept), "sums binary"))
        if total is None:
            raise EstimationError("the sample is empty")
        (n,), _, square = kernels.unpack(total, k, 1, 0)
        size = np.sqrt(np.where(np.diag(square) > 0, np.diag(square), 1.0))
        inverse = np.linalg.pinv(square / np.outer(size, size), rcond=1e-12, hermitian=True) / np.outer(size, size)
        before = now = ahead = None
        for t in range(MOST_STEPS):
            total = tree_sum(packed.mapInArrow(separation_kernels.rectified(spec.intercept, before, now, ahead), "sums binary"))
            along, (above, below, touching) = total[:k], total[k:]
            if now is not None:
                # a vector that is positive in every row and at right angles to all regressors: nothing separates
                if touching == 0 or above <= n * ZERO ** 4:
                    return None
                if below <= ZERO ** 2 * above:
                    least = 100 * ZERO * np.sqrt(above / n)
                    rows = tree_sum(packed.mapInArrow(separation_kernels.decided(spec.intercept, now, least), "sums binary"))[0]
                    return _named(names, now, size, int(rows), int(n))
            # steps gather speed: the next vector is rectified beyond the combination just fitted
            fitted = inverse @ along
            before, ahead, now = ahead, fitted if now is None else fitted + t / (t + 3) * (fitted - now), fitted
        return None


def _named(names, weights, size, rows, n) -> Separation:
    counts = np.abs(weights) * size
    kept = counts > 100 * ZERO * counts.max()
    largest = np.abs(weights[kept]).max()
    return Separation({t: float(w / largest) for t, w, k in zip(names, weights, kept, strict=True) if k}, rows, n)
