"""Arrow-batch kernels of the iterative rectifier; shipped with the jobs, nothing but numpy and pyarrow."""

import numpy as np

from panelweave.estimation import kernels


#: How far beyond zero.
OVER = 0.9


def _turned(batch, intercept):
    """Regressors (terms by rows), with the sign turned round where the outcome, the first value, is 0."""
    values = kernels.packed(batch)
    x = np.vstack([np.ones(values.shape[1]), values[1:]]) if intercept else values[1:]
    return x * (2.0 * values[0] - 1.0)


def turned_squares(intercept):
    """Kernel: rows, and the squares and products of the turned regressors."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _turned(batch, intercept)
                part = kernels.pack([x.shape[1]], [], x @ x.T)
                total = part if total is None else total + part
        if total is not None:
            yield kernels.sums_batch([total])

    return run


def _rectified(z):
    """Entries below zero set to zero and as far again beyond it, nearly, which takes fewer steps."""
    return np.maximum(z, -OVER * z)


def rectified(intercept, before, now, ahead):
    """Kernel: products of the turned regressors with the rectified combination ``ahead`` (None: ones); then squares of the
    combination ``now`` above and below zero; then rows in which what ``now`` was fitted to, ``before`` rectified, does not exceed it."""

    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _turned(batch, intercept)
            if now is None:
                part = np.r_[x.sum(1), x.shape[1], 0.0, x.shape[1]]
            else:
                z = now @ x
                fitted_to = 1.0 if before is None else _rectified(before @ x)
                part = np.r_[x @ _rectified(ahead @ x), (np.maximum(z, 0.0) ** 2).sum(), (np.minimum(z, 0.0) ** 2).sum(), (fitted_to - z <= 0.0).sum()]
            total = part if total is None else total + part
        if total is not None:
            yield kernels.sums_batch([total])

    return run


def decided(intercept, weights, least):
    """Kernel: rows in which the combination is above ``least``."""

    def run(batches):
        rows = sum(int((weights @ _turned(batch, intercept) > least).sum()) for batch in batches if batch.num_rows)
        yield kernels.sums_batch([np.array([float(rows)])])

    return run
