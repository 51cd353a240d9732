"""Arrow-batch kernels of the estimator with absorbed effects; shipped with the jobs, nothing but numpy and pyarrow."""

import numpy as np
import pyarrow as pa

from panelweave.estimation import kernels


def _point(batch, beta, link):
    """Regressors (terms by rows), outcome and the terms of the link, at the effects that the rows carry."""
    values = kernels.packed(batch)
    x, y = values[1:], np.ascontiguousarray(values[0])
    eta = beta @ x + batch.column("effect").to_numpy(zero_copy_only=False)
    return x, y, kernels.link_terms(link, y, eta)


def level_sums(link, beta):
    """Kernel: rows (level, v) with weight, score, slope and border of each run of a level, and one row of sums for the task."""

    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, (ll, score, weight, density, slope) = _point(batch, beta, link)
            part = kernels.pack([len(y), ll.sum(), y.sum(), y @ y, density.sum()], [x @ score, x @ slope],
                                kernels.weighted_squares(x, weight))
            total = part if total is None else total + part
            level = batch.column("level").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, level[1:] != level[:-1]])
            v = np.add.reduceat(np.vstack([weight, score, slope, x * weight]), starts, axis=1).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("level").take(pa.array(starts)), pa.array(v.tolist(), pa.list_(pa.float64())), pa.nulls(len(starts), pa.binary())],
                names=["level", "v", "sums"])
        if total is not None:
            kind = batch.schema.field("level").type
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.list_(pa.float64())), kernels.sums_batch([total]).column(0)], names=["level", "v", "sums"])

    return run


def eliminated(k):
    """Kernel: what elimination of the levels takes from the regressors' gradient, slope and Hessian."""

    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            weight, score, slope = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("weight", "score", "slope"))
            border = batch.column("border").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            centre = border / weight[:, None]
            part = kernels.pack([(score * score / weight).sum()], [score @ centre, slope @ centre], border.T @ centre)
            total = part if total is None else total + part
        if total is not None:
            yield kernels.sums_batch([total])

    return run


def influences(link, beta):
    """Kernel: rows (cluster, z): score times the regressors less their weighted mean in the level; then times the level's pull."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, _, (_, score, _, _, _) = _point(batch, beta, link)
            centre = batch.column("centre").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            pull = batch.column("pull").to_numpy(zero_copy_only=False)
            z = np.vstack([(x - centre) * score, score * pull]).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("cluster"), pa.array(z.tolist(), pa.list_(pa.float64()))], names=["cluster", "z"])

    return run
