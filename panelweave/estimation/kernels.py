"""Arrow-batch kernels of the estimators.

Each kernel turns the rows of one task into a few sums. Sums of tasks are added
by Spark, so nothing here depends on how rows are distributed. The module is
shipped with the jobs and uses nothing but numpy and pyarrow.
"""

import numpy as np
import pyarrow as pa

# Rational approximations of erf and erfc (Cody 1969, in the form of Moshier's Cephes).
ERF_T = (9.60497373987051638749e0, 9.00260197203842689217e1, 2.23200534594684319226e3,
         7.00332514112805075473e3, 5.55923013010394962768e4)
ERF_U = (1.0, 3.35617141647503099647e1, 5.21357949780152679795e2, 4.59432382970980127987e3,
         2.26290000613890934246e4, 4.92673942608635921086e4)
ERFC_P = (2.46196981473530512524e-10, 5.64189564831068821977e-1, 7.46321056442269912687e0,
          4.86371970985681366614e1, 1.96520832956077098242e2, 5.26445194995477358631e2,
          9.34528527171957607540e2, 1.02755188689515710272e3, 5.57535335369399327526e2)
ERFC_Q = (1.0, 1.32281951154744992508e1, 8.67072140885989742329e1, 3.54937778887819891062e2,
          9.75708501743205489753e2, 1.82390916687909736289e3, 2.24633760818710981792e3,
          1.65666309194161350182e3, 5.57535340817727675546e2)
ERFC_R = (5.64189583547755073984e-1, 1.27536670759978104416e0, 5.01905042251180477414e0,
          6.16021097993053585195e0, 7.40974269950448939160e0, 2.97886665372100240670e0)
ERFC_S = (1.0, 2.26052863220117276590e0, 9.39603524938001434673e0, 1.20489539808096656605e1,
          1.70814450747565897222e1, 9.60896809063285878198e0, 3.36907645100081516050e0)

ROOT2 = np.sqrt(2.0)
ROOT2PI = np.sqrt(2.0 * np.pi)


def scaled_erfc(z):
    """exp(z²)·erfc(z) for z >= 1."""
    far = z >= 8.0
    near_z = np.where(far, 1.0, z)
    return np.where(
        far,
        np.polyval(ERFC_R, z) / np.polyval(ERFC_S, z),
        np.polyval(ERFC_P, near_z) / np.polyval(ERFC_Q, near_z),
    )


def log_normal_cdf(x):
    """log Φ(x) and the hazard φ(x)/Φ(x); both stay accurate far in the lower tail."""
    low = x < -ROOT2
    tail = scaled_erfc(np.where(low, -x / ROOT2, 1.0))

    z = np.where(low, 0.0, x) / ROOT2
    inner = np.abs(z) <= 1.0
    zi = np.where(inner, z, 0.0)
    erf = zi * np.polyval(ERF_T, zi * zi) / np.polyval(ERF_U, zi * zi)
    zo = np.where(inner, 1.0, np.abs(z))
    upper = 0.5 * np.exp(-zo * zo) * scaled_erfc(zo)  # P(X > |x|), only needed for x > 0 here
    cdf = np.where(inner, 0.5 * (1.0 + erf), 1.0 - upper)

    log_cdf = np.where(low, -0.5 * x * x + np.log(0.5 * tail), np.where(inner, np.log(cdf), np.log1p(-upper)))
    density = np.exp(-0.5 * x * x) / ROOT2PI
    hazard = np.where(low, np.sqrt(2.0 / np.pi) / tail, density / cdf)
    return log_cdf, hazard


def link_terms(link, y, eta):
    """Per row: log-likelihood, score, weight, density of the response and its slope."""
    if link == "linear":
        residual = y - eta
        one = np.ones_like(eta)
        return -0.5 * residual * residual, residual, one, one, np.zeros_like(eta)
    sign = 2.0 * y - 1.0
    if link == "logit":
        mu = 1.0 / (1.0 + np.exp(-np.clip(eta, -700.0, 700.0)))
        spread = mu * (1.0 - mu)
        return -np.logaddexp(0.0, -sign * eta), y - mu, spread, spread, spread * (1.0 - 2.0 * mu)
    log_cdf, hazard = log_normal_cdf(sign * eta)
    score = sign * hazard
    density = np.exp(-0.5 * eta * eta) / ROOT2PI
    return log_cdf, score, score * (score + eta), density, -eta * density


def packed(batch):
    """The array column ``x`` of a batch as a (values per row by rows) matrix.

    One array column crosses into Python several times faster than many plain columns.
    """
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1).T


class Design:
    """Makes the (terms by observations) design matrix from the packed columns.

    A constant, columns, differences of two columns, one dummy per level.
    """

    def __init__(self, columns, differences=None, others=(), category=None, levels=()):
        self.columns, self.differences = tuple(columns), dict(differences or {})
        self.category, self.levels = category, tuple(levels)
        dummies = [f"{category}_{int(v)}" for v in self.levels]
        self.terms = ("Intercept", *self.columns, *self.differences, *dummies)
        more = [c for pair in self.differences.values() for c in pair] + list(others)
        more += [category] if self.levels else []
        # what to pack, design columns first
        self.packed = tuple(dict.fromkeys([*self.columns, *more]))
        self.place = {name: i for i, name in enumerate(self.packed)}

    def value(self, values, parts):
        """A column, or the difference of two."""
        first = values[self.place[parts[0]]]
        return first - values[self.place[parts[1]]] if len(parts) > 1 else np.ascontiguousarray(first)

    def matrix(self, values):
        x = np.empty((len(self.terms), values.shape[1]))
        x[0] = 1.0
        at = 1 + len(self.columns)
        x[1:at] = values[:at - 1]
        for parts in self.differences.values():
            x[at] = self.value(values, parts)
            at += 1
        if self.levels:
            code = values[self.place[self.category]]
            for level in self.levels:
                x[at] = code == level
                at += 1
        return x


class Equation:
    """One model: link, outcome (a column, or a difference of two) and its rows of the design matrix."""

    def __init__(self, link, outcome, index):
        self.link, self.outcome = link, outcome
        first, last = index[0], index[-1]
        # a slice is a view, a list of rows a copy
        self.index = slice(first, last + 1) if list(index) == list(range(first, last + 1)) else list(index)
        self.size = len(index)

    def rows(self, x, y, beta):
        xm = x[self.index]
        return xm, link_terms(self.link, y, beta @ xm)


def weighted_squares(x, weight):
    """X W Xᵀ of non-negative weights, as a product of one matrix with its transpose."""
    root = x * np.sqrt(np.maximum(weight, 0.0))
    return root @ root.T


N_SCALARS = 5  # rows, log-likelihood, sum of y, sum of y², sum of densities


def pack(scalars, vectors, square):
    return np.concatenate([scalars, *vectors, square[np.triu_indices(len(square))]])


def packed_size(k, n_scalars=N_SCALARS, n_vectors=2):
    """Length of what ``pack`` makes of so many scalars and vectors of length k."""
    return n_scalars + n_vectors * k + k * (k + 1) // 2


def unpack(values, k, n_scalars=N_SCALARS, n_vectors=2):
    """Inverse of ``pack``: scalars, vectors, full symmetric matrix."""
    split = n_scalars + n_vectors * k
    vectors = values[n_scalars:split].reshape(n_vectors, k)
    square = np.zeros((k, k))
    square[np.triu_indices(k)] = values[split:]
    return values[:n_scalars], vectors, square + square.T - np.diag(np.diag(square))


def sums_batch(totals):
    """The sums of a task as one row of plain bytes, the models one after the other."""
    return pa.RecordBatch.from_arrays([pa.array([np.concatenate(list(totals)).tobytes()], pa.binary())], names=["sums"])


def add_sums(batches):
    """Kernel: the rows of a task added up to one."""
    total = None
    for batch in batches:
        for part in batch.column("sums"):
            values = np.frombuffer(part.as_buffer(), dtype=np.float64)
            total = values.copy() if total is None else total + values
    if total is not None:
        yield sums_batch([total])


def likelihood_sums(design, equations, betas):
    """Kernel: per model the scalars, gradient, density-slope and curvature sums of a task."""

    def run(batches):
        totals = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values = packed(batch)
            x = design.matrix(values)
            for m, equation in equations.items():
                y = design.value(values, equation.outcome)
                xm, (ll, score, weight, density, slope) = equation.rows(x, y, betas[m])
                part = pack(
                    [len(y), ll.sum(), y.sum(), y @ y, density.sum()],
                    [xm @ score, xm @ slope],
                    weighted_squares(xm, weight),
                )
                totals[m] = totals[m] + part if m in totals else part
        if totals:
            yield sums_batch(totals.values())

    return run


def group_scores(design, equations, betas):
    """Kernel: per model the number of groups and the squares of their summed scores (column ``sums``); models lie side by side.

    Rows come as (group, row, x), sorted by group within a file, ``row`` counting
    the rows of the file. A group that another follows and precedes in the same file
    is whole. The first and the last of a file, or of a piece of it, may go on
    elsewhere; their summed scores are handed out as they are, in ``vector``.
    """
    widths = {m: e.size for m, e in equations.items()}

    def run(batches):
        totals, cut = {}, []
        # the group at the end of the last batch: key, sum, whether its beginning was seen, next row
        open_key, open_sum, begun, next_row = None, None, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = packed(batch)
            x = design.matrix(values)
            keys, rows = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "row"))
            scores = []
            for m, equation in equations.items():
                xm, (_, score, _, _, _) = equation.rows(x, design.value(values, equation.outcome), betas[m])
                scores.append(xm * score)
            scores = np.vstack(scores)
            broken = np.r_[True, rows[1:] != rows[:-1] + 1]  # another file or piece begins here
            starts = np.flatnonzero(broken | np.r_[True, keys[1:] != keys[:-1]])
            sums = np.add.reduceat(scores, starts, axis=1)
            keys, broken = keys[starts], broken[starts]
            broken[0] = next_row is None or rows[0] != next_row
            # a group is whole if it begins and ends next to others of its file
            has_begun, has_ended = ~broken, ~np.r_[broken[1:], True]
            if open_key is not None and not broken[0] and keys[0] == open_key:
                sums[:, 0] += open_sum
                has_begun[0] = begun
            elif open_key is not None:
                if begun and not broken[0]:
                    totals = add_squares(totals, open_sum[:, None], widths)
                else:
                    cut.append((open_key, open_sum))
            open_key, open_sum, begun, next_row = int(keys[-1]), sums[:, -1], bool(has_begun[-1]), rows[-1] + 1
            whole = (has_begun & has_ended)[:-1]
            if whole.any():
                totals = add_squares(totals, sums[:, :-1][:, whole], widths)
            cut += [(int(keys[i]), sums[:, i]) for i in np.flatnonzero(~whole)]
        if open_key is not None:
            cut.append((open_key, open_sum))
        if cut:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key for key, _ in cut], pa.int64()), pa.array([u.tolist() for _, u in cut], pa.list_(pa.float64())),
                 pa.nulls(len(cut), pa.binary())], names=["group", "vector", "sums"])
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.float64())), sums_batch(totals.values()).column(0)],
                names=["group", "vector", "sums"])

    return run


def add_squares(totals, x, widths):
    """Add the number of columns of x and XᵀX for each model's rows of it."""
    at = 0
    for m, k in widths.items():
        block = np.ascontiguousarray(x[at:at + k])
        part = pack([x.shape[1]], [], block @ block.T)
        totals[m] = totals[m] + part if m in totals else part
        at += k
    return totals


def cross_products(widths):
    """Kernel: per model the number of rows and XᵀX of its columns; models lie side by side."""

    def run(batches):
        totals = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            totals = add_squares(totals, packed(batch), widths)
        if totals:
            yield sums_batch(totals.values())

    return run
