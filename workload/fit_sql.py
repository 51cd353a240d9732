"""Model fits as SQL text, the independent check of the estimators.

Newton steps are written out one after the other, matrices are lists of lists and
inverted by elimination. Every step forms all products of two regressors for each
row, so this is for checks on small samples.
"""

from __future__ import annotations

from dataclasses import dataclass

from panelweave.fixed_values import TERM_GROUPS, TERM_LABELS, TIME_VARYING
from workload.frames import CONTROLS_SQL

CONTROLS = CONTROLS_SQL.split(", ")
MEANS = [f"{v}_mean" for v in TIME_VARYING]
DUMMIES = [f"sector_{i}" for i in range(2, 16)]
STEPS = 8


def _series(n: int) -> str:
    """1 / (2i + 1)!! for i = 0, 1, ..., of the series of the normal distribution function."""
    out, product = [], 1.0
    for i in range(n):
        product *= 2 * i + 1
        out.append(repr(1.0 / product))
    return f"[{', '.join(out)}]::DOUBLE[]"


def density(x: str) -> str:
    return f"(exp(-0.5 * ({x}) * ({x})) / sqrt(2 * pi()))"


def normal(x: str) -> str:
    """Distribution function for arguments up to about 6 in size."""
    powers = f"list_sum(list_transform({_series(80)}, lambda c, i: c * pow(({x}) * ({x}), i - 1)))"
    return f"(0.5 + {density(x)} * ({x}) * {powers})"


def p_value(z: str) -> str:
    return f"CASE WHEN abs({z}) < 6 THEN greatest(0.0, 2 * (1 - {normal(f'abs({z})')})) ELSE 0.0 END"


def stars(p: str) -> str:
    return f"CASE WHEN {p} < 0.01 THEN '***' WHEN {p} < 0.05 THEN '**' WHEN {p} < 0.10 THEN '*' ELSE '' END"


LINKS = {
    "logit": ("1 / (1 + exp(-eta))", "y - mu", "mu * (1 - mu)", "mu * (1 - mu)", "mu * (1 - mu) * (1 - 2 * mu)"),
    "probit": (normal("eta"), f"(y / mu - (1 - y) / (1 - mu)) * {density('eta')}", "sc * (sc + eta)", density("eta"),
               f"-eta * {density('eta')}"),
    "linear": ("eta", "y - mu", "1.0", "1.0", "0.0"),
}


def _inverse(name: str, source: str, k: int) -> dict[str, str]:
    """``name`` (m): inverse of the matrix h of the only row of ``source``."""
    identity = "CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return {
        f"{name}_steps": f"""
  SELECT 0 AS k, list_transform(range(1, {k + 1}), lambda i: h[i] || list_transform(range(1, {k + 1}), lambda j: {identity})) AS m
  FROM {source}
  UNION ALL
  SELECT k + 1, list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {2 * k + 1}), lambda j:
    CASE WHEN i = k + 1 THEN m[i][j] / m[k + 1][k + 1] ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] END))
  FROM {name}_steps WHERE k < {k}""",
        name: f"SELECT list_transform(m, lambda r: r[{k + 1}:{2 * k}]) AS m FROM {name}_steps WHERE k = {k}",
    }


@dataclass(frozen=True)
class Model:
    """One model on a named sample; ``values`` are the regressors as SQL, ``terms`` their names."""

    name: str
    source: str
    link: str
    outcome: str
    terms: tuple[str, ...]
    values: tuple[str, ...]
    stage: str = "Preference"
    number: str = ""
    label: str = ""
    sector: bool = False
    intercept: bool = True

    def ctes(self) -> dict[str, str]:
        """``name``: b, v, n, groups, log_lik, r2, d, slope in one row; ``name_c`` coefficients, ``name_e`` effects."""
        n, k = self.name, len(self.terms)
        mu, score, weight, dens, slope = LINKS[self.link]
        x = ", ".join(f"CAST({v} AS DOUBLE)" for v in self.values)
        out = {f"{n}_d": f"SELECT pid AS g, CAST({self.outcome} AS DOUBLE) AS y, [{x}] AS x FROM {self.source}",
               f"{n}_b0": f"SELECT list_transform(range({k}), lambda i: 0.0::DOUBLE) AS b"}
        steps = 1 if self.link == "linear" else STEPS
        indexes = f"range(1, {k + 1})"
        for s in range(steps + 1):
            out[f"{n}_r{s}"] = f"""SELECT *, {weight} AS w, {dens} AS dens, {slope} AS slope FROM (SELECT *, {score} AS sc FROM (
              SELECT *, {mu} AS mu FROM (SELECT *, list_dot_product(x, b) AS eta FROM {n}_d, {n}_b{s})))"""
            out[f"{n}_g{s}"] = f"""SELECT list(v ORDER BY i) AS g FROM (
              SELECT i, sum(sc * x[i]) AS v FROM {n}_r{s}, unnest({indexes}) t(i) GROUP BY i)"""
            out[f"{n}_h{s}"] = f"""SELECT list(r ORDER BY i) AS h FROM (SELECT i, list(v ORDER BY j) AS r FROM (
              SELECT i, j, sum(w * x[i] * x[j]) AS v FROM {n}_r{s}, unnest({indexes}) t(i), unnest({indexes}) u(j)
              GROUP BY i, j) GROUP BY i)"""
            out |= _inverse(f"{n}_i{s}", f"{n}_h{s}", k)
            if s < steps:
                out[f"{n}_b{s + 1}"] = f"""SELECT list_transform({indexes}, lambda i: b[i] + list_dot_product(m[i], g)) AS b
                  FROM {n}_b{s}, {n}_g{s}, {n}_i{s}"""
        s = steps
        out[f"{n}_u"] = f"""SELECT list(r ORDER BY i) AS u FROM (SELECT i, list(v ORDER BY j) AS r FROM (
              SELECT i, j, sum(u[i] * u[j]) AS v FROM (
                SELECT g, list(v ORDER BY i) AS u FROM (SELECT g, i, sum(sc * x[i]) AS v FROM {n}_r{s}, unnest({indexes}) t(i)
                GROUP BY g, i) GROUP BY g), unnest({indexes}) t(i), unnest({indexes}) w(j) GROUP BY i, j) GROUP BY i)"""
        total = {"linear": "sum(-0.5 * sc * sc)"}.get(self.link, "sum(ln(CASE WHEN y = 1 THEN mu ELSE 1 - mu END))")
        null = "n * (p * ln(p) + (1 - p) * ln(1 - p))"
        r2 = f"1 - log_lik / ({null})"
        if self.link == "linear":
            r2 = "1 + 2 * log_lik / (yy - n * p * p)" if self.intercept else "1 + 2 * log_lik / yy"
        out[f"{n}_t"] = f"""SELECT *, {r2} AS r2 FROM (SELECT count(*) AS n, count(DISTINCT g) AS groups, {total} AS log_lik,
              avg(y) AS p, sum(y * y) AS yy, avg(dens) AS d FROM {n}_r{s})"""
        out[f"{n}_l"] = f"""SELECT list(v ORDER BY i) AS slope FROM (
              SELECT i, avg(slope * x[i]) AS v FROM {n}_r{s}, unnest({indexes}) t(i) GROUP BY i)"""
        out[n] = f"""SELECT b, n, groups, log_lik, r2, d, slope, list_transform({indexes}, lambda i: list_transform({indexes}, lambda j:
                groups / (groups - 1.0) * (n - 1.0) / (n - {k}.0) * list_dot_product(a[i], m[j]))) AS v
              FROM (SELECT list_transform({indexes}, lambda i: list_transform({indexes}, lambda j: list_dot_product(m[i], u[j]))) AS a, m
                    FROM {n}_i{s}, {n}_u), {n}_b{s}, {n}_t, {n}_l"""
        names = f"[{', '.join(repr(t) for t in self.terms)}]"
        out[f"{n}_c"] = f"""SELECT i - 1 AS term_no, {names}[i] AS term, b[i] AS estimate, sqrt(v[i][i]) AS std_err
              FROM {n}, unnest({indexes}) t(i)"""
        out[f"{n}_e"] = f"""SELECT term, estimate, sqrt(list_dot_product(q, list_transform(v, lambda r: list_dot_product(r, q)))) AS std_err
              FROM (SELECT {names}[i] AS term, d * b[i] AS estimate, v, list_transform({indexes}, lambda j:
                    CASE WHEN i = j THEN d ELSE 0.0 END + b[i] * slope[j]) AS q FROM {n}, unnest({indexes}) t(i))"""
        return out

    def head(self) -> str:
        sector = "Yes" if self.sector else "No"
        return f"'{self.stage}' AS stage, '{self.number}' AS model_no, '{self.label}' AS model, '{sector}' AS sector_fe"

    def wald(self) -> dict[str, str]:
        """``name_w``: joint test of the person means (chi2, df, p), empty without them."""
        n, at = self.name, [i for i, t in enumerate(self.terms, 1) if t.endswith("_mean")]
        if not at:
            return {f"{n}_w": "SELECT NULL::DOUBLE AS chi2, NULL::INTEGER AS df, NULL::DOUBLE AS p"}
        k, places = len(at), f"{at}"
        tail = " + ".join(f"pow(sqrt(chi2), {2 * i + 1}) / {_double_factorial(2 * i + 1)}" for i in range((k - 1) // 2))
        if k % 2 == 0:
            raise ValueError("the closed form is for odd degrees of freedom")
        return {
            f"{n}_ws": f"""SELECT list_transform({places}, lambda i: list_transform({places}, lambda j: v[i][j])) AS h,
                 list_transform({places}, lambda i: b[i]) AS b FROM {n}""",
            **_inverse(f"{n}_wi", f"{n}_ws", k),
            f"{n}_w": f"""SELECT chi2, {k} AS df, {p_value('sqrt(chi2)')} + 2 * {density('sqrt(chi2)')} * ({tail}) AS p FROM (
                 SELECT list_dot_product(b, list_transform(m, lambda r: list_dot_product(r, b))) AS chi2 FROM {n}_ws, {n}_wi)""",
        }


def column(name: str) -> str:
    return '"' + name + '"'


def _double_factorial(n: int) -> float:
    return float(n * _double_factorial(n - 2)) if n > 1 else 1.0


#: Samples with person means of the regressors that vary, and deviations from them.
SAMPLES = {
    f"{name}_m": f"SELECT *, {', '.join(f'avg({v}) OVER p AS {v}_mean' for v in TIME_VARYING)} FROM {name} WINDOW p AS (PARTITION BY pid)"
    for name in ("s1", "s2", "s2full")
} | {
    f"{name}_m": f"SELECT pid, {', '.join(f'{v} - avg({v}) OVER p AS {v}' for v in (outcome, *TIME_VARYING))} FROM {name} "
    "WINDOW p AS (PARTITION BY pid)"
    for name, outcome in (("w1", "plb0097"), ("w2", "plb0095_v1"))
}
DEVIATIONS = {
    "s2": f"SELECT pid, {', '.join(f'{v} - avg({v}) OVER p AS {v}' for v in ('plb0095_v1', *TIME_VARYING))} FROM s2 "
    "WINDOW p AS (PARTITION BY pid)",
}


def binary_models(stage: str, source: str, outcome: str, extra: tuple[str, ...] = ()) -> list[Model]:
    """The six columns of a published table."""
    grid = (("Logit", "logit", False), ("Probit", "probit", False), ("CRE Probit", "probit", True))
    out = []
    for label, link, means in grid:
        for sector in (False, True):
            regressors = [*extra, *CONTROLS, *(MEANS if means else ())]
            terms = ["Intercept", *regressors, *(DUMMIES if sector else ())]
            values = ["1", *regressors, *([f"sector = {i}" for i in range(2, 16)] if sector else ())]
            number = f"({len(out) + 1})"
            out.append(Model(f"{source}_f{len(out) + 1}", f"{source}_m", link, outcome, tuple(terms), tuple(values), stage, number, label, sector))
    return out


def within_model(stage: str, source: str, outcome: str, number: str) -> Model:
    return Model(f"{source}_fw", f"{source}_m" if source.startswith("w") else f"{source}_dev", "linear", outcome, TIME_VARYING,
                 TIME_VARYING, stage, number, "FE LPM", intercept=False)


def text(models: list[Model], body: str) -> str:
    """The check: samples, fits, then ``body``."""
    ctes = SAMPLES | {f"{k}_dev": v for k, v in DEVIATIONS.items()}
    for m in models:
        ctes = ctes | m.ctes() | m.wald()
    used = ",\n".join(f"{name} AS {'' if name.endswith('_steps') else 'MATERIALIZED '}({sql})" for name, sql in ctes.items())
    return f"WITH {used}\n{body}"


def coefficients(m: Model, terms: list[str] | None = None) -> str:
    """All coefficients, or only those of ``terms``, numbered anew."""
    number, only = "term_no", ""
    if terms is not None:
        number, only = f"(list_position({terms}, term) - 1)", f" WHERE term IN ({', '.join(map(repr, terms))})"
    tidy = f"SELECT {m.head()}, {number}::INTEGER AS term_no, term, estimate, std_err, estimate / std_err AS z FROM {m.name}_c{only}"
    return text([m], f"""SELECT stage, model_no, model, sector_fe, term_no, term, round(estimate, 6) AS estimate,
        round(std_err, 6) AS std_err, round(z, 4) AS z, round(p, 5) AS p_value, {stars('p')} AS stars
      FROM (SELECT *, {p_value('z')} AS p FROM ({tidy}))""")


def _effects(models: list[Model], terms) -> str:
    parts = [
        f"SELECT {m.head()}, list_position({list(terms)}, term) - 1 AS term_no, term, estimate, std_err, estimate / std_err AS z "
        f"FROM {m.name}_e WHERE term IN ({', '.join(repr(t) for t in terms)})" for m in models
    ]
    return f"SELECT *, {p_value('z')} AS p FROM ({' UNION ALL '.join(parts)})"


def effects(models: list[Model], terms=CONTROLS) -> str:
    return text(models, f"""SELECT stage, model_no, model, sector_fe, term_no::INTEGER AS term_no, term, round(estimate, 6) AS estimate,
        round(std_err, 6) AS std_err, round(z, 4) AS z, round(p, 5) AS p_value, {stars('p')} AS stars FROM ({_effects(models, terms)})""")


def _stats(models: list[Model]) -> str:
    return " UNION ALL ".join(
        f"SELECT {m.head()}, n, groups, {'NULL' if m.link == 'linear' else 'log_lik'} AS log_lik, r2, chi2, df, p FROM {m.name}, {m.name}_w"
        for m in models)


def wald(models: list[Model]) -> str:
    return text(models, f"""SELECT stage, model_no, model, sector_fe, round(chi2, 4) AS wald_chi2, df AS wald_df, round(p, 6) AS wald_p
        FROM ({_stats(models)})""")


def table(models: list[Model], terms=CONTROLS) -> str:
    """The published layout."""
    groups = [("WFH Preference", ("plb0097",)), *TERM_GROUPS]
    order = [(g, t) for g, members in groups for t in members if t in terms]
    layout = ", ".join(f"({i}, '{g}', '{t}', '{TERM_LABELS[t]}')" for i, (g, t) in enumerate(order))
    numbers = [m.number for m in models]
    missing = ", ".join(
        f"coalesce(max(cell) FILTER (model_no = '{n}'), CASE WHEN line = 0 THEN '---' ELSE '' END) AS {column(n)}" for n in numbers)
    facts = ", ".join(f"max(cell) FILTER (model_no = '{n}') AS {column(n)}" for n in numbers)
    last = 2 * len(order)
    return text(models, f"""SELECT (position * 2 + line)::INTEGER AS row_no, "group", CASE WHEN line = 0 THEN label ELSE '' END AS label, {missing}
      FROM (VALUES {layout}) o(position, "group", term, label) CROSS JOIN (VALUES (0), (1)) k(line) LEFT JOIN (
        SELECT term AS t, model_no, 0 AS l, printf('%.4f', estimate) || {stars('p')} AS cell FROM ({_effects(models, terms)})
        UNION ALL SELECT term, model_no, 1, '(' || printf('%.4f', std_err) || ')' FROM ({_effects(models, terms)})
      ) ON t = term AND l = line GROUP BY position, line, "group", label
      UNION ALL
      SELECT ({last} + place)::INTEGER, '', name, {facts} FROM (
        SELECT model_no, unnest(range(6)) AS place, unnest(['Model', 'Sector FE', 'N', 'R2 (McFadden / within)', 'Log-likelihood',
          'Mundlak means (p)']) AS name, unnest([model, sector_fe, format('{{:,}}', n), printf('%.4f', r2),
          CASE WHEN log_lik IS NULL THEN '---' ELSE printf('%.1f', log_lik) END,
          CASE WHEN p IS NULL THEN '---' WHEN p < 0.001 THEN '< 0.001' ELSE printf('%.3f', p) END]) AS cell
        FROM ({_stats(models)})) GROUP BY place, name""")


def matrix(models: list[Model]) -> str:
    """Absolute effects and texts by stage and model."""
    shown = _effects(models, CONTROLS)
    columns = ", ".join(
        f"max(size) FILTER (c = '{c}') AS {column(c + '_size')}, max(txt) FILTER (c = '{c}') AS {column(c + '_text')}"
        for c in sorted(f"{m.stage} / {m.label}" for m in models))
    labels = ", ".join(f"('{t}', '{label}')" for t, label in TERM_LABELS.items())
    return text(models, f"""SELECT term_no, term, {columns}, label, round(scale, 6) AS scale_max FROM (
        SELECT term_no::INTEGER AS term_no, term, stage || ' / ' || model AS c, round(abs(estimate), 6) AS size,
               printf('%.3f', estimate) || {stars('p')} AS txt, max(abs(estimate)) OVER () AS scale FROM ({shown}))
      JOIN (VALUES {labels}) l(t, label) ON t = term GROUP BY term_no, term, label, scale""")


def between(m: Model) -> str:
    return text([m], f"""SELECT '{m.stage}' AS stage, '{m.number}' AS model_no, w.term, round(w.estimate, 6) AS within,
        round(d.estimate, 6) AS difference, round(w.estimate + d.estimate, 6) AS between
      FROM {m.name}_c w JOIN {m.name}_c d ON d.term = w.term || '_mean'""")


def within_table(models: list[Model]) -> str:
    """Terms by stage as texts, with the number of rows and the within R² at the end."""
    layout = ", ".join(f"({i}, '{t}', '{TERM_LABELS[t]}')" for i, t in enumerate(TIME_VARYING))
    cells = ", ".join(f"max(cell) FILTER (stage = '{m.stage}') AS {column(m.stage)}" for m in models)
    last = 2 * len(TIME_VARYING)
    return text(models, f"""SELECT (position * 2 + line)::INTEGER AS row_no, CASE WHEN line = 0 THEN label ELSE '' END AS label, {cells}
      FROM (VALUES {layout}) o(position, t, label) JOIN (
        SELECT term, stage, 0 AS line, printf('%.4f', estimate) || {stars('p')} AS cell FROM ({_effects(models, TIME_VARYING)})
        UNION ALL SELECT term, stage, 1, '(' || printf('%.4f', std_err) || ')' FROM ({_effects(models, TIME_VARYING)})
      ) ON t = term GROUP BY position, line, label
      UNION ALL SELECT {last}, 'N', {', '.join(f"max(format('{{:,}}', n)) FILTER (stage = '{m.stage}')" for m in models)} FROM ({_stats(models)})
      UNION ALL SELECT {last + 1}, 'Within R2', {', '.join(f"max(printf('%.4f', r2)) FILTER (stage = '{m.stage}')" for m in models)}
      FROM ({_stats(models)})""")
