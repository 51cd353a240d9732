"""Model fits: cases with a closed form, and the published suites checked by fits in SQL."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from panelweave.estimation import report
from panelweave.estimation.absorb import fit_absorbed
from panelweave.estimation.fit import ModelSpec, fit_models, gram, null_log_lik
from panelweave.estimation.separation import find_separation
from panelweave.fixed_values import ACTUAL, CONTROLS, TIME_VARYING, WILLING
from panelweave.functions import columns as C
from panelweave.operators import panel, sample
from panelweave.operators.derive import treatment_dummies
from panelweave.plans import suites
from panelweave.session import stage, stage_folder
from panelweave.sources import layout
from workload import fit_sql, inputs
from workload.catalog import query, rounded
from workload.frames import CONTROLS_SQL, table

# -- sums of squares and the within estimator -------------------------------------------

GRAM_COLUMNS = ("age", "sex", "pgisced97", "log_income", "sqm_per_head", "plh0173")
_GRAM_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS row_term, '{b}' AS column_term, round(sum({a} * {b}), 3) AS value FROM s1"
    for a in GRAM_COLUMNS for b in GRAM_COLUMNS
)


@query("gram_matrix", _GRAM_SQL)
def gram_matrix(spark, sf_dir):
    rows = sample.analysis_sample(inputs.master(spark, sf_dir), sample.PREFERENCE)
    _, square = gram(rows, list(GRAM_COLUMNS))
    cells = [
        (a, b, float(square[i, j])) for i, a in enumerate(GRAM_COLUMNS) for j, b in enumerate(GRAM_COLUMNS)
    ]
    return rounded(
        spark.createDataFrame(cells, "row_term string, column_term string, value double"), 3, "value"
    )


def _within_table(spark, sf_dir, regressors):
    rows = sample.analysis_sample(inputs.master(spark, sf_dir), sample.PREFERENCE_WITHIN)
    columns = [WILLING, *regressors]
    return stage(
        panel.add_group_means(stage(rows.select("pid", "syear", *columns), "rows"), columns), "within"
    )


# two regressors: the normal equations have a closed form
_FE_SQL = """
    WITH d AS (SELECT pid, plb0097 - avg(plb0097) OVER p AS y, plh0173 - avg(plh0173) OVER p AS a,
                      plb0193_h - avg(plb0193_h) OVER p AS b FROM w1 WINDOW p AS (PARTITION BY pid)),
    g AS (SELECT count(*) AS n, count(DISTINCT pid) AS groups, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb,
                 sum(a * y) AS ay, sum(b * y) AS by_, sum(y * y) AS yy FROM d),
    c AS (SELECT *, aa * bb - ab * ab AS det, (bb * ay - ab * by_) / (aa * bb - ab * ab) AS beta_a,
                 (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS beta_b FROM g),
    u AS (SELECT pid, sum(a * (y - beta_a * a - beta_b * b)) AS ua, sum(b * (y - beta_a * a - beta_b * b)) AS ub
          FROM d, c GROUP BY pid),
    m AS (SELECT sum(ua * ua) AS maa, sum(ua * ub) AS mab, sum(ub * ub) AS mbb FROM u),
    e AS (SELECT sum((y - beta_a * a - beta_b * b) * (y - beta_a * a - beta_b * b)) AS ssr FROM d, c),
    v AS (SELECT c.*, e.ssr, groups / (groups - 1.0) * (n - 1.0) / (n - 2.0) AS f,
                 bb * bb * maa - 2 * ab * bb * mab + ab * ab * mbb AS va,
                 ab * ab * maa - 2 * ab * aa * mab + aa * aa * mbb AS vb FROM c, m, e)"""


@query("fe_lpm_clustered", f"""{_FE_SQL}
    SELECT 'plh0173' AS term, round(beta_a, 6) AS estimate, round(sqrt(f * va) / det, 6) AS std_err FROM v
    UNION ALL SELECT 'plb0193_h', round(beta_b, 6), round(sqrt(f * vb) / det, 6) FROM v""")
def fe_lpm_clustered(spark, sf_dir):
    regressors = ("plh0173", "plb0193_h")
    spec = ModelSpec("", "FE LPM", "linear", f"{WILLING}_within",
                     tuple(f"{r}_within" for r in regressors), intercept=False)
    fits = suites.rename_within(fit_models(_within_table(spark, sf_dir, regressors), [spec]))
    return rounded(
        report.coefficients(spark, "Preference", fits).select("term", "estimate", "std_err"),
        6, "estimate", "std_err",
    )


@query("within_r2", f"""{_FE_SQL}
    SELECT n, groups AS clusters, round(1 - ssr / yy, 6) AS r2 FROM v""")
def within_r2(spark, sf_dir):
    regressors = ("plh0173", "plb0193_h")
    spec = ModelSpec("", "FE LPM", "linear", f"{WILLING}_within",
                     tuple(f"{r}_within" for r in regressors), intercept=False)
    fits = fit_models(_within_table(spark, sf_dir, regressors), [spec])
    return rounded(report.model_stats(spark, "Preference", fits).select("n", "clusters", "r2"), 6, "r2")


@query("layout_fit", f"""{_FE_SQL}
    SELECT 'plh0173' AS term, round(beta_a, 6) AS estimate, round(sqrt(f * va) / det, 6) AS std_err FROM v
    UNION ALL SELECT 'plb0193_h', round(beta_b, 6), round(sqrt(f * vb) / det, 6) FROM v""")
def layout_fit(spark, sf_dir):
    """The within estimates from rows that lie by person: means and scores move none."""
    regressors = ("plh0173", "plb0193_h")
    rows = sample.analysis_sample(inputs.master(spark, sf_dir), sample.PREFERENCE_WITHIN).select("pid", "syear", WILLING, *regressors)
    stored = layout.write_by_person(rows, f"{stage_folder(spark)}/layout-{uuid.uuid4().hex}", 8)
    design = layout.write_by_person(layout.add_person_means(stored, [WILLING, *regressors]), f"{stage_folder(spark)}/layout-{uuid.uuid4().hex}", 8)
    spec = ModelSpec("", "FE LPM", "linear", f"{WILLING}_within", tuple(f"{r}_within" for r in regressors), intercept=False)
    fits = suites.rename_within(fit_models(design, [spec], by_cluster=True))
    return rounded(report.coefficients(spark, "Preference", fits).select("term", "estimate", "std_err"), 6, "estimate", "std_err")


@query("linear_mundlak_equals_fe", """
    WITH d AS (SELECT plb0097 - avg(plb0097) OVER p AS y, plh0173 - avg(plh0173) OVER p AS x
               FROM w1 WINDOW p AS (PARTITION BY pid))
    SELECT m.model, round(sum(x * y) / sum(x * x), 6) AS estimate
    FROM d, (VALUES ('within'), ('with person means')) m(model) GROUP BY m.model""")
def linear_mundlak_equals_fe(spark, sf_dir):
    """Least squares on regressor and person mean gives the within estimate."""
    table = _within_table(spark, sf_dir, ("plh0173",))
    within, means = fit_models(table, [
        ModelSpec("", "within", "linear", f"{WILLING}_within", ("plh0173_within",), intercept=False),
        ModelSpec("", "with person means", "linear", WILLING, ("plh0173", "plh0173_mean")),
    ])
    rows = [("within", float(within.beta[0])), ("with person means", float(means.beta[1]))]
    return rounded(spark.createDataFrame(rows, "model string, estimate double"), 6, "estimate")


# least squares fits the totals of every regressor over the outcome exactly
def _within_totals_sql(name, source, outcome):
    deviations = ", ".join(f"{v} - avg({v}) OVER (PARTITION BY pid) AS {v}" for v in (outcome, *TIME_VARYING))
    totals = " UNION ALL ".join(
        f"SELECT '{name}' AS stage, '{v}' AS term, round(sum({v} * {outcome}), 4) AS total FROM d" for v in TIME_VARYING
    )
    return f"SELECT * FROM (WITH d AS (SELECT {deviations} FROM {source}) {totals})"


@query("fe_lpm_totals", _within_totals_sql("Preference", "w1", WILLING)
       + " UNION ALL " + _within_totals_sql("Realization", "w2", ACTUAL))
def fe_lpm_totals(spark, sf_dir):
    """Totals of each regressor's deviations weighted by the fitted outcome."""
    master = inputs.stored_master(spark, sf_dir)
    parts = []
    for name, design in (("Preference", sample.PREFERENCE_WITHIN), ("Realization", sample.REALIZATION_WITHIN)):
        table = suites.estimation_table(master, design)
        fit = fit_models(table, [suites.within_spec(design, "(1)")])[0]
        within = table.select([(F.col(v) - F.col(f"{v}_mean")).alias(v) for v in TIME_VARYING])
        fitted = reduce(lambda a, b: a + b, [
            F.col(t.removesuffix("_within")) * float(b) for t, b in zip(fit.terms, fit.beta)
        ])
        totals = within.agg(*[F.round(F.sum(fitted * F.col(v)), 4).alias(v) for v in TIME_VARYING])
        parts.append(totals.select(F.lit(name).alias("stage"), F.inline(F.array(*[
            F.struct(F.lit(v).alias("term"), F.col(v).alias("total")) for v in TIME_VARYING
        ]))))
    return parts[0].unionByName(parts[1])


@query("lpm_person_effects", f"""{_FE_SQL}
    SELECT 'plh0173' AS term, groups AS levels, n, round(beta_a, 6) AS estimate,
           round(sqrt(f * (n - 2.0) / (n - 2.0 - groups) * va) / det, 6) AS std_err FROM v
    UNION ALL SELECT 'plb0193_h', groups, n, round(beta_b, 6), round(sqrt(f * (n - 2.0) / (n - 2.0 - groups) * vb) / det, 6) FROM v""")
def lpm_person_effects(spark, sf_dir):
    """An effect for each person, eliminated: the within estimates, with errors that count the effects."""
    regressors = ("plh0173", "plb0193_h")
    fit = fit_absorbed(_within_table(spark, sf_dir, regressors), ModelSpec("", "LPM", "linear", WILLING, regressors), category="pid")
    rows = [(term, fit.levels, fit.n, b, se) for term, b, se, _, _ in fit.coefficients()]
    return rounded(spark.createDataFrame(rows, "term string, levels long, n long, estimate double, std_err double"), 6, "estimate", "std_err")


# -- binary models with a closed form ----------------------------------------------------

def _stage1(spark, sf_dir, *columns):
    rows = sample.analysis_sample(inputs.master(spark, sf_dir), sample.PREFERENCE)
    return stage(rows.select("pid", "syear", WILLING, *columns), "sample")


# one binary regressor: two cells with shares p0, p1
_CELLS_SQL = """
    WITH k AS (SELECT count(*) AS n, count(DISTINCT pid) AS groups, avg(plb0097) AS p,
                      count(*) FILTER (WHERE plb0193_h = 0) AS n0, count(*) FILTER (WHERE plb0193_h = 1) AS n1,
                      avg(plb0097) FILTER (WHERE plb0193_h = 0) AS p0,
                      avg(plb0097) FILTER (WHERE plb0193_h = 1) AS p1 FROM s1),
    c AS (SELECT *, n0 * p0 * (1 - p0) AS w0, n1 * p1 * (1 - p1) AS w1,
                 ln(p0 / (1 - p0)) AS b0, ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)) AS b1,
                 groups / (groups - 1.0) * (n - 1.0) / (n - 2.0) AS f FROM k),
    u AS (SELECT pid, coalesce(sum(plb0097 - p0) FILTER (WHERE plb0193_h = 0), 0) AS u0,
                 coalesce(sum(plb0097 - p1) FILTER (WHERE plb0193_h = 1), 0) AS u1 FROM s1, c GROUP BY pid),
    v AS (SELECT c.*, sum(u0 * u0) AS m0, sum(u0 * u1) AS m01, sum(u1 * u1) AS m1 FROM c, u GROUP BY ALL),
    -- the clustered covariance of logit p0 and logit p1, and from it of the effect
    s AS (SELECT *, f * m0 / (w0 * w0) AS v0, f * m01 / (w0 * w1) AS v01, f * m1 / (w1 * w1) AS v1,
                 (w0 + w1) / n AS d, w0 * (1 - 2 * p0) / n AS t0, w1 * (1 - 2 * p1) / n AS t1 FROM v)"""

_SATURATED = ModelSpec("(1)", "Logit", "logit", WILLING, ("plb0193_h",))


def _saturated(spark, sf_dir):
    return fit_models(_stage1(spark, sf_dir, "plb0193_h"), [_SATURATED])


@query("logit_saturated", f"""{_CELLS_SQL}
    SELECT 'Intercept' AS term, round(b0, 6) AS estimate FROM s UNION ALL SELECT 'plb0193_h', round(b1, 6) FROM s""")
def logit_saturated(spark, sf_dir):
    coefficients = report.coefficients(spark, "Preference", _saturated(spark, sf_dir))
    return rounded(coefficients.select("term", "estimate"), 6, "estimate")


@query("logit_saturated_clustered", f"""{_CELLS_SQL}
    SELECT 'Intercept' AS term, round(sqrt(v0), 6) AS std_err, round(b0 / sqrt(v0), 5) AS z FROM s
    UNION ALL SELECT 'plb0193_h', round(sqrt(v0 - 2 * v01 + v1), 6), round(b1 / sqrt(v0 - 2 * v01 + v1), 5) FROM s""")
def logit_saturated_clustered(spark, sf_dir):
    coefficients = report.coefficients(spark, "Preference", _saturated(spark, sf_dir))
    return coefficients.select(
        "term", F.round("std_err", 6).alias("std_err"), F.round("z", 5).alias("z")
    )


# the effect b1·d changes with logit p0 by -d + b1·t0 and with logit p1 by d + b1·t1
@query("logit_saturated_ame", f"""{_CELLS_SQL},
    e AS (SELECT *, b1 * t0 - d AS j0, b1 * t1 + d AS j1 FROM s)
    SELECT 'plb0193_h' AS term, round(b1 * d, 6) AS estimate,
           round(sqrt(j0 * j0 * v0 + 2 * j0 * j1 * v01 + j1 * j1 * v1), 6) AS std_err FROM e""")
def logit_saturated_ame(spark, sf_dir):
    effects = report.effects(spark, "Preference", _saturated(spark, sf_dir))
    return rounded(effects.select("term", "estimate", "std_err"), 6, "estimate", "std_err")


# a saturated probit has the cell shares as fitted values, hence the likelihood of the logit
@query("probit_saturated_fit", f"""{_CELLS_SQL},
    l AS (SELECT n, n * (p * ln(p) + (1 - p) * ln(1 - p)) AS null_ll,
                 n0 * (p0 * ln(p0) + (1 - p0) * ln(1 - p0)) + n1 * (p1 * ln(p1) + (1 - p1) * ln(1 - p1)) AS ll FROM c)
    SELECT m.model, n, round(ll, 6) AS log_lik, round(1 - ll / null_ll, 6) AS r2
    FROM l, (VALUES ('Logit'), ('Probit')) m(model)""")
def probit_saturated_fit(spark, sf_dir):
    fits = fit_models(_stage1(spark, sf_dir, "plb0193_h"), [
        _SATURATED, ModelSpec("(2)", "Probit", "probit", WILLING, ("plb0193_h",)),
    ])
    stats = report.model_stats(spark, "Preference", fits)
    return rounded(stats.select("model", "n", "log_lik", "r2"), 6, "log_lik", "r2")


# sector dummies alone: one cell per sector, the lowest is the reference
@query("logit_sector_cells", """
    WITH k AS (SELECT sector, count(*) AS n, avg(plb0097) AS p FROM s1 GROUP BY sector),
    t AS (SELECT sum(n) AS n, (SELECT count(DISTINCT pid) FROM s1) AS groups, count(*) AS cells, min(sector) AS ref
          FROM k),
    u AS (SELECT pid, s1.sector, sum(plb0097 - p) / any_value(n * p * (1 - p)) AS r
          FROM s1 JOIN k USING (sector) GROUP BY pid, s1.sector),
    r AS (SELECT pid, sum(r) AS r0 FROM u, t WHERE sector = ref GROUP BY pid),
    x AS (SELECT u.sector, sum(u.r * u.r) AS ss, sum(u.r * coalesce(r0, 0)) AS s0 FROM u LEFT JOIN r USING (pid)
          GROUP BY u.sector)
    SELECT 'sector_' || CAST(CAST(k.sector AS INT) AS VARCHAR) AS term,
      round(ln(k.p / (1 - k.p)) - ln(b.p / (1 - b.p)), 5) AS estimate,
      round(sqrt(groups / (groups - 1.0) * (t.n - 1.0) / (t.n - cells) * (x.ss - 2 * x.s0 + y.ss)), 5) AS std_err
    FROM t JOIN k ON k.sector <> t.ref JOIN k b ON b.sector = t.ref JOIN x ON x.sector = k.sector
    JOIN x y ON y.sector = t.ref""")
def logit_sector_cells(spark, sf_dir):
    spec = ModelSpec("(1)", "Logit", "logit", WILLING, (), sector=True)
    coefficients = report.coefficients(spark, "Preference", fit_models(_stage1(spark, sf_dir, "sector"), [spec]))
    return rounded(
        coefficients.filter("term <> 'Intercept'").select("term", "estimate", "std_err"), 5, "estimate", "std_err"
    )


@query("separation", """
    SELECT t.term, 1.0::DOUBLE AS weight, count(*) FILTER (WHERE age >= 45) AS decided, count(*) AS n
    FROM s1, (VALUES ('plh0173'), ('planted')) t(term) GROUP BY t.term""")
def separation(spark, sf_dir):
    """The sum of two regressors is the answer of everyone from 45 on and zero else; neither of them tells anything by itself."""
    rows = _stage1(spark, sf_dir, "plh0173", "age", "plb0193_h")
    answer = F.when(F.col("age") >= 45, 2 * F.col(WILLING) - 1).otherwise(0.0)
    found = find_separation(rows.withColumn("planted", answer - F.col("plh0173")),
                            ModelSpec("(1)", "Logit", "logit", WILLING, ("plh0173", "plb0193_h", "planted")))
    terms = [(t, round(w, 3), found.rows, found.n) for t, w in found.weights.items()]
    return spark.createDataFrame(terms, "term string, weight double, decided long, n long")


# a logit fits the totals of every regressor over the positive answers exactly
def _totals_sql(dummies):
    names = CONTROLS_SQL.split(", ")
    terms = [("Intercept", "1.0")] + [(c, c) for c in names]
    terms += [(f"sector_{i}", f"CAST(sector = {i} AS DOUBLE)") for i in range(2, 16)] if dummies else []
    return " UNION ALL ".join(
        f"SELECT '{term}' AS term, round(sum(plb0097 * {value}), 3) AS total FROM s1" for term, value in terms
    )


def _fitted_totals(spark, sf_dir, dummies):
    """Totals of each regressor weighted by the fitted probability."""
    table = _stage1(spark, sf_dir, *CONTROLS, "sector")
    spec = ModelSpec("(1)", "Logit", "logit", WILLING, CONTROLS, sector=dummies)
    fit = fit_models(table, [spec])[0]
    coded = table.withColumn("Intercept", F.lit(1.0))
    if dummies:
        coded = treatment_dummies(coded, "sector")
    eta = reduce(lambda a, b: a + b, [F.col(t) * float(b) for t, b in zip(fit.terms, fit.beta)])
    share = 1 / (1 + F.exp(-eta))
    totals = coded.agg(*[F.round(F.sum(share * F.col(t)), 3).alias(t) for t in fit.terms])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("term"), F.col(t).alias("total")) for t in fit.terms
    ])))


@query("logit_pooled_totals", _totals_sql(False))
def logit_pooled_totals(spark, sf_dir):
    return _fitted_totals(spark, sf_dir, False)


@query("logit_sector_fe_totals", _totals_sql(True))
def logit_sector_fe_totals(spark, sf_dir):
    return _fitted_totals(spark, sf_dir, True)


def _null_sql(name, source, outcome):
    return f"""SELECT '{name}' AS stage, count(*) AS n, round(count(*) * (avg({outcome}) * ln(avg({outcome}))
        + (1 - avg({outcome})) * ln(1 - avg({outcome}))), 6) AS null_log_lik FROM {source}"""


@query("null_loglik", " UNION ALL ".join([
    _null_sql("Preference", "s1", WILLING), _null_sql("Realization", "s2", ACTUAL),
    _null_sql("Realization, all eligible", "s2full", ACTUAL)]))
def null_loglik(spark, sf_dir):
    master = inputs.stored_master(spark, sf_dir)
    samples = [
        sample.analysis_sample(master, design).select(F.lit(name).alias("stage"), F.col(design.outcome).alias("y"))
        for name, design in (("Preference", sample.PREFERENCE), ("Realization", sample.REALIZATION),
                             ("Realization, all eligible", sample.REALIZATION_FULL))
    ]
    counts = reduce(lambda a, b: a.unionByName(b), samples).groupBy("stage").agg(F.count("*"), F.sum("y")).collect()
    rows = [(name, n, null_log_lik(n, ones)) for name, n, ones in counts]
    return rounded(
        spark.createDataFrame(rows, "stage string, n long, null_log_lik double"), 6, "null_log_lik"
    )


@query("stars", """
    SELECT stage, n, CASE WHEN p < 0.01 THEN '***' WHEN p < 0.05 THEN '**' WHEN p < 0.10 THEN '*' ELSE '' END AS stars
    FROM (SELECT CAST(o_orderpriority AS VARCHAR) AS stage, count(*) AS n,
                 count(*) FILTER (WHERE o_orderstatus = 'P') / (count(*) * 5.0) AS p FROM orders GROUP BY 1)""")
def stars(spark, sf_dir):
    """The marks as a column; ``ame_table`` checks them on the p-values of models."""
    by = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("stage")).agg(
        F.count("*").alias("n"), (F.count_if(F.col("o_orderstatus") == "P") / (F.count("*") * 5.0)).alias("p")
    )
    return by.select("stage", "n", C.stars(F.col("p")).alias("stars"))


# -- the published models -------------------------------------------------------------------
#
# Checked by fits written as SQL: Newton steps, sandwich, effects and tests, every cell.

S1 = fit_sql.binary_models("Preference", "s1", WILLING)
S2 = fit_sql.binary_models("Realization", "s2", ACTUAL)
S2FULL = fit_sql.binary_models("Realization", "s2full", ACTUAL, (WILLING,))
W1 = fit_sql.within_model("Preference", "w1", WILLING, "(1)")
W2 = fit_sql.within_model("Realization", "w2", ACTUAL, "(2)")
S2W = fit_sql.within_model("Realization", "s2", ACTUAL, "(7)")


def _tidy(df):
    return df.withColumns({
        "estimate": F.round("estimate", 6), "std_err": F.round("std_err", 6), "z": F.round("z", 4),
        "p_value": F.round("p_value", 5),
    })


def _one_model(number):
    """One column of the preference table, all coefficients."""
    def run(spark, sf_dir):
        specs = [s for s in suites.binary_specs(sample.PREFERENCE) if s.number == number]
        return _tidy(report.coefficients(
            spark, "Preference", suites.fit_design(inputs.master(spark, sf_dir), sample.PREFERENCE, specs)))

    return run


for _name, _model in zip(
    ("logit_pooled", "logit_sector_fe", "probit_pooled", "probit_sector_fe", "cre_probit", "cre_probit_sector_fe"), S1
):
    query(_name, fit_sql.coefficients(_model))(_one_model(_model.number))


def _absorbed(spark, sf_dir, number):
    """A model of the preference table with sector effects eliminated."""
    (spec,) = (s for s in suites.binary_specs(sample.PREFERENCE) if s.number == number)
    return fit_absorbed(_stage1(spark, sf_dir, *CONTROLS, "sector"), spec)


for _model in (S1[1], S1[3]):
    @query(f"{_model.label.lower()}_absorbed", fit_sql.coefficients(_model, CONTROLS_SQL.split(", ")))
    def absorbed(spark, sf_dir, number=_model.number):
        """Coefficients as of the model with a dummy for each sector."""
        return _tidy(report.coefficients(spark, "Preference", [_absorbed(spark, sf_dir, number)]))


@query("absorbed_effects", fit_sql.effects([S1[1], S1[3]]))
def absorbed_effects(spark, sf_dir):
    """Average marginal effects, which depend on the sectors' effects."""
    return _tidy(report.effects(spark, "Preference", [_absorbed(spark, sf_dir, m.number) for m in (S1[1], S1[3])]))


@query("ame_table", fit_sql.effects(S1))
def ame_table(spark, sf_dir):
    return _tidy(report.effects(spark, "Preference", suites.preference_models(inputs.master(spark, sf_dir))))


@query("mundlak_wald", fit_sql.wald(S1))
def mundlak_wald(spark, sf_dir):
    fits = suites.preference_models(inputs.master(spark, sf_dir))
    return report.model_stats(spark, "Preference", fits).select(
        "stage", "model_no", "model", "sector_fe", F.round("wald_chi2", 4).alias("wald_chi2"), "wald_df",
        F.round("wald_p", 6).alias("wald_p"),
    )


@query("specifications", "SELECT * FROM (VALUES " + ", ".join(
    f"('{m.stage}', '{m.number}', '{m.label}', '{'Yes' if m.sector else 'No'}', "
    f"{sum(t != 'Intercept' and not t.startswith('sector_') for t in m.terms)}, {any(t.endswith('_mean') for t in m.terms)}, "
    f"(SELECT count(*) FROM {source}))" for m, source in [*((m, "s1") for m in S1), *((m, "s2") for m in (*S2, S2W))]
) + ") t(stage, model_no, model, sector_fe, regressors, person_means, n)")
def specifications(spark, sf_dir):
    """What each column of the two tables stands for, with the size of its sample."""
    master = inputs.stored_master(spark, sf_dir)
    parts = []
    for name, design, more in (("Preference", sample.PREFERENCE, []),
                               ("Realization", sample.REALIZATION, [suites.within_spec(sample.REALIZATION, "(7)")])):
        n = sample.analysis_sample(master, design).agg(F.count("*")).scalar()
        parts.append(report.specifications(spark, name, suites.binary_specs(design) + more).select(
            "stage", "model_no", "model", "sector_fe", "regressors", "person_means", n.alias("n")))
    return parts[0].unionByName(parts[1])


@query("model_suite", fit_sql.table(S1))
def model_suite(spark, sf_dir):
    return report.comparison_table(spark, suites.preference_models(inputs.master(spark, sf_dir)))


@query("stage2_full_suite", fit_sql.table([*S2, S2W]))
def stage2_full_suite(spark, sf_dir):
    return report.comparison_table(spark, suites.realization_models(inputs.master(spark, sf_dir)))


@query("stage2_unrestricted_suite", fit_sql.table(S2FULL, (WILLING, *CONTROLS)))
def stage2_unrestricted_suite(spark, sf_dir):
    return report.comparison_table(spark, suites.realization_full_models(inputs.master(spark, sf_dir)), (WILLING, *CONTROLS))


@query("fe_comparison", fit_sql.effects([W1, W2], TIME_VARYING))
def fe_comparison(spark, sf_dir):
    parts = [
        report.effects(spark, name, fits, TIME_VARYING)
        for name, fits in suites.within_models(inputs.stored_master(spark, sf_dir)).items()
    ]
    return _tidy(parts[0].unionByName(parts[1]))


@query("fe_comparison_table", fit_sql.within_table([W1, W2]))
def fe_comparison_table(spark, sf_dir):
    fits = suites.within_models(inputs.stored_master(spark, sf_dir))
    return report.within_table(spark, {name: of_stage[0] for name, of_stage in fits.items()})


@query("ame_matrix", fit_sql.matrix([m for m in (*S1, *S2) if not m.sector]))
def ame_matrix(spark, sf_dir):
    master = inputs.stored_master(spark, sf_dir)
    matrix = report.effect_matrix(spark, {
        "Preference": suites.preference_models(master, False), "Realization": suites.realization_models(master, False)})
    sizes = [c for c in matrix.columns if c.endswith("_size")]
    return rounded(matrix, 6, *sizes, "scale_max")


@query("between_effects", fit_sql.between(S1[4]))
def between_effects(spark, sf_dir):
    specs = [s for s in suites.binary_specs(sample.PREFERENCE, False) if s.label == "CRE Probit"]
    fits = suites.fit_design(inputs.master(spark, sf_dir), sample.PREFERENCE, specs)
    return rounded(report.between_effects(report.coefficients(spark, "Preference", fits)), 6, "within", "difference", "between")
