"""Model results as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.estimation.fit import Fit, ModelSpec
from panelweave.fixed_values import CONTROLS, TERM_GROUPS, TERM_LABELS, TIME_VARYING
from panelweave.functions import columns as C

TIDY = (
    "stage string, model_no string, model string, sector_fe string, term_no int, term string, "
    "estimate double, std_err double, z double, p_value double"
)
STATS = (
    "stage string, model_no string, model string, sector_fe string, n long, clusters long, log_lik double, "
    "r2 double, wald_chi2 double, wald_df int, wald_p double, steps int, condition double"
)


def _head(stage: str, fit: Fit) -> tuple:
    return stage, fit.spec.number, fit.spec.label, "Yes" if fit.spec.sector else "No"


def coefficients(spark: SparkSession, stage: str, fits: list[Fit]) -> DataFrame:
    """All coefficients, dummies and person means included."""
    rows = [(*_head(stage, f), i, *row) for f in fits for i, row in enumerate(f.coefficients())]
    return spark.createDataFrame(rows, TIDY).withColumn("stars", C.stars(F.col("p_value")))


def effects(spark: SparkSession, stage: str, fits: list[Fit], terms=CONTROLS) -> DataFrame:
    """Average marginal effects of the controls in their fixed order."""
    order = {t: i for i, t in enumerate(terms)}
    rows = [(*_head(stage, f), order[row[0]], *row) for f in fits for row in f.effects(terms)]
    return spark.createDataFrame(rows, TIDY).withColumn("stars", C.stars(F.col("p_value")))


def model_stats(spark: SparkSession, stage: str, fits: list[Fit]) -> DataFrame:
    """Size, fit and joint test of the person means per model; no log-likelihood for linear models."""
    rows = []
    for f in fits:
        chi2, df, p = f.wald_of_means() or (None, None, None)
        log_lik = None if f.spec.link == "linear" else f.log_lik
        rows.append((*_head(stage, f), f.n, f.clusters, log_lik, f.r2, chi2, df, p, f.steps, f.condition))
    return spark.createDataFrame(rows, STATS)


def specifications(spark: SparkSession, stage: str, specs: list[ModelSpec]) -> DataFrame:
    """What each model column stands for."""
    rows = [
        (stage, s.number, s.label, "Yes" if s.sector else "No", s.link, s.outcome, len(s.regressors),
         any(r.endswith("_mean") for r in s.regressors))
        for s in specs
    ]
    return spark.createDataFrame(
        rows, "stage string, model_no string, model string, sector_fe string, link string, outcome string, "
        "regressors int, person_means boolean",
    )


def marks(p: float) -> str:
    """Significance marks at 1, 5 and 10 percent."""
    return "***" if p < 0.01 else "**" if p < 0.05 else "*" if p < 0.10 else ""


def _cells(fit: Fit, terms, digits: int = 4) -> dict[tuple[str, int], str]:
    """Estimate with marks (line 0) and standard error (line 1) as text by term."""
    out = {}
    for term, estimate, error, _, p in fit.effects(terms):
        out[term, 0] = f"{estimate:.{digits}f}{marks(p)}"
        out[term, 1] = f"({error:.{digits}f})"
    return out


def comparison_table(spark: SparkSession, fits: list[Fit], terms=CONTROLS) -> DataFrame:
    """Published layout: terms by models as text, standard errors below, model rows at the end.

    The driver holds the fits already, so no job is needed to lay them out.
    """
    groups = [("WFH Preference", ("plb0097",)), *TERM_GROUPS]
    order = [(g, t, TERM_LABELS[t]) for g, members in groups for t in members if t in terms]
    cells = [_cells(f, terms) for f in fits]
    rows = [
        (2 * i + line, group, "" if line else label, *[c.get((term, line), "" if line else "---") for c in cells])
        for i, (group, term, label) in enumerate(order) for line in (0, 1)
    ]
    tests = [f.wald_of_means() for f in fits]
    facts = [
        ("Model", [f.spec.label for f in fits]),
        ("Sector FE", ["Yes" if f.spec.sector else "No" for f in fits]),
        ("N", [f"{f.n:,}" for f in fits]),
        ("R2 (McFadden / within)", [f"{f.r2:.4f}" for f in fits]),
        ("Log-likelihood", ["---" if f.spec.link == "linear" else f"{f.log_lik:.1f}" for f in fits]),
        ("Mundlak means (p)", ["---" if t is None else "< 0.001" if t[2] < 0.001 else f"{t[2]:.3f}" for t in tests]),
    ]
    rows += [(len(rows) + i, "", name, *texts) for i, (name, texts) in enumerate(facts)]
    models = ", ".join(f"`{f.spec.number}` string" for f in fits)
    return spark.createDataFrame(rows, f"row_no int, group string, label string, {models}")


def within_table(spark: SparkSession, fits: dict[str, Fit], terms=TIME_VARYING) -> DataFrame:
    """Within estimates of several stages side by side, with the number of rows and the within R² at the end."""
    cells = [_cells(f, terms) for f in fits.values()]
    rows = [
        (2 * i + line, "" if line else TERM_LABELS[term], *[c.get((term, line), "" if line else "---") for c in cells])
        for i, term in enumerate(terms) for line in (0, 1)
    ]
    rows.append((len(rows), "N", *[f"{f.n:,}" for f in fits.values()]))
    rows.append((len(rows), "Within R2", *[f"{f.r2:.4f}" for f in fits.values()]))
    stages = ", ".join(f"`{name}` string" for name in fits)
    return spark.createDataFrame(rows, f"row_no int, label string, {stages}")


def effect_matrix(spark: SparkSession, fits: dict[str, list[Fit]], terms=CONTROLS) -> DataFrame:
    """Absolute effects and annotated texts, terms by stage and model, models without sector effects.

    ``scale_max`` is the largest absolute effect of the whole matrix.
    """
    columns = {
        f"{stage} / {f.spec.label}": {term: (abs(b), f"{b:.3f}{marks(p)}") for term, b, _, _, p in f.effects(terms)}
        for stage, of_stage in fits.items() for f in of_stage
        if not f.spec.sector and f.spec.label in ("Logit", "Probit", "CRE Probit")
    }
    names = sorted(columns)
    top = max((size for cells in columns.values() for size, _ in cells.values()), default=None)
    rows = [
        (i, t, *[part for n in names for part in columns[n].get(t, (None, None))], TERM_LABELS.get(t, t), top)
        for i, t in enumerate(terms) if any(t in cells for cells in columns.values())
    ]
    pairs = "".join(f"`{n}_size` double, `{n}_text` string, " for n in names)
    return spark.createDataFrame(rows, f"term_no int, term string, {pairs}label string, scale_max double")


def between_effects(coefs: DataFrame) -> DataFrame:
    """Within effect, difference and between effect of each regressor with a person mean."""
    within = coefs.select("stage", "model_no", "term", F.col("estimate").alias("within"))
    means = coefs.filter(F.col("term").endswith("_mean")).select(
        "stage", "model_no", F.regexp_replace("term", "_mean$", "").alias("term"),
        F.col("estimate").alias("difference"),
    )
    return within.join(F.broadcast(means), ["stage", "model_no", "term"]).withColumn(
        "between", F.col("within") + F.col("difference")
    )
