"""The model suites: which models are fitted on which sample."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelweave.estimation.fit import Fit, ModelSpec, fit_models
from panelweave.fixed_values import TIME_VARYING
from panelweave.operators.panel import add_group_means
from panelweave.operators.sample import (
    PREFERENCE,
    PREFERENCE_WITHIN,
    REALIZATION,
    REALIZATION_FULL,
    REALIZATION_WITHIN,
    SampleDesign,
    analysis_sample,
)
from panelweave.session import stage, staged

MEANS = tuple(f"{v}_mean" for v in TIME_VARYING)
WITHIN = tuple(f"{v}_within" for v in TIME_VARYING)

# Estimators and sector effects of the six published columns.
GRID = (
    ("(1)", "Logit", "logit", False, False),
    ("(2)", "Logit", "logit", False, True),
    ("(3)", "Probit", "probit", False, False),
    ("(4)", "Probit", "probit", False, True),
    ("(5)", "CRE Probit", "probit", True, False),
    ("(6)", "CRE Probit", "probit", True, True),
)


def binary_specs(design: SampleDesign, sector: bool | None = None) -> list[ModelSpec]:
    """The six binary models of a stage, or only those with or without sector effects."""
    return [
        ModelSpec(number, label, link, design.outcome,
                  design.regressors + (MEANS if means else ()), sector=with_sector)
        for number, label, link, means, with_sector in GRID
        if sector is None or with_sector == sector
    ]


def within_spec(design: SampleDesign, number: str) -> ModelSpec:
    """Linear model in deviations from person means: no constant, no time-constant regressors."""
    return ModelSpec(number, "FE LPM", "linear", f"{design.outcome}_within", WITHIN, intercept=False)


def estimation_table(master: DataFrame, design: SampleDesign) -> DataFrame:
    """The sample with person means, written once for all passes.

    Means are taken over the estimation sample, after every filter. The narrow
    sample is written before them: means, their counts and the join all read it,
    and none of them should rebuild the panel.
    """
    return stage(_with_means(stage(_sample(master, design), "sample"), design), "design")


def _sample(master: DataFrame, design: SampleDesign) -> DataFrame:
    return analysis_sample(master, design).select(design.required())


def _with_means(sample: DataFrame, design: SampleDesign) -> DataFrame:
    return add_group_means(sample, [design.outcome, *TIME_VARYING])


def fit_design(master: DataFrame, design: SampleDesign, specs: list[ModelSpec]) -> list[Fit]:
    """Fit on the sample of a design; what is written for the fits is deleted after them."""
    with staged(_sample(master, design), "sample") as sample:
        return fit_models(_with_means(sample, design), specs)


def rename_within(fits: list[Fit]) -> list[Fit]:
    """Deviations are reported under the name of their regressor."""
    for f in fits:
        f.terms = [t.removesuffix("_within") for t in f.terms]
    return fits


def preference_models(master: DataFrame, sector: bool | None = None) -> list[Fit]:
    return fit_design(master, PREFERENCE, binary_specs(PREFERENCE, sector))


def realization_models(master: DataFrame, sector: bool | None = None) -> list[Fit]:
    specs = binary_specs(REALIZATION, sector)
    if sector is None:
        specs.append(within_spec(REALIZATION, "(7)"))
    return rename_within(fit_design(master, REALIZATION, specs))


def realization_full_models(master: DataFrame) -> list[Fit]:
    """Realization on everyone eligible, the stated preference as a regressor without a mean."""
    return fit_design(master, REALIZATION_FULL, binary_specs(REALIZATION_FULL))


def within_models(master: DataFrame) -> dict[str, list[Fit]]:
    """Within estimates of both stages on rows complete in the time-varying regressors."""
    return {
        name: rename_within(fit_design(master, design, [within_spec(design, number)]))
        for name, design, number in (
            ("Preference", PREFERENCE_WITHIN, "(1)"), ("Realization", REALIZATION_WITHIN, "(2)"),
        )
    }
