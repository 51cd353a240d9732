"""Row filters, analysis samples and their audit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.fixed_values import ACTUAL, CONTROLS, TIME_VARYING, WILLING
from panelweave.operators.derive import model_columns


def full_time(df: DataFrame) -> DataFrame:
    return df.filter(F.col("pgemplst") == 1)


def in_years(df: DataFrame, years: Iterable[int]) -> DataFrame:
    return df.filter(F.col("syear").isin(*years))


def valid(column: str, values: Iterable[float] = (0, 1)) -> Column:
    return F.col(column).isin(*values)


def complete_cases(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows without a missing value in ``columns`` (all columns by default); every column is kept."""
    return df.na.drop(subset=list(columns) if columns is not None else None)


@dataclass(frozen=True)
class SampleDesign:
    """Outcome, eligibility and the columns that must be complete."""

    outcome: str
    eligible: Mapping[str, tuple]
    regressors: tuple[str, ...]
    sector: bool = True

    def required(self) -> list[str]:
        return ["pid", "syear", self.outcome, *self.regressors, *(["sector"] if self.sector else [])]

    def condition(self) -> Column:
        tests = [valid(column, values) for column, values in self.eligible.items()]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out


PREFERENCE = SampleDesign(WILLING, {WILLING: (0, 1)}, CONTROLS)
REALIZATION = SampleDesign(ACTUAL, {WILLING: (1,), ACTUAL: (0, 1)}, CONTROLS)
REALIZATION_FULL = SampleDesign(ACTUAL, {WILLING: (0, 1), ACTUAL: (0, 1)}, (WILLING, *CONTROLS))
PREFERENCE_WITHIN = SampleDesign(WILLING, {WILLING: (0, 1)}, TIME_VARYING, sector=False)
REALIZATION_WITHIN = SampleDesign(ACTUAL, {WILLING: (1,), ACTUAL: (0, 1)}, TIME_VARYING, sector=False)


def analysis_sample(master: DataFrame, design: SampleDesign) -> DataFrame:
    """Eligible, complete rows of the master panel with model columns; all columns are kept."""
    return complete_cases(model_columns(master).filter(design.condition()), design.required())


def in_sample(design: SampleDesign) -> Column:
    """Whether a row with model columns belongs to the analysis sample; null counts as no."""
    out = design.condition()
    for column in design.required():
        out = out & F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    return F.coalesce(out, F.lit(False))


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each filter and rows it removed, all from one pass.

    The steps apply one after the other; a missing condition counts as not met.
    """
    counts, met = [F.count("*").alias("n0")], None
    for i, test in enumerate(steps.values(), 1):
        met = test if met is None else met & test
        counts.append(F.count_if(met).alias(f"n{i}"))
    totals = df.agg(*counts)
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"n{max(i - 1, 0)}").alias("rows_before"),
            (F.col(f"n{max(i - 1, 0)}") - F.col(f"n{i}")).alias("rows_removed"),
            F.col(f"n{i}").alias("rows_after"),
        )
        for i, name in enumerate(["all rows", *steps])
    ])
    return totals.select(F.inline(rows))
