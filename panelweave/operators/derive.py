"""Derived columns of the master panel and of the model frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.fixed_values import PARTNER_CODES
from panelweave.functions import columns as C
from panelweave.registry import Sector


def add_space_per_head(df: DataFrame) -> DataFrame:
    return df.withColumn("sqm_per_head", C.ratio(F.col("hlf0019_h"), F.col("d11106")))


def add_age(df: DataFrame) -> DataFrame:
    return df.withColumn("age", F.col("syear") - F.col("gebjahr")).drop("gebjahr")


def add_sector(df: DataFrame, sectors: Iterable[Sector]) -> DataFrame:
    """Sector from either industry classification, revision 1 first; the codes are dropped."""
    sectors = list(sectors)
    codes = {"pgnace": [(s.id, s.rev1) for s in sectors], "pgnace2": [(s.id, s.rev2) for s in sectors]}
    present = [c for c in codes if c in df.columns]
    found = [C.category_of(c, codes[c]) for c in present]
    return df.withColumn("sector", F.coalesce(*found, F.lit(None)).cast("int")).drop(*present)


def recode_columns(df: DataFrame, recodes: Mapping[str, Mapping]) -> DataFrame:
    """Recode several columns at once; columns the table lacks are skipped."""
    present = {c: C.recode(F.col(c), m) for c, m in recodes.items() if c in df.columns}
    return df.withColumns(present) if present else df


def migration_flags(df: DataFrame) -> DataFrame:
    """Two migration-background flags with missing counted as 0, in place of the source column."""
    code = F.col("migback")
    return df.withColumns({
        "migback_direct": C.flag(code == 2, null_as_zero=True).cast("byte"),
        "migback_indirect": C.flag(code == 3, null_as_zero=True).cast("byte"),
    }).drop("migback")


def model_columns(df: DataFrame) -> DataFrame:
    """Regressors computed from master columns; missing stays missing."""
    return df.withColumns({
        "work_hrs_100": F.col("e11101") / 100,
        "has_children": C.flag(F.col("d11107") > 0),
        "log_income": C.log_floored(F.col("i11102")),
        "migback_direct": C.flag(F.col("migback") == 2),
        "migback_indirect": C.flag(F.col("migback") == 3),
        "has_partner": C.flag(F.col("partner").isin(*PARTNER_CODES)),
        "sector": F.col("sector").cast("double"),
    })


def category_levels(df: DataFrame, column: str) -> list[float]:
    """Distinct non-null levels in ascending order; each becomes a column, so they are as few as those."""
    return sorted(r[0] for r in df.select(column).dropna().distinct().collect())


def treatment_dummies(df: DataFrame, column: str, levels: Iterable[float] | None = None) -> DataFrame:
    """One 0/1 column per level but the lowest, which is the reference."""
    levels = sorted(levels) if levels is not None else category_levels(df, column)
    return df.withColumns({
        f"{column}_{int(level)}": C.flag(F.col(column) == level) for level in levels[1:]
    })
