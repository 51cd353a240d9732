"""Searches in the codebook and profiles of single variables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import describe

WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def search_variables(
    codebook: DataFrame, query: str, source: str | None = None, match_any: bool = False
) -> DataFrame:
    """Variables whose name or English label contains all (or any) of the words, in any case.

    An empty query matches everything under all, nothing under any.
    """
    terms = query.lower().split()
    text = F.lower(F.concat_ws(" ", "variable", "label"))
    tests = [F.contains(text, F.lit(t)) for t in terms]
    met = reduce(lambda a, b: (a | b) if match_any else (a & b), tests) if tests else F.lit(not match_any)
    found = codebook.filter(met) if source is None else codebook.filter((F.col("source") == source) & met)
    return found.select("dataset", "variable", "label", "label_de")


def _of_variable(values: DataFrame, variable: str, source: str | None) -> DataFrame:
    found = values.filter(F.lower("variable") == variable.lower())
    return found if source is None else found.filter(F.col("source") == source)


def _any_label():
    """English label, German where it is empty."""
    return F.when(F.col("label") != "", F.col("label")).otherwise(F.col("label_de"))


def shown_labels(values: DataFrame) -> DataFrame:
    """The label to show next to the English and German ones."""
    return values.withColumn("shown", _any_label())


def value_labels(values: DataFrame, variable: str, source: str | None = None) -> DataFrame:
    """Coded values of one variable with both labels and the one to show."""
    return shown_labels(_of_variable(values, variable, source)).select(
        "dataset", "value", "label", "label_de", "shown"
    )


def label_map(values: DataFrame, by: list[str]) -> DataFrame:
    """Label per integer code and ``by`` columns; other codes and empty labels are skipped, the last row wins."""
    code = F.when(F.col("value").rlike(WHOLE_NUMBER), F.trim("value").try_cast("long"))
    labelled = values.select(*by, code.alias("code"), _any_label().alias("_label"), "position")
    return (
        labelled.filter("code IS NOT NULL AND _label <> ''")
        .groupBy(*by, "code").agg(F.max_by("_label", "position").alias("label"))
    )


def value_label_map(values: DataFrame, variable: str, source: str) -> DataFrame:
    return label_map(_of_variable(values, variable, source), [])


def scale_bounds(labels: DataFrame, by: list[str]) -> DataFrame:
    """Lowest and highest non-negative labelled code with their labels."""
    positive = labels.filter(F.col("code") >= 0)
    return positive.groupBy(*by).agg(
        F.min("code").alias("low"), F.min_by("label", "code").alias("low_label"),
        F.max("code").alias("high"), F.max_by("label", "code").alias("high_label"),
    )


def first_dataset(codebook: DataFrame, preferred: Iterable[str], by: list[str]) -> DataFrame:
    """First dataset of each variable: preferred sources before others, then source and row order.

    The preference looks at the source file, the answer is the dataset it names.
    """
    later = ~F.col("source").isin(*preferred)
    place = F.struct(later.alias("later"), F.col("source"), F.col("position"))
    return codebook.groupBy(*by).agg(F.min_by("dataset", place).alias("dataset"))


def find_dataset(codebook: DataFrame, variable: str, preferred: Iterable[str] = ()) -> str | None:
    """Dataset name for one variable, None when no codebook has it."""
    found = codebook.filter(F.lower("variable") == variable.lower())
    row = first_dataset(found, preferred, []).first()
    return row["dataset"] if row else None


def profile(data: DataFrame, variable: str, labels: DataFrame | None = None) -> dict[str, DataFrame]:
    """Everything reported on one variable: scale, missing answers, statistics, years."""
    parts = describe.profile(data, variable)
    if labels is not None:
        parts["scale"] = scale_bounds(labels, [])
    return parts
