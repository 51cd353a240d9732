"""Descriptive tables from mergeable states: one scan and one shuffle for all variables, years and samples.

A state is the number, mean and variance of the values of a variable in one year (and one category, for
categorical variables), for each sample side by side, with least and greatest value. States merge: totals
over years, shares of categories and tables of several samples are sums over a few rows a variable,
and no table is read again for them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.functions import columns as C
from panelweave.operators import describe
from panelweave.registry import Registry
from panelweave.session import stage


def moment_states(df: DataFrame, variables: Iterable[str], categorical: Iterable[str] = (),
                  samples: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows (variable, syear, category, sample, rows, n, mean, var, min, max), as a written table of few rows.

    ``samples``: conditions on the rows of ``df`` that tell who belongs to each (null: nobody); by default everyone is one sample
    named ``all``. Codes for missing answers are no values; ``rows`` counts those that hold no such code. ``category`` is the value
    itself, for categorical variables. One scan, one shuffle.
    """
    variables, categorical = list(variables), set(categorical)
    samples = dict(samples or {"all": F.lit(True)})
    clean = {v: C.without_codes(v).cast("double") for v in variables}
    names = list(samples)
    marked = df.select(
        "syear", *[F.coalesce(test, F.lit(False)).alias(f"_in {i}") for i, test in enumerate(samples.values())],
        *[clean[v].alias(f"_clean {v}") for v in variables], *[F.col(f"`{v}`").isNull().alias(f"_none {v}") for v in variables])
    cells = F.array(*[F.struct(
        F.lit(v).alias("variable"), F.col(f"`_clean {v}`").alias("value"),
        (F.col(f"`_none {v}`") | F.col(f"`_clean {v}`").isNotNull()).alias("whole"),
        (F.col(f"`_clean {v}`") if v in categorical else F.lit(None).cast("double")).alias("category")) for v in variables])
    long = marked.select("syear", *[f"`_in {i}`" for i in range(len(names))], F.inline(cells))

    def state(i: int) -> list[Column]:
        value = F.when(F.col(f"`_in {i}`"), F.col("value"))
        return [F.count_if(F.col(f"`_in {i}`") & F.col("whole")).alias(f"rows {i}"), F.count(value).alias(f"n {i}"), F.avg(value).alias(f"mean {i}"),
                F.var_pop(value).alias(f"var {i}"), F.min(value).alias(f"min {i}"), F.max(value).alias(f"max {i}")]

    wide = long.groupBy("variable", "syear", "category").agg(*[s for i in range(len(names)) for s in state(i)])
    parts = F.array(*[F.struct(F.lit(name).alias("sample"), *[F.col(f"`{f} {i}`").alias(f) for f in ("rows", "n", "mean", "var", "min", "max")])
                      for i, name in enumerate(names)])
    return stage(wide.select("variable", "syear", "category", F.inline(parts)), "states")


def merged(states: DataFrame, by: Iterable[str]) -> DataFrame:
    """States added up: (by, rows, n, mean, sd, min, max). Deviations are taken from the common mean, so digits are kept."""
    by = list(by)
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    known = states.withColumn("common", F.try_divide(F.sum(F.col("n") * F.coalesce("mean", F.lit(0.0))).over(group), F.sum("n").over(group)))
    apart = F.coalesce(F.col("n") * (F.col("var") + (F.col("mean") - F.col("common")) ** 2), F.lit(0.0))
    return known.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max("common").alias("mean"), F.sum(apart).alias("squares"),
        F.min("min").alias("min"), F.max("max").alias("max"),
    ).select(*by, "rows", "n", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("sd"), "min", "max")


def summary(states: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """As ``describe.summarise`` for each sample (and ``by``)."""
    return merged(states, ["sample", "variable", *by]).select("sample", "variable", *by, "n", "mean", "sd", "min", "max")


def counts_by_year(states: DataFrame) -> DataFrame:
    """As ``describe.count_by_year`` for each sample."""
    return merged(states.where("syear IS NOT NULL"), ["sample", "variable", "syear"]).where("rows > 0").select("sample", "variable", "syear", "n")


def distributions(states: DataFrame) -> DataFrame:
    """As ``describe.category_distribution`` for each sample, for the variables whose states hold categories."""
    counts = states.where("category IS NOT NULL AND n > 0").groupBy("sample", "variable", "category").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("sample", "variable")
    shares = counts.select("sample", "variable", "category", F.count("*").over(group).alias("k"), (F.col("n") / F.sum("n").over(group)).alias("share"))
    text = F.concat(F.col("category").cast("long").cast("string"), F.lit(":"), C.percent_text(F.col("share")))
    few = F.when(F.col("k") <= describe.FEW_CATEGORIES, F.struct("category", text.alias("text")))
    return shares.groupBy("sample", "variable").agg(F.max("k").alias("k"), F.array_sort(F.collect_list(few)).alias("parts")).select(
        "sample", "variable", F.when(F.col("k") <= describe.FEW_CATEGORIES, F.array_join(F.col("parts.text"), " / ")).otherwise("--").alias("distribution"))


def _cells(states: DataFrame) -> DataFrame:
    return summary(states).select("sample", "variable", "n", "mean", "sd").join(distributions(states), ["sample", "variable"], "left")


def descriptive_table(df: DataFrame, samples: Mapping[str, Column], registry: Registry) -> DataFrame:
    """As ``describe.descriptive_table``, for two samples of the rows of ``df`` that overlap or not, from one pass over it."""
    first, second = samples
    states = moment_states(df, describe._known(df, registry), describe._known(df, registry, "categorical"), samples)
    cells, rows = stage(_cells(states), "cells"), describe.variable_rows(df, registry)
    for suffix, name in (("_1", first), ("_2", second)):
        # a row a variable
        own = rows.join(F.broadcast(cells.where(F.col("sample") == name).drop("sample")), "variable", "left")
        texts = describe._shown(own, 2)
        rows = own.select(*rows.columns, F.coalesce("n", F.lit(0)).alias(f"n{suffix}"), texts["mean_text"].alias(f"mean{suffix}"),
                          texts["sd_text"].alias(f"sd{suffix}"))
    return rows.filter(F.greatest("n_1", "n_2") > 0).orderBy("panel_no", "variable_no")


def appendix_table(df: DataFrame, registry: Registry) -> DataFrame:
    """As ``describe.appendix_table``, from one pass over ``df``."""
    years, names = sorted(registry.study_years), describe._known(df, registry)
    states = moment_states(df, names, describe._known(df, registry, "categorical"))
    return describe.appendix_of(df, registry, years, counts_by_year(states).drop("sample"), _cells(states).drop("sample"))
