"""Descriptive statistics of panel variables.

Statistics of many variables come from one aggregation over the wide table; the
small result is then turned into one row per variable. Only counts of categories
make a row of each answer, and those are added up before they leave the task.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.functions import columns as C
from panelweave.registry import Registry
from panelweave.session import stage

FEW_CATEGORIES = 5


def _per_variable(df: DataFrame, variables: list[str], fields: dict[str, str], by: list[str]) -> DataFrame:
    """One row per variable (and group) with ``fields``: name → SQL aggregate of ``{v}`` or the cleaned ``{c}``."""
    names = {v: (C.quoted(v), C.quoted(f"_clean {v}")) for v in variables}
    cleaned = df.select("*", *[C.without_codes(v).alias(f"_clean {v}") for v in variables])
    aggregates = [
        F.expr(sql.format(v=raw, c=clean)).alias(f"{field} {v}")
        for v, (raw, clean) in names.items() for field, sql in fields.items()
    ]
    wide = (cleaned.groupBy(*by) if by else cleaned).agg(*aggregates)
    rows = ", ".join(
        f"named_struct('variable', '{v}', "
        + ", ".join(f"'{field}', {C.quoted(f'{field} {v}')}" for field in fields) + ")"
        for v in variables
    )
    return wide.selectExpr(*by, f"inline(array({rows}))")


def summarise(df: DataFrame, variables: Iterable[str]) -> DataFrame:
    """Valid n, mean, sample sd, min and max per variable."""
    fields = {
        "n": "count({c})", "mean": "avg({c})", "sd": "stddev_samp({c})", "min": "min({c})", "max": "max({c})",
    }
    return _per_variable(df, list(variables), fields, [])


def count_by_year(df: DataFrame, variables: Iterable[str]) -> DataFrame:
    """Valid n per variable and year; a year whose rows are all empty stays with n = 0."""
    fields = {"n": "count({c})", "_rows": "count_if({v} IS NULL OR {c} IS NOT NULL)"}
    known = df.filter(F.col("syear").isNotNull())
    return _per_variable(known, list(variables), fields, ["syear"]).filter("_rows > 0").drop("_rows")


def category_counts(df: DataFrame, variables: Iterable[str]) -> DataFrame:
    """Valid n per variable and value, counted before the shuffle."""
    cleaned = df.select(*[C.without_codes(v).alias(v) for v in variables])
    pairs = ", ".join(f"named_struct('variable', '{v}', 'value', {C.quoted(v)})" for v in cleaned.columns)
    long = cleaned.selectExpr(f"inline(array({pairs}))").filter("value IS NOT NULL")
    return long.groupBy("variable", "value").agg(F.count("*").alias("n"))


def category_distribution(df: DataFrame, variables: Iterable[str]) -> DataFrame:
    """Distribution text per variable, ``--`` for more than five values.

    Lists are built only after the number of values is known to be small.
    """
    counts = category_counts(df, variables)
    # one row per variable: as small as the list of variables
    totals = counts.groupBy("variable").agg(F.count("*").alias("_k"), F.sum("n").alias("_total"))
    text = F.concat(
        F.col("value").cast("long").cast("string"), F.lit(":"), C.percent_text(F.col("n") / F.col("_total"))
    )
    few = (
        counts.join(F.broadcast(totals.filter(F.col("_k") <= FEW_CATEGORIES)), "variable")
        .groupBy("variable")
        .agg(F.array_sort(F.collect_list(F.struct("value", text.alias("text")))).alias("parts"))
        .select("variable", F.array_join(F.col("parts.text"), " / ").alias("distribution"))
    )
    many = totals.filter(F.col("_k") > FEW_CATEGORIES).select(
        "variable", F.lit("--").alias("distribution")
    )
    return few.unionByName(many)


def sample_n(summary: DataFrame) -> DataFrame:
    """Largest valid n of any variable: the size of the sample."""
    return summary.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"))


def variable_rows(df: DataFrame, registry: Registry) -> DataFrame:
    """Registry variables as a table, in report order."""
    harmonised = {h.name for h in registry.harmonised}
    rows = [
        (i, label, j, v.name.lower(), v.label, v.scale, v.kind, v.name in harmonised, bool(v.note))
        for i, (panel, label) in enumerate(registry.panels)
        for j, v in enumerate(registry.variables.get(panel, ()))
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "panel_no int, panel string, variable_no int, variable string, label string, scale string, "
        "kind string, harmonised boolean, has_note boolean",
    )


def _known(df: DataFrame, registry: Registry, kind: str | None = None) -> list[str]:
    names = [v.name.lower() for v in registry.all_variables() if kind is None or v.kind == kind]
    return [n for n in names if n in df.columns]


def _cells(df: DataFrame, registry: Registry) -> DataFrame:
    """n, mean, sd and distribution of every registry variable of a sample."""
    stats = summarise(df, _known(df, registry)).select("variable", "n", "mean", "sd")
    shares = category_distribution(df, _known(df, registry, "categorical"))
    return stats.join(F.broadcast(shares), "variable", "left")


def _shown(cells: DataFrame, digits: int) -> dict[str, Column]:
    """Mean and sd cell texts; ids show none, categories show their distribution."""
    none = F.lit("--")
    empty = F.coalesce(F.col("n"), F.lit(0)) == 0
    mean = (
        F.when(empty | (F.col("kind") == "id"), none)
        .when(F.col("kind") == "categorical", F.coalesce("distribution", none))
        .otherwise(C.fixed(F.col("mean"), digits))
    )
    sd = F.when(empty | (F.col("kind") != "continuous"), none).otherwise(
        F.coalesce(C.fixed(F.col("sd"), digits), none)
    )
    return {"mean_text": mean, "sd_text": sd}


def descriptive_table(first: DataFrame, second: DataFrame, registry: Registry) -> DataFrame:
    """Registry variables by two samples: mean and sd, or the distribution of categories.

    Variables without a valid value in either sample are left out. The registry
    and the per-variable results are a few rows each.
    """
    rows = variable_rows(first, registry)
    for suffix, sample in (("_1", first), ("_2", second)):
        cells = rows.join(F.broadcast(_cells(sample, registry)), "variable", "left")
        texts = _shown(cells, 2)
        rows = cells.select(
            *rows.columns, F.coalesce("n", F.lit(0)).alias(f"n{suffix}"),
            texts["mean_text"].alias(f"mean{suffix}"), texts["sd_text"].alias(f"sd{suffix}"),
        )
    sizes = F.greatest("n_1", "n_2")
    return rows.filter(sizes > 0).orderBy("panel_no", "variable_no")


def appendix_table(df: DataFrame, registry: Registry) -> DataFrame:
    """Valid n per variable and study year with mean and sd, and a last row of the largest n."""
    years = sorted(registry.study_years)
    return appendix_of(df, registry, years, count_by_year(df, _known(df, registry)), _cells(df, registry))


def appendix_of(df: DataFrame, registry: Registry, years: list[int], counts: DataFrame, cells: DataFrame) -> DataFrame:
    """The table from valid n by variable and year, and the cells of variables."""
    by_year = (
        counts.groupBy("variable").pivot("syear", list(years)).agg(F.sum("n"))
        .select("variable", *[F.coalesce(F.col(str(y)), F.lit(0)).alias(f"n_{y}") for y in years])
    )
    rows = variable_rows(df, registry).join(F.broadcast(cells.filter("n > 0")), "variable")
    rows = rows.join(F.broadcast(by_year), "variable")
    rows = rows.withColumns(_shown(rows, 3))
    columns = ["panel_no", "variable_no", "variable", *[f"n_{y}" for y in years], "n", "mean_text", "sd_text"]
    largest = rows.agg(*[F.max(c).alias(c) for c in columns[3:-2]])
    last = largest.select(
        F.lit(len(registry.panels)).alias("panel_no"), F.lit(0).alias("variable_no"), F.lit("N").alias("variable"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in columns[3:-2]],
        F.lit("--").alias("mean_text"), F.lit("--").alias("sd_text"),
    )
    return rows.select(columns).unionByName(last).orderBy("panel_no", "variable_no")


# -- one variable ---------------------------------------------------------------------------
#
# Survey answers repeat, so a column is first reduced to its distinct values and
# their counts. The counts are written once; every statistic is taken from them.

def value_counts(df: DataFrame, variable: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per distinct cleaned value (null included) and group, as a written table."""
    values = df.select(*by, C.without_codes(variable).alias("value"))
    return stage(values.groupBy(*by, "value").agg(F.count("*").alias("n")), "value-counts")


def _valid(counts: DataFrame) -> DataFrame:
    return counts.filter("value IS NOT NULL").groupBy("value").agg(F.sum("n").alias("n"))


def _center(counts: DataFrame):
    """Mean of all valid values; sums around it keep their digits."""
    known = counts.filter("value IS NOT NULL")
    mean = F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n"))
    return known.agg(F.coalesce(mean, F.lit(0.0))).scalar()


def moments(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Valid n, mean, sample sd, min and max from value counts."""
    center = _center(counts)
    shift = F.col("value") - center
    known = counts.filter("value IS NOT NULL")
    sums = known.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum(shift * F.col("n")).alias("s1"),
        F.sum(shift * shift * F.col("n")).alias("s2"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    spread = F.greatest(F.col("s2") - F.col("s1") * F.col("s1") / F.col("n"), F.lit(0.0))
    return sums.select(
        *by, "n",
        F.when(F.col("n") > 0, center + F.try_divide("s1", "n")).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.try_divide(spread, F.col("n") - 1))).alias("sd"),
        "min", "max",
    )


@dataclass(frozen=True)
class Range:
    """Values above ``low`` up to ``high``, with the rows before them and the ranks looked for in them."""

    low: float | None
    high: float | None
    before: int
    distinct: int
    ranks: tuple[int, ...]

    def holds(self) -> Column:
        above = F.lit(True) if self.low is None else F.col("value") > self.low
        return above if self.high is None else above & (F.col("value") <= self.high)


def _refined(counts: DataFrame, whole: Range, pieces: int) -> list[Range]:
    """Those parts of a range that hold a rank; at most ``pieces`` rows reach the driver."""
    inside = counts.filter(whole.holds())
    marks = np.arange(1, pieces) / pieces
    cuts = np.unique(inside.agg(F.percentile_approx("value", F.lit(marks), F.lit(10 * pieces))).first()[0]).tolist()
    part = F.size(F.filter(F.lit(cuts), lambda cut: cut < F.col("value")))
    parts, before = [], whole.before
    for at, n, distinct in sorted(inside.groupBy(part).agg(F.sum("n"), F.count("*")).collect()):
        ranks = tuple(r for r in whole.ranks if before < r <= before + n)
        if ranks:
            low, high = cuts[at - 1] if at else whole.low, cuts[at] if at < len(cuts) else whole.high
            parts.append(Range(low, high, before, distinct, ranks))
        before += n
    return parts


def quantiles_of_counts(
    counts: DataFrame, at: tuple[float, ...], most: int = 100_000, pieces: int = 256
) -> DataFrame:
    """Exact quantiles with linear interpolation from (value, n).

    A range of values that holds a wanted rank is cut into pieces until it has at
    most ``most`` distinct values, so neither a task nor the driver ever gets more,
    however many values there are. Running counts are taken inside those ranges alone.
    """
    spark = counts.sparkSession
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if not total:
        return spark.createDataFrame([(float(q), None) for q in at], "q double, value double")
    # 1-based ranks below and above each quantile
    wanted = []
    for q in at:
        place = q * (total - 1)
        low = int(place)
        wanted.append((float(q), low + 1, min(low + 2, total), place - low))
    ranges = [Range(None, None, 0, distinct, tuple(sorted({r for _, low, high, _ in wanted for r in (low, high)})))]
    while large := [r for r in ranges if r.distinct > most]:
        ranges = [r for r in ranges if r.distinct <= most]
        ranges += [part for r in large for part in _refined(counts, r, pieces)]

    label = F.coalesce(*[F.when(r.holds(), i) for i, r in enumerate(ranges)])
    before = F.get(F.array(*[F.lit(r.before) for r in ranges]), F.col("range"))
    running = F.sum("n").over(Window.partitionBy("range").orderBy("value"))
    inside = counts.withColumn("range", label).filter("range IS NOT NULL").withColumn("last", before + running)
    ranks = sorted({rank for r in ranges for rank in r.ranks})
    found = inside.select(
        "value",
        F.explode(F.filter(
            F.array(*map(F.lit, ranks)),
            lambda r: (r > F.col("last") - F.col("n")) & (r <= F.col("last")),
        )).alias("rank"),
    )
    plan = spark.createDataFrame(wanted, "q double, low long, high long, weight double")
    lows = found.select(F.col("rank").alias("low"), F.col("value").alias("_low"))
    highs = found.select(F.col("rank").alias("high"), F.col("value").alias("_high"))
    # one row per wanted rank
    return plan.join(F.broadcast(lows), "low").join(F.broadcast(highs), "high").select(
        "q", (F.col("_low") + F.col("weight") * (F.col("_high") - F.col("_low"))).alias("value")
    )


def quantiles(df: DataFrame, variable: str, at: tuple[float, ...] = (0.25, 0.5, 0.75), most: int = 100_000) -> DataFrame:
    """Exact quantiles of one variable; no task ever holds the whole column."""
    return quantiles_of_counts(_valid(value_counts(df, variable)), at, most)


def five_numbers_of_counts(counts: DataFrame) -> DataFrame:
    order = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    valid = _valid(counts)
    summary = moments(valid).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("statistic"), F.col(c).cast("double").alias("value"))
        for name, c in (("count", "n"), ("mean", "mean"), ("std", "sd"), ("min", "min"), ("max", "max"))
    ])))
    quartiles = quantiles_of_counts(valid, (0.25, 0.5, 0.75)).select(
        F.concat((F.col("q") * 100).cast("int").cast("string"), F.lit("%")).alias("statistic"), "value"
    )
    position = F.array_position(F.array(*map(F.lit, order)), F.col("statistic")).cast("int").alias("position")
    return summary.unionByName(quartiles).select(position, "statistic", "value")


def five_numbers(df: DataFrame, variable: str) -> DataFrame:
    """Statistics of one variable, one row per statistic in the usual order."""
    return five_numbers_of_counts(value_counts(df, variable))


def profile(df: DataFrame, variable: str) -> dict[str, DataFrame]:
    """Missing answers, statistics and years of one variable from one pass over the table."""
    counts = value_counts(df, variable, ("syear",))
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("valid"),
    )
    years = moments(counts.filter(F.col("syear").isNotNull()), ("syear",))
    return {
        "missing": _missing(totals),
        "statistics": five_numbers_of_counts(counts),
        "by_year": years.select("syear", "n", "mean", F.col("sd").alias("std")),
    }


def stats_by_year(df: DataFrame, variable: str) -> DataFrame:
    """Valid n, mean and sample sd of one variable per year, years without a valid value left out."""
    return (
        df.filter(F.col("syear").isNotNull())
        .select("syear", C.without_codes(variable).alias("value")).filter("value IS NOT NULL")
        .groupBy("syear")
        .agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    )


def _missing(totals: DataFrame) -> DataFrame:
    missing = F.col("total") - F.col("valid")
    return totals.select(
        "total", "valid", missing.alias("missing"),
        F.try_divide(missing * 100.0, F.col("total")).alias("missing_pct"),
    )


def missing_rate(df: DataFrame, variable: str) -> DataFrame:
    """Rows, valid and missing answers, missing in percent (null for an empty table)."""
    return _missing(
        df.agg(F.count("*").alias("total"), F.count(C.without_codes(variable)).alias("valid"))
    )


def distinct_people(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("observations"), F.countDistinct("pid").alias("individuals"))


def category_coverage(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(column).alias("non_null"), F.countDistinct(column).alias("categories"))


def period_label(df: DataFrame, dash: str = "–") -> DataFrame:
    """First and last year as one text."""
    ends = [F.min("syear").cast("string"), F.max("syear").cast("string")]
    return df.agg(F.concat_ws(dash, *ends).alias("period"))


def distinct_years(df: DataFrame) -> DataFrame:
    return df.select("syear").dropna().distinct().orderBy("syear")
