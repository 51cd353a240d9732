"""Exact quantiles of many variables and groups from two scans.

The first scan makes a sketch of ranks for each variable and group. Its error is bounded, so for every wanted rank
it gives two values that the exact one lies between. The second scan counts what is below and between
brackets as a whole, and the values inside brackets one by one; running counts over those find the
rank. What is shuffled is sketches, counts and the small part of the values in brackets.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.functions import columns as C
from panelweave.session import stage, staged

#: A sketch is off by at most one rank in so many; a bracket reaches twice as far to either side.
ACCURACY = 2_000


def _long(df: DataFrame, variables: list[str], by: list[str]) -> DataFrame:
    """Rows (by, variable, value) without missing values and codes."""
    cleaned = df.select(*by, *[C.without_codes(v).cast("double").alias(f"_clean {v}") for v in variables])
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"`_clean {v}`").alias("value")) for v in variables])
    return cleaned.select(*by, F.inline(pairs)).where("value IS NOT NULL")


def _ranks(n: Column, q: float) -> Column:
    """Place of a quantile among n values, counted from 0; between two ranks if it is no whole number."""
    return F.lit(float(q)) * (n - 1)


def sketches(df: DataFrame, variables: list[str], at: tuple[float, ...], by: list[str], accuracy: int) -> DataFrame:
    """Rows (by, variable, n, brackets): between which values each quantile lies."""
    # in a small group a share of the ranks is less than a rank; the least reach of at least three is taken
    reaches = [2.0 / accuracy]
    while reaches[-1] < 1:
        reaches.append(4 * reaches[-1])
    marks = [m for q in at for r in reaches for m in (max(0.0, q - r), min(1.0, q + r))]
    found = _long(df, variables, by).groupBy(*by, "variable").agg(
        F.count("*").alias("n"), F.percentile_approx("value", F.array(*map(F.lit, marks)), F.lit(accuracy)).alias("cut"),
        F.min("value").alias("least"), F.max("value").alias("most"))

    def bracket(i: int) -> Column:
        low, high = F.col("least"), F.col("most")
        for j, r in reversed(list(enumerate(reaches))):
            place = 2 * (i * len(reaches) + j)
            enough = F.lit(r) * F.col("n") >= 3
            # the ends of a group are known exactly
            low = F.when(enough, F.col("least") if at[i] - r <= 0 else F.get("cut", F.lit(place))).otherwise(low)
            high = F.when(enough, F.col("most") if at[i] + r >= 1 else F.get("cut", F.lit(place + 1))).otherwise(high)
        return F.struct(low.alias("low"), high.alias("high"))

    return found.select(*by, "variable", "n", F.array(*map(bracket, range(len(at)))).alias("brackets"))


def quantiles_by(df: DataFrame, variables: Iterable[str], at: tuple[float, ...] = (0.25, 0.5, 0.75), by: Iterable[str] = (),
                 accuracy: int = ACCURACY) -> DataFrame:
    """Rows (by, variable, n, q, value): exact quantiles with linear interpolation, for each variable with a value in the group.

    Codes for missing answers do not count. A rank outside its bracket, which the bound of the sketch rules out, fails the job.
    Groups may be null.
    """
    variables, by = list(variables), list(by)
    if not variables or not at:
        return df.select(*by, F.lit("").alias("variable"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("q"), F.lit(0.0).alias("value")).limit(0)
    same = lambda a, b: _all(F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in [*by, "variable"])
    with staged(sketches(df, variables, at, by, accuracy), "sketches") as sketched:
        rows = _long(df, variables, by).alias("r").join(sketched.alias("s"), same("r", "s")).select(
            *[F.col(f"r.{c}").alias(c) for c in [*by, "variable"]], F.col("r.value").alias("value"), F.col("s.brackets").alias("brackets"))
        inside = F.exists("brackets", lambda b: (b["low"] <= F.col("value")) & (F.col("value") <= b["high"]))
        below = F.size(F.filter("brackets", lambda b: b["low"] <= F.col("value")))
        counts = rows.select(*by, "variable", "value", inside.alias("inside"), below.alias("below")).groupBy(
            *by, "variable", "inside", F.when(F.col("inside"), -1).otherwise(F.col("below")).alias("segment"),
            F.when(F.col("inside"), F.col("value")).alias("exact")).agg(F.count("*").alias("c"), F.min("value").alias("value"))
        order = Window.partitionBy(*by, "variable").orderBy("value")
        placed = counts.withColumn("last", F.sum("c").over(order)).select(
            *by, "variable", "exact", "inside", (F.col("last") - F.col("c")).alias("first"), "last", F.sum("c").over(
                Window.partitionBy(*by, "variable")).alias("n"))
        # for each quantile the value at the rank below and at the one above
        wanted = F.array(*(F.struct(F.lit(float(q)).alias("q"), _ranks(F.col("n"), q).alias("place")) for q in at))
        hit = placed.select(*by, "variable", "n", "exact", "inside", "first", "last", F.explode(wanted).alias("w"))
        low, high = F.floor("w.place"), F.ceil("w.place")
        holds = lambda rank: (F.col("first") <= rank) & (rank < F.col("last"))
        ends = hit.where(holds(low) | holds(high)).groupBy(*by, "variable", "n", F.col("w.q").alias("q"), F.col("w.place").alias("place")).agg(
            F.min("exact").alias("a"), F.max("exact").alias("b"), F.min("inside").alias("inside"))
        result = ends.where(_or_fail(F.col("inside"))).select(*by, "variable", "n", "q", (F.col("a") + (F.col("place") - F.floor("place")) * (F.col("b") - F.col("a"))).alias("value"))
        return stage(result, "quantiles")


def _or_fail(met: Column) -> Column:
    return F.when(~met, F.raise_error(F.lit("a rank lies outside its bracket")).cast("boolean")).otherwise(True)


def _all(tests: Iterable[Column]) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out
