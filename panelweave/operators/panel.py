"""Panel structure, person means and within-person deviations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators.skew import salted_left_join


def panel_size(df: DataFrame, waves: DataFrame, person: str = "pid") -> DataFrame:
    """Observations, persons, observations per person and balance ratio.

    ``waves`` is the panel whose distinct years count as possible waves.
    """
    per_person = df.groupBy(person).agg(F.count("*").alias("n"))
    sizes = per_person.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("observations"),
        F.count(person).alias("individuals"),
        F.avg("n").alias("mean_obs"),
        F.min("n").alias("min_obs"),
        F.max("n").alias("max_obs"),
    )
    possible = waves.agg(F.countDistinct("syear").alias("waves")).scalar()
    return sizes.withColumn("waves", possible).withColumn(
        "balance", F.try_divide(F.col("observations"), F.col("individuals") * F.col("waves"))
    )


def wave_histogram(df: DataFrame, person: str = "pid") -> DataFrame:
    """Persons per number of waves, and their percent of all persons; rows without a person count nowhere."""
    per_person = df.dropna(subset=[person]).groupBy(person).agg(F.count("*").alias("waves"))
    everyone = df.agg(F.countDistinct(person)).scalar()
    return per_person.groupBy("waves").agg(F.count("*").alias("persons")).select(
        "waves", "persons", (F.col("persons") * 100 / everyone).alias("percent")
    )


def group_means(df: DataFrame, columns: Iterable[str], group: str = "pid") -> DataFrame:
    """Means per group as ``<column>_mean`` and the number of rows ``n``.

    Partial sums are taken before the shuffle, so a group of any size reaches
    its task as one row per input task.
    """
    return df.groupBy(group).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], F.count("*").alias("n")
    )


def add_group_means(
    df: DataFrame, columns: Iterable[str], group: str = "pid", row: str = "syear", split: int | None = None
) -> DataFrame:
    """Every row with the means of its group over the rows given (filter before, not after).

    ``row`` tells the rows of a group apart. ``df`` is read for the means, for
    the hot groups and for the join: stage it when it is expensive to compute.
    """
    means = group_means(df, columns, group).drop("n")
    return salted_left_join(df, means, [group], [group, row], split=split)


def within_deviations(
    df: DataFrame, columns: Iterable[str], group: str = "pid", row: str = "syear", split: int | None = None
) -> DataFrame:
    """``<column>_within``: value minus group mean. Groups of one row become all zero and stay."""
    columns = list(columns)
    with_means = add_group_means(df, columns, group, row, split)
    return with_means.withColumns({f"{c}_within": F.col(c) - F.col(f"{c}_mean") for c in columns})


# -- waves as bits ---------------------------------------------------------------------------
#
# A person's waves are a set of bits, so one row a person says who answered when. Persons with the
# same pattern are one row from then on: sizes, histograms and years are sums over patterns.

#: Years in one number.
WORD = 62


def wave_patterns(df: DataFrame, person: str = "pid", year: str = "syear") -> DataFrame:
    """Rows (known, rows, first, waves, persons): how many persons have the same rows and the same years.

    ``waves`` is a list of numbers whose bits are the years from ``first`` on, WORD a number. ``known`` is false for the rows
    without a person, which count as one. A row without a year sets no bit. Years are looked for in the data; every row is
    read once for that and once for the bits, and added up before the one shuffle by person.
    """
    first, last = df.agg(F.min(year), F.max(year)).first()
    first, last = (first, last) if first is not None else (0, 0)
    offset = F.col(year) - F.lit(first)
    bits = [
        F.bit_or(F.when((offset >= WORD * i) & (offset < WORD * (i + 1)), F.call_function("shiftleft", F.lit(1).cast("long"), (offset - WORD * i).cast("int"))))
        for i in range((last - first) // WORD + 1)
    ]
    of_person = df.groupBy(person).agg(F.count("*").alias("rows"), F.array(*(F.coalesce(b, F.lit(0)) for b in bits)).alias("waves"))
    return of_person.groupBy(F.col(person).isNotNull().alias("known"), "rows", "waves").agg(F.count("*").alias("persons")).select(
        "known", "rows", F.lit(first).cast("int").alias("first"), "waves", "persons")


def pattern_years(patterns: DataFrame) -> DataFrame:
    """Years in which anyone has a row."""
    place = F.explode(F.sequence(F.lit(0), F.size("waves") * WORD - 1))
    bits = patterns.select("first", "waves", place.alias("at"))
    there = F.call_function(
        "shiftright", F.get("waves", F.floor(F.col("at") / WORD).cast("int")), (F.col("at") % WORD).cast("int")) % 2 == 1
    return bits.where(there).select((F.col("first") + F.col("at")).alias("syear")).distinct()


def pattern_size(patterns: DataFrame, waves: DataFrame | None = None) -> DataFrame:
    """As ``panel_size``, from patterns; ``waves`` are the patterns whose years count as possible."""
    weight = F.col("persons")
    sizes = patterns.agg(
        F.coalesce(F.sum(F.col("rows") * weight), F.lit(0)).alias("observations"),
        F.coalesce(F.sum(F.when(F.col("known"), weight)), F.lit(0)).alias("individuals"),
        (F.sum(F.col("rows") * weight) / F.sum(weight)).alias("mean_obs"),
        F.min("rows").alias("min_obs"), F.max("rows").alias("max_obs"),
    )
    possible = pattern_years(patterns if waves is None else waves).agg(F.count("*")).scalar()
    return sizes.withColumn("waves", possible).withColumn(
        "balance", F.try_divide(F.col("observations"), F.col("individuals") * F.col("waves"))
    )


def pattern_histogram(patterns: DataFrame) -> DataFrame:
    """As ``wave_histogram``, from patterns."""
    known = patterns.where("known")
    everyone = known.agg(F.sum("persons")).scalar()
    return known.groupBy(F.col("rows").alias("waves")).agg(F.sum("persons").alias("persons")).select(
        "waves", "persons", (F.col("persons") * 100 / everyone).alias("percent")
    )


def participation(patterns: DataFrame) -> DataFrame:
    """Persons by pattern as text, a 1 for each year with a row and a 0 for one without, from the first year to the last."""
    last = patterns.agg(F.max(F.aggregate(
        F.transform("waves", lambda w, i: F.when(w > 0, i * WORD + F.length(F.bin(w)))), F.lit(0).cast("int"),
        lambda a, b: F.greatest(a, b)))).scalar()
    text = F.array_join(F.transform("waves", lambda w: F.reverse(F.lpad(F.bin(w), WORD, "0"))), "")
    return patterns.where("known").groupBy(F.substring(text, F.lit(1), last).alias("pattern")).agg(F.sum("persons").alias("persons"))
