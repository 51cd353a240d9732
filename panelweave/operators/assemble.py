"""Person-year panel from person and household tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.skew import salted_left_join

PERSON_KEY = ["pid", "syear"]
HOUSEHOLD_KEY = ["hid", "syear"]


def unique_or_fail(met: Column, what: str) -> Column:
    """True, or a failed job when a key has more than one row."""
    message = F.lit(f"duplicate key in {what}")
    return F.when(~met, F.raise_error(message).cast("boolean")).otherwise(True)


def merge_person_tables(
    tables: list[DataFrame], keys: list[str] = PERSON_KEY, unique_keys: bool = True
) -> DataFrame:
    """Full outer merge of all tables on the person-year key.

    With unique keys the merge is one union and one aggregation: a single
    shuffle on the key, where chained full joins shuffle once per join because
    their key is recomputed. Each value stands in one row of its key, so any
    aggregate that skips nulls returns it. The same aggregation fails the job
    when a key has more rows than tables that know it. With ``unique_keys=False``
    duplicates multiply, as in a plain join.
    """
    values = [[c for c in t.columns if c not in keys] for t in tables]
    flat = [c for cols in values for c in cols]
    if len(flat) != len(set(flat)):
        raise ValueError(f"columns in more than one table: {sorted({c for c in flat if flat.count(c) > 1})}")
    if not unique_keys:
        return reduce(lambda a, b: _full_join(a, b, keys), tables)

    tagged = [
        t.select(*keys, *cols, F.lit(1 << i).alias("_table")) for i, (t, cols) in enumerate(zip(tables, values))
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    merged = stacked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in flat],
        F.count("*").alias("_rows"),
        F.bit_count(F.bit_or("_table")).alias("_tables"),
    )
    return merged.filter(unique_or_fail(F.col("_rows") == F.col("_tables"), "a person table")).select(*keys, *flat)


def _full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full join in which null keys match each other."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = left.join(other, on, "full")
    return joined.select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in keys],
        *[c for c in left.columns if c not in keys],
        *[c for c in right.columns if c not in keys],
    )


def check_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """One row per key, or a failed job."""
    values = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.max(c).alias(c) for c in values])
    return rows.filter(unique_or_fail(F.col("_n") == 1, what)).drop("_n")


def add_household_tables(
    panel: DataFrame,
    tables: list[DataFrame],
    keys: list[str] = HOUSEHOLD_KEY,
    members: DataFrame | None = None,
    split: int | None = None,
) -> DataFrame:
    """Left join of household-year tables onto the panel.

    Person-years without a household, and households with very many person-years,
    are spread over tasks. ``members`` is the table the household id came from:
    looking for such households there reads one column of one table instead of
    the merged panel.
    """
    for table in tables:
        known = check_unique(table.dropna(subset=keys), keys, "a household table")
        panel = salted_left_join(panel, known, keys, PERSON_KEY, members, split)
    return panel


def attach_dimension(dimension: DataFrame, stats: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Inner join of a dimension to per-member statistics under different key names."""
    return dimension.join(stats, F.col(left_on) == F.col(right_on), "inner")
