"""Shares of yes answers by year and by region."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.functions import columns as C


def share_by_year(df: DataFrame, columns: Mapping[str, str], valid: Iterable[float] = (0, 1)) -> DataFrame:
    """Ones among valid values per year for several columns ({column: output name}).

    The denominator is at least 1, so a year without valid answers has share 0.
    """
    def share(column):
        ones = F.count_if(F.col(column) == 1)
        return ones / F.greatest(F.count_if(F.col(column).isin(*valid)), F.lit(1))

    return (
        df.filter(F.col("syear").isNotNull()).groupBy("syear")
        .agg(*[share(c).alias(name) for c, name in columns.items()])
    )


def share_by_region(
    df: DataFrame, years: Iterable[int], outcome: str, region: str, labels: Mapping[int, str]
) -> DataFrame:
    """Percent of ones among 0/1 answers per region, labelled; rows without a region are left out."""
    answered = df.filter(
        F.col("syear").isin(*years) & F.col(outcome).isin(0, 1) & F.col(region).isNotNull()
    )
    shares = answered.groupBy(region).agg((F.avg((F.col(outcome) == 1).cast("double")) * 100).alias(outcome))
    return shares.withColumn("state_name", C.label_of(F.col(region), labels))
