"""Code lists as ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collapse_ranges(df: DataFrame, group: list[str], code: str, text: str = "codes") -> DataFrame:
    """Distinct integer codes per group as ``1--2, 5``.

    Repeats are removed before the shuffle; a group then holds at most as many
    rows as its classification has codes.
    """
    codes = df.select(*group, F.col(code).cast("long").alias("_code")).dropna(subset=["_code"]).distinct()
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_code"))
    runs = (
        codes.withColumn("_run", F.col("_code") - rank)
        .groupBy(*group, "_run").agg(F.min("_code").alias("low"), F.max("_code").alias("high"))
    )
    low, high = F.col("low").cast("string"), F.col("high").cast("string")
    part = F.when(F.col("low") == F.col("high"), low).otherwise(F.concat(low, F.lit("--"), high))
    return runs.groupBy(*group).agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("low", part.alias("part"))))["part"], ", ").alias(text)
    )
