"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A table counts as this many pieces for each shuffle partition; a key is hot if it has more rows than a piece.
PIECES_PER_TASK = 4
# Keys are counted in this many hash buckets, by as many tasks.
BUCKETS = 64
# What the sketch can list and track.
LISTED, TRACKED = 100_000, 1_000_000


def pieces(df: DataFrame) -> int:
    return min(LISTED, PIECES_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(df: DataFrame, key: str, split: int | None = None) -> DataFrame:
    """Keys with more than a piece of all rows, and the number of parts each is split into.

    The table counts as ``split`` pieces (four for each shuffle partition), so at
    most ``split`` keys can hold more than one: the list is bounded by arithmetic and
    leaves no such key out. A frequent-items sketch per bucket, which tracks many
    times as many keys, is merged map-side, so no row is shuffled. Its counts are off by
    a fraction of a piece at most, which may split a key that did not need it.
    """
    split = split or pieces(df)
    top = f"approx_top_k(`{key}`, {split}, {min(TRACKED, 16 * split)})"
    known = df.select(key).dropna()
    counted = known.groupBy(F.pmod(F.hash(key), F.lit(BUCKETS)).alias("_bucket")).agg(
        F.expr(top).alias("_top"), F.count("*").alias("_n"))
    # one row a bucket
    piece = F.sum("_n").over(Window.partitionBy()) / F.lit(split)
    return counted.withColumn("_piece", piece).select("_piece", F.inline("_top")).filter(
        F.col("count") > F.col("_piece")
    ).select(F.col("item").alias(key), F.ceil(F.col("count") / F.col("_piece")).cast("int").alias("_parts"))


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    row_key: list[str],
    seen: DataFrame | None = None,
    split: int | None = None,
) -> DataFrame:
    """Left join to a table unique on ``keys``; rows of hot keys go to several tasks.

    Hot are values of the first key, looked for in ``seen`` (``left`` by
    default). Rows with a null key match nothing and are spread as well. The
    salt is a hash of ``row_key``, the columns that tell rows of one key apart,
    so a repeated task gives the same result.
    """
    key = keys[0]
    # at most ``split`` rows
    hot = F.broadcast(hot_keys(left if seen is None else seen, key, split))
    row_hash = F.xxhash64(*row_key)
    salted = left.join(hot, key, "left").withColumn(
        "_salt",
        F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(1 << 30)) + 1)
        .when(F.col("_parts").isNotNull(), F.pmod(row_hash, F.col("_parts")))
        .otherwise(0).cast("long"),
    ).drop("_parts")
    copies = right.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    ).withColumn("_salt", F.col("_salt").cast("long")).drop("_parts")
    joined = salted.join(copies, [*keys, "_salt"], "left")
    return joined.select(*left.columns, *[c for c in right.columns if c not in keys])
