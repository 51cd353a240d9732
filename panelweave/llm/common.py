"""Expressions and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.session import stage

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Beyond either a small side is not sent to every executor. Bytes are those of the rows as JSON text.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(df: DataFrame, *carry: str) -> Column:
    """The carried columns (all by default) as one struct, so that names of the caller clash with none of ours."""
    return F.struct(*(df[f"`{c}`"] for c in (carry or df.columns)))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def small_side(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, and marked for broadcast if its rows and their size, both counted, stay below the bounds.

    Beyond them the join is a shuffled one, whose skewed keys AQE splits.
    """
    written = stage(df, name)
    if written.count() > BROADCAST_ROWS:
        return written
    size = written.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(written) if size <= BROADCAST_BYTES else written


def place(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Sort all rows over the cluster, write them once and add ``place``, which orders them.

    Rows are range partitioned on ``order`` and, among equal rows, on their position
    in the input, so that one key held by a third of the rows still goes to many
    tasks. ``place`` is (part, file, row): the number of the written part and the row
    in its file. It is read from the files and stays the same if a task runs again.

    ``df`` must be a written table or narrow expressions over one: a task that runs
    again then reads the same rows in the same order and numbers them alike.
    """
    tied = df.withColumn("tie_", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_last() for c in [*order, "tie_"]]
    written = stage(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie_"), name)
    file = F.col("_metadata.file_name")
    return written.select(
        "*",
        F.struct(
            F.regexp_extract(file, r"part-(\d+)", 1).cast("long").alias("part"),
            file.alias("file"), F.col("_metadata.row_index").alias("row"),
        ).alias("place"),
    )
