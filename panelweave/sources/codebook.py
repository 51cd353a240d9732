"""Codebook files as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.sources.records import quoted_records

VARIABLE_FIELDS = ("study", "dataset", "version", "variable", "label", "label_de")
VALUE_FIELDS = ("study", "dataset", "version", "variable", "value", "label", "label_de")
QUOTED = '"[^"]*"'


def _scan(spark: SparkSession, glob: str, fields: tuple[str, ...], least: int, suffix: str) -> DataFrame:
    """All files of a glob as text; rows with fewer than ``least`` fields are dropped.

    Quoted fields may hold line breaks and doubled quotes; a file is read by many tasks all the same.
    ``source`` is the file name without its suffix; ``position`` orders the rows as they stand in
    the files. Header rows are kept: they can match a search. A missing trailing field counts as empty.

    A row with another number of fields than named is handed out as it stands;
    its fields are counted as the commas left when the quoted parts are taken out.
    """
    schema = ", ".join(f"{f} string" for f in (*fields, "_other"))
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_other"}
    # a generator parses a record once: filters are not pushed below it, where each would parse again
    rows = quoted_records(spark, glob).select("file", "position", F.inline(F.array(F.from_csv("text", F.lit(schema), options))))
    commas = F.length(F.regexp_replace(F.regexp_replace("_other", QUOTED, ""), "[^,]+", ""))
    file = F.url_decode(F.replace(F.regexp_extract("file", "([^/]*)$", 1), F.lit("+"), F.lit("%2B")))
    return rows.filter(F.col("_other").isNull() | (commas + 1 >= least)).select(
        F.regexp_replace(file, f"{suffix}$", "").alias("source"), "position", *[F.coalesce(f, F.lit("")).alias(f) for f in fields],
    )


def read_variables(spark: SparkSession, folder: str, dataset: str | None = None) -> DataFrame:
    return _scan(spark, f"{folder}/{dataset or '*'}_variables.csv", VARIABLE_FIELDS, 5, "_variables.csv")


def read_values(spark: SparkSession, folder: str, dataset: str | None = None) -> DataFrame:
    return _scan(spark, f"{folder}/{dataset or '*'}_values.csv", VALUE_FIELDS, 6, "_values.csv")
