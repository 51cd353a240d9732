"""Person tables laid out by person: bucketed on the person and sorted by person and year.

What is asked about persons then needs no exchange of rows: merging tables, person means
and bringing them back, and the pass that sums up scores by person. Rows are exchanged once,
when a table is written; all tables of a study take the same number of buckets.

Spark knows buckets of catalogued tables only, so a layout is entered in the session's catalog when it is
opened. What is needed for that lies beside the files, and any session can open it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.operators.assemble import PERSON_KEY, merge_person_tables, unique_or_fail

PERSON, YEAR = PERSON_KEY


def _mark(name: str) -> str:
    return f"_in_{name}"


def _note(spark: SparkSession, path: str):
    note = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_layout.json")
    return note.getFileSystem(spark._jsc.hadoopConfiguration()), note


def write_by_person(df: DataFrame, path: str, buckets: int, name: str = "rows", exchange: bool = True) -> DataFrame:
    """Write ``df`` to a new folder and open it. ``name`` tells tables that are merged apart.

    A row without a person or year is kept like any other. One file a bucket: choose as many that one fits
    a task at the most. Without ``exchange`` rows are written from where they are, which for rows
    that do not lie by person in as many partitions only means more files.
    """
    spark = df.sparkSession
    marked = df.select(PERSON, YEAR, *[c for c in df.columns if c not in PERSON_KEY], F.lit(1).cast("byte").alias(_mark(name)))
    entry = f"layout_{uuid.uuid4().hex}"
    placed = marked.repartition(buckets, PERSON) if exchange else marked
    placed.write.bucketBy(buckets, PERSON).sortBy(PERSON, YEAR).option("path", path).format("parquet").mode("errorifexists").saveAsTable(entry)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in marked.schema])
    spark.sql(f"DROP TABLE {entry}")  # the files of a table with a path of its own stay
    files, note = _note(spark, path)
    stream = files.create(note, False)
    stream.write(json.dumps({"buckets": buckets, "name": name, "schema": schema.jsonValue()}).encode())
    stream.close()
    return read_by_person(spark, path)


def _layout(spark: SparkSession, path: str) -> dict:
    files, note = _note(spark, path)
    if not files.exists(note):
        raise FileNotFoundError(f"no person layout at {path}")
    stream = files.open(note)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _open(spark: SparkSession, path: str, buckets: int, schema: T.StructType) -> DataFrame:
    """The layout with the columns of ``schema``; those that its files lack are null."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    entry = "layout_" + hashlib.md5(f"{path} {buckets} {columns}".encode()).hexdigest()
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {entry} ({columns}) USING parquet CLUSTERED BY ({PERSON}) SORTED BY ({PERSON}, {YEAR}) "
              f"INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(entry)


def read_by_person(spark: SparkSession, path: str) -> DataFrame:
    layout = _layout(spark, path)
    df = _open(spark, path, layout["buckets"], T.StructType.fromJson(layout["schema"]))
    return df.drop(_mark(layout["name"]))


#: Keeps scans bucketed below a union, whose parts are otherwise taken to lie by person and yet read file by file.
BUCKETED = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def merge_by_person(spark: SparkSession, paths: list[str], to: str, name: str = "rows") -> DataFrame:
    """Full outer merge of layouts on the person-year into a new layout, as ``merge_person_tables`` does it, without an exchange.

    Every layout is read with the columns of all, so the rows of all lie by person in one union, and what is
    merged lies where it is written. A key with two rows in one of them fails the job. Should Spark plan the union in another way,
    rows are exchanged.
    """
    merged, buckets = _merged(spark, paths)
    before = spark.conf.get(BUCKETED)
    spark.conf.set(BUCKETED, "false")
    try:
        in_place = lies_by_person(merged, buckets)
        rows = merged if in_place else merge_person_tables([read_by_person(spark, p) for p in paths])
        return write_by_person(rows.select(merged.columns), to, buckets, name, exchange=not in_place)
    finally:
        spark.conf.set(BUCKETED, before)


def lies_by_person(df: DataFrame, buckets: int) -> bool:
    """True if the plan of ``df`` reads buckets, moves no rows and puts each bucket into one task."""
    execution = df._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    in_place = "Exchange" not in plan and plan.count("FileScan") == plan.count("Bucketed: true")
    return in_place and execution.toRdd().getNumPartitions() == buckets


def _merged(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, int]:
    layouts = [_layout(spark, p) for p in paths]
    if len({x["buckets"] for x in layouts}) != 1:
        raise ValueError("layouts with different numbers of buckets")
    if len({x["name"] for x in layouts}) != len(layouts):
        raise ValueError("layouts of the same name")
    schemas = [T.StructType.fromJson(x["schema"]) for x in layouts]
    values = [f for s in schemas for f in s if f.name not in PERSON_KEY]
    names = [f.name for f in values]
    if len(names) != len(set(names)):
        raise ValueError(f"columns in more than one table: {sorted({n for n in names if names.count(n) > 1})}")
    keys = [schemas[0][k] for k in PERSON_KEY]
    marks = [_mark(x["name"]) for x in layouts]
    scans = [_open(spark, p, layouts[0]["buckets"], T.StructType([*keys, *values])) for p in paths]
    # true of every row. A union of columnar scans puts their buckets one after the other; one of rows, as filters give, side by side
    scans = [t.where(F.coalesce(mark, F.lit(1)) > 0) for t, mark in zip(scans, marks, strict=True)]
    flat = [n for n in names if n not in marks]
    merged = reduce(lambda a, b: a.union(b), scans).groupBy(*PERSON_KEY).agg(
        *[F.max(c).alias(c) for c in flat], F.greatest(F.lit(0), *[F.count(m) for m in marks]).alias("_most"))
    kept = merged.filter(unique_or_fail(F.col("_most") <= 1, "a person table")).select(*PERSON_KEY, *flat)
    return kept, layouts[0]["buckets"]


def add_person_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every row with its person's means, for rows that lie by person: as ``add_group_means``, without an exchange.

    A person has a row for a year, so none holds many rows and nothing is salted. Rows without a person have no means.
    """
    means = df.groupBy(F.col(PERSON).alias("_person")).agg(*[F.avg(c).alias(f"{c}_mean") for c in columns])
    # merged, not sent round: both sides lie by person already
    return df.join(means.hint("merge"), F.col(PERSON) == F.col("_person"), "left").drop("_person")
