"""Session settings and written stages between jobs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Folder, below the shared one, of the run that is going on.
_RUN: ContextVar[str] = ContextVar("run", default="")


def local_session(app: str = "panelweave", cores: str = "*", **settings: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitted session is used instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # test tables are small: keep several tasks per stage all the same
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def stage_folder(spark: SparkSession) -> str:
    """The shared folder named by the session; where none is named, one under its warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    folder = folder or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stages").rstrip("/") + _RUN.get()


@contextmanager
def owned_stages(spark: SparkSession) -> Iterator[None]:
    """What is staged in the block belongs to it and is deleted at its end; what has to stay is ``written`` to a folder named before."""
    outer = _RUN.set(f"{_RUN.get()}/run-{uuid.uuid4().hex}")
    folder = stage_folder(spark)
    try:
        yield
    finally:
        _RUN.reset(outer)
        delete_folder(spark, folder)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used before loops over the same rows: it cuts the lineage, survives lost
    executors, and later passes read only the columns they name.
    """
    return written(df, new_folder(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The same, for rows that nobody reads after the block: the files are deleted at its end."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    try:
        yield written(df, path)
    finally:
        delete_folder(spark, path)
