"""Panels the queries share, built from the derived datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelweave.operators import derive
from panelweave.plans import master as plans
from panelweave.session import stage
from workload.frames import REGISTRY, household_tables, person_tables


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All person-years with household columns."""
    return plans.merged_panel(person_tables(spark, sf_dir), household_tables(spark, sf_dir))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-time person-years of the study years, derived and recoded."""
    return plans.master_panel(person_tables(spark, sf_dir), household_tables(spark, sf_dir), REGISTRY)


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.model_columns(master(spark, sf_dir))


def stored_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master panel as a written table, for queries that read it more than once."""
    return stage(master(spark, sf_dir), "master")
