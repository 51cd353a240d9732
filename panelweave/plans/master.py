"""The master panel: merged, derived, recoded and filtered person-years."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from panelweave.fixed_values import RECODES
from panelweave.operators import assemble, derive, sample
from panelweave.registry import Registry
from panelweave.sources import tables


def merged_panel(person: list[DataFrame], household: list[DataFrame]) -> DataFrame:
    """All person-years with their household columns."""
    panel = assemble.merge_person_tables(person)
    members = next((t for t in person if "hid" in t.columns), None)
    return panel.transform(assemble.add_household_tables, household, members=members)


def derived_panel(panel: DataFrame, registry: Registry, recodes: Mapping = RECODES) -> DataFrame:
    return (
        panel.transform(derive.add_space_per_head)
        .transform(derive.add_age)
        .transform(derive.add_sector, registry.sectors)
        .transform(derive.recode_columns, recodes)
    )


def master_panel(person: list[DataFrame], household: list[DataFrame], registry: Registry) -> DataFrame:
    """Full-time person-years of the study period.

    The year filter is applied to the inputs as well: it is part of both join
    keys, and below the joins it prunes partitions and shuffles less.
    """
    years = registry.study_years
    return (
        merged_panel(
            [sample.in_years(t, years) for t in person],
            [sample.in_years(t, years) for t in household],
        )
        .transform(derived_panel, registry)
        .transform(sample.full_time)
        .transform(sample.in_years, years)
    )


def build_master(spark: SparkSession, registry: Registry, folder: str) -> DataFrame:
    """From survey files to the written master panel; returns the written rows."""
    tables.refresh(spark, registry, folder, when="stale")
    person, household = tables.load(spark, registry, folder)
    master = master_panel(person, household, registry)
    return tables.save_master(master, f"{folder.rstrip('/')}/master.parquet", registry)
