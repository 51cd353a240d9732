"""Merging person tables, joining households and dimensions."""

import uuid

from pyspark.sql import functions as F

from panelweave.fixed_values import STATES
from panelweave.operators import assemble, shares
from panelweave.session import stage_folder
from panelweave.sources import layout
from panelweave.sources.tables import states
from workload import inputs
from workload.catalog import query
from workload.frames import STUDY_YEARS, household_tables, person_tables

PERSON_COLUMNS = (
    "pid, syear, hid, gebjahr, sex, partner, migback, plb0097, plb0095_v1, plh0173, plb0193_h, pgisced97, "
    "pglfs, pgemplst, pgnace, pgnace2, d11106, d11107, i11102, l11101, e11101"
)


@query("panel_full_outer", f"SELECT {PERSON_COLUMNS} FROM person")
def panel_full_outer(spark, sf_dir):
    return assemble.merge_person_tables(person_tables(spark, sf_dir)).select(PERSON_COLUMNS.split(", "))


@query("panel_full_join", "SELECT pid, syear, hid, plb0097, pgemplst, i11102 FROM person")
def panel_full_join(spark, sf_dir):
    merged = assemble.merge_person_tables(person_tables(spark, sf_dir), unique_keys=False)
    return merged.select("pid", "syear", "hid", "plb0097", "pgemplst", "i11102")


def person_layout(spark, sf_dir):
    """The person tables laid out by person, and their merge."""
    folder = f"{stage_folder(spark)}/layout-{uuid.uuid4().hex}"
    paths = []
    for i, table in enumerate(person_tables(spark, sf_dir)):
        paths.append(f"{folder}/{i}")
        layout.write_by_person(table, paths[-1], 8, f"t{i}")
    return layout.merge_by_person(spark, paths, f"{folder}/merged")


@query("layout_merge", f"""SELECT {PERSON_COLUMNS}, round(avg(plh0173) OVER p, 6) AS plh0173_mean, round(avg(i11102) OVER p, 4) AS i11102_mean
    FROM person WINDOW p AS (PARTITION BY pid)""")
def layout_merge(spark, sf_dir):
    """Tables that lie by person merged and given person means where they lie."""
    with_means = layout.add_person_means(person_layout(spark, sf_dir), ["plh0173", "i11102"])
    return with_means.select(*PERSON_COLUMNS.split(", "), F.round("plh0173_mean", 6).alias("plh0173_mean"),
                             F.round("i11102_mean", 4).alias("i11102_mean"))


@query("household_left_join", "SELECT pid, syear, hid, hlf0019_h FROM panel")
def household_left_join(spark, sf_dir):
    people = assemble.merge_person_tables(person_tables(spark, sf_dir)).select("pid", "syear", "hid")
    return assemble.add_household_tables(people, household_tables(spark, sf_dir))


STATE_ROWS = ", ".join(f"({code}, '{name}', '{short}')" for code, name, short in STATES)
REGION_SQL = """SELECT l11101, avg(CAST(plb0097 = 1 AS DOUBLE)) * 100 AS share FROM master
    WHERE plb0097 IN (0, 1) AND l11101 IS NOT NULL GROUP BY l11101"""


@query("region_inner_join", f"""
    SELECT d.state_code, d.state_name, d.short_name, round(s.share, 6) AS plb0097
    FROM (VALUES {STATE_ROWS}) d(state_code, state_name, short_name) JOIN ({REGION_SQL}) s ON d.state_code = s.l11101""")
def region_inner_join(spark, sf_dir):
    names = {code: name for code, name, _ in STATES}
    stats = shares.share_by_region(
        inputs.master(spark, sf_dir), STUDY_YEARS, "plb0097", "l11101", names
    ).select("plb0097", F.col("state_name").alias("region"))
    joined = assemble.attach_dimension(states(spark), stats, "state_name", "region")
    return joined.select("state_code", "state_name", "short_name", F.round("plb0097", 6).alias("plb0097"))


MASTER_COLUMNS = (
    "pid, syear, hid, sex, partner, migback, plb0097, plb0095_v1, plh0173, plb0193_h, pgisced97, pglfs, "
    "pgemplst, d11106, d11107, i11102, l11101, e11101, hlf0019_h, age"
)


@query("master_panel", f"""
    SELECT {MASTER_COLUMNS}, round(sqm_per_head, 6) AS sqm_per_head, CAST(sector AS INT) AS sector FROM master""")
def master_panel(spark, sf_dir):
    return inputs.master(spark, sf_dir).select(
        *MASTER_COLUMNS.split(", "), F.round("sqm_per_head", 6).alias("sqm_per_head"), "sector"
    )
