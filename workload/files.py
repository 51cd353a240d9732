"""From survey files to tables: the derived datasets are written as CSV and read back the way a study reads its files."""

import json
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from panelweave.plans.master import build_master
from panelweave.registry import Registry
from panelweave.session import stage, stage_folder
from panelweave.sources import tables, versions
from workload.catalog import query
from workload.frames import REGISTRY, frame
from workload.joining import MASTER_COLUMNS


def _survey_files(spark, sf_dir, names):
    """A registry whose files are CSV copies of the derived datasets, one of them under another name."""
    folder = f"{stage_folder(spark)}/files-{uuid.uuid4().hex}"
    registry = replace(REGISTRY, survey_dir=folder, key_files={"pl": "persons_long.csv"})
    for name in names:
        frame(spark, sf_dir, name).write.option("header", True).csv(registry.csv_path(name))
    return registry


@query("extract_csv", "SELECT pid, syear, plb0097, plb0095_v1, plh0173, plb0193_h FROM c_pl")
def extract_csv(spark, sf_dir):
    registry = _survey_files(spark, sf_dir, ["pl"])
    return tables.extract(spark, registry, "pl").select(
        "pid", "syear", "plb0097", "plb0095_v1", "plh0173", "plb0193_h"
    )


@query("read_variable", "SELECT pid, syear, plh0173 FROM c_pl")
def read_variable(spark, sf_dir):
    registry = _survey_files(spark, sf_dir, ["pl"])
    return tables.read_variable(spark, registry.csv_path("pl"), "plh0173")


@query("stored_tables", "SELECT hid, syear, hlf0019_h FROM c_hl")
def stored_tables(spark, sf_dir):
    """Extracted once, found up to date the second time, then scanned by year."""
    registry = _survey_files(spark, sf_dir, list(REGISTRY.raw_columns()))
    folder = f"{registry.survey_dir}/tables"
    tables.refresh(spark, registry, folder)
    if tables.refresh(spark, registry, folder):
        raise AssertionError("tables were extracted twice")
    _, (homes,) = tables.load(spark, registry, folder)
    return homes


@query("refreshed_tables", """
    SELECT 'missing' AS mode, false AS had_table, count(*) AS persons, sum(plh0173) AS total FROM c_pl
    UNION ALL SELECT 'missing', true, count(*), sum(plh0173) FROM c_pl
    UNION ALL SELECT 'stale', true, count(*), sum(plh0173) FROM c_pl
    UNION ALL SELECT 'force', true, count(*), sum(plh0173) FROM c_pl""")
def refreshed_tables(spark, sf_dir):
    """Each refresh mode on missing tables, tables without a needed column, and good ones."""
    registry = _survey_files(spark, sf_dir, list(REGISTRY.raw_columns()))
    folder = f"{registry.survey_dir}/tables"
    everything = registry.datasets()
    parts = []

    def refreshed(mode, had_table, expected):
        if tables.refresh(spark, registry, folder, mode) != expected:
            raise AssertionError(f"{mode}: other tables than expected were extracted")
        person, _ = tables.load(spark, registry, folder)
        pl = next(t for t in person if "plh0173" in t.columns)
        parts.append(stage(pl.agg(F.count("*").alias("persons"), F.sum("plh0173").alias("total")).select(
            F.lit(mode).alias("mode"), F.lit(had_table).alias("had_table"), "persons", "total"), "refreshed"))

    refreshed("missing", False, everything)
    refreshed("missing", True, [])
    path = tables.table_path(folder, "pl")
    tables.write_version(versions.read(spark, path).drop("plh0173"), path)
    refreshed("stale", True, ["pl"])
    refreshed("force", True, everything)
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("master_from_files", f"""
    SELECT {MASTER_COLUMNS}, round(sqm_per_head, 6) AS sqm_per_head, CAST(sector AS INT) AS sector FROM master""")
def master_from_files(spark, sf_dir):
    registry = _survey_files(spark, sf_dir, list(REGISTRY.raw_columns()))
    folder = f"{registry.survey_dir}/tables"
    build_master(spark, registry, folder)
    master = tables.load_master(spark, f"{folder}/master.parquet")
    return master.select(*MASTER_COLUMNS.split(", "), F.round("sqm_per_head", 6).alias("sqm_per_head"), "sector")


@query("refreshed_years", """
    WITH m AS (SELECT (min(syear) + max(syear)) // 2 AS y FROM pl)
    SELECT syear, CASE WHEN syear < m.y THEN 1 WHEN syear = m.y THEN 3 ELSE 2 END AS version,
           count(*) AS persons, count(plh0173) AS answers, sum(plh0173) AS total
    FROM c_pl, m GROUP BY ALL""")
def refreshed_years(spark, sf_dir):
    """New waves and late answers come as further files: only their years are read again, each version keeps the others."""
    registry = _survey_files(spark, sf_dir, [n for n in REGISTRY.raw_columns() if n != "pl"])
    source, folder = registry.csv_path("pl"), f"{registry.survey_dir}/tables"
    waves = frame(spark, sf_dir, "pl")
    first, last = waves.agg(F.min("syear"), F.max("syear")).first()
    middle = (first + last) // 2
    late = F.col("pid") % 3 == 0
    deliveries = (
        (F.col("syear") < middle) | ((F.col("syear") == middle) & ~late), F.col("syear") > middle, (F.col("syear") == middle) & late)
    for rows in deliveries:
        waves.where(rows).write.option("header", True).mode("append").csv(source)
        if "pl" not in tables.refresh(spark, registry, folder):
            raise AssertionError("changed files were not read")
    path = tables.table_path(folder, "pl")
    version = versions.latest(spark, path)
    written = spark.createDataFrame([(int(part.split("=")[1]), n) for part, n in version.years().items()], "syear int, version int")
    by_year = versions.read(spark, path, version).groupBy("syear").agg(
        F.count("*").alias("persons"), F.count("plh0173").alias("answers"), F.sum("plh0173").alias("total"))
    return written.join(by_year, "syear").select("syear", "version", "persons", "answers", "total")


@query("configured_study", "SELECT pid, syear, plh0173, CAST(CASE plb0193_h WHEN 1 THEN 2 WHEN 0 THEN 1 END AS DOUBLE) AS overtime FROM c_pl")
def configured_study(spark, sf_dir):
    """A study described by a JSON file of its own, read back and extracted: another folder entry, file name and recoding."""
    source = _survey_files(spark, sf_dir, ["pl"])
    study = {
        "data": {"waves": source.survey_dir, "key_files": {"pl": "persons_long.csv"}},
        "variables": {"answers": [{"name": "plh0173", "dataset": "pl", "label": "Hours"}, {"name": "overtime", "dataset": "pl", "label": "Overtime"}]},
        "panels": [{"key": "answers", "label": "Answers"}],
        "harmonize": [{"name": "overtime", "dataset": "pl", "label": "Overtime", "sources": [
            {"variable": "plb0193_v1", "recode": {"1": 2, "2": 1}}, {"variable": "plb0193_v2", "recode": {"1": 2, "2": 1}}]}],
    }
    path = f"{source.survey_dir}/study"
    spark.createDataFrame([(json.dumps(study, indent=1),)], "value string").coalesce(1).write.text(path)
    registry = Registry.load(spark, path, folder_key="waves")
    return tables.extract(spark, registry, "pl").select("pid", "syear", "plh0173", "overtime")
