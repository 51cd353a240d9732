"""Cleaning, recoding, deriving and filtering."""

import uuid

from pyspark.sql import functions as F

from panelweave.fixed_values import STATES, TIME_VARYING
from panelweave.functions import columns as C
from panelweave.operators import derive, sample
from panelweave.plans import master as plans
from panelweave.session import stage_folder
from panelweave.sources.tables import label_table, save_views
from workload import inputs
from workload.catalog import query
from workload.frames import REGISTRY, STUDY_YEARS, VARYING_SQL, _complete, dataset, frame

NUMBER_SQL = r"regexp_matches(answer, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')"
VALUE_SQL = f"CASE WHEN {NUMBER_SQL} THEN TRY_CAST(trim(answer) AS DOUBLE) END"
CODES_SQL = "(-8,-7,-6,-5,-4,-3,-2,-1)"


@query("numeric_coerce", f"SELECT id, {VALUE_SQL} AS value FROM answers")
def numeric_coerce(spark, sf_dir):
    return frame(spark, sf_dir, "answers").select("id", C.numeric("answer").alias("value"))


@query("sentinel_to_null", f"""
    SELECT id, CASE WHEN v NOT IN {CODES_SQL} THEN v END AS value
    FROM (SELECT id, {VALUE_SQL} AS v FROM answers)""")
def sentinel_to_null(spark, sf_dir):
    return frame(spark, sf_dir, "answers").select(
        "id", C.clean("answer").alias("value")
    )


@query("clean_count", f"""
    SELECT syear, count(*) FILTER (WHERE v IS NULL OR v NOT IN {CODES_SQL}) AS kept,
           count(*) FILTER (WHERE v NOT IN {CODES_SQL}) AS valid, count(*) AS total
    FROM (SELECT syear, {VALUE_SQL} AS v FROM answers) GROUP BY syear""")
def clean_count(spark, sf_dir):
    numbers = frame(spark, sf_dir, "answers").withColumn("value", C.numeric("answer"))
    valid = C.without_codes("value")
    return numbers.groupBy("syear").agg(
        F.count_if(F.col("value").isNull() | valid.isNotNull()).alias("kept"),
        F.count(valid).alias("valid"),
        F.count("*").alias("total"),
    )


@query("recode_simultaneous", """
    SELECT pid, syear, CASE sex WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 ELSE sex END AS sex,
           CASE WHEN partner = 5 THEN 0.0 WHEN partner = 0 THEN 5.0 WHEN partner = 4 THEN NULL ELSE partner END
             AS partner
    FROM c_ppathl""")
def recode_simultaneous(spark, sf_dir):
    recodes = {"sex": {1: 0, 2: 1}, "partner": {5: 0, 0: 5, 4: None}, "not_there": {1: 2}}
    return (
        dataset(spark, sf_dir, "ppathl").transform(derive.recode_columns, recodes)
        .select("pid", "syear", "sex", "partner")
    )


@query("harmonize_coalesce", "SELECT pid, syear, plb0193_h FROM c_pl")
def harmonize_coalesce(spark, sf_dir):
    return dataset(spark, sf_dir, "pl").select("pid", "syear", "plb0193_h")


@query("category_two_revisions", """
    SELECT pid, syear, CAST(sector AS INT) AS sector FROM derived
    WHERE (pid, syear) IN (SELECT (pid, syear) FROM pgen)""")
def category_two_revisions(spark, sf_dir):
    return (
        dataset(spark, sf_dir, "pgen").transform(derive.add_sector, REGISTRY.sectors)
        .select("pid", "syear", "sector")
    )


@query("derive_age", "SELECT pid, syear, syear - gebjahr AS age FROM c_ppathl")
def derive_age(spark, sf_dir):
    return dataset(spark, sf_dir, "ppathl").transform(derive.add_age).select("pid", "syear", "age")


@query("guarded_ratio", "SELECT pid, syear, round(sqm_per_head, 6) AS sqm_per_head FROM derived")
def guarded_ratio(spark, sf_dir):
    return (
        inputs.panel(spark, sf_dir).transform(derive.add_space_per_head)
        .select("pid", "syear", F.round("sqm_per_head", 6).alias("sqm_per_head"))
    )


@query("model_derivations", """
    SELECT pid, syear, round(work_hrs_100, 6) AS work_hrs_100, has_children, round(log_income, 6) AS log_income,
           migback_direct, migback_indirect, has_partner, sector FROM prep""")
def model_derivations(spark, sf_dir):
    return inputs.model_frame(spark, sf_dir).select(
        "pid", "syear", F.round("work_hrs_100", 6).alias("work_hrs_100"), "has_children",
        F.round("log_income", 6).alias("log_income"), "migback_direct", "migback_indirect", "has_partner",
        "sector",
    )


@query("dummies_null_zero", """
    SELECT pid, syear, CAST(coalesce(migback = 2, false) AS INT) AS migback_direct,
           CAST(coalesce(migback = 3, false) AS INT) AS migback_indirect FROM panel""")
def dummies_null_zero(spark, sf_dir):
    flags = inputs.panel(spark, sf_dir).transform(derive.migration_flags)
    return flags.select(
        "pid", "syear", F.col("migback_direct").cast("int").alias("migback_direct"),
        F.col("migback_indirect").cast("int").alias("migback_indirect"),
    )


@query("treatment_dummies", "SELECT pid, syear, " + ", ".join(
    f"CAST(sector = {i} AS DOUBLE) AS sector_{i}" for i in range(2, 16)) + " FROM master")
def treatment_dummies(spark, sf_dir):
    levels = [s.id for s in REGISTRY.sectors]
    coded = inputs.master(spark, sf_dir).transform(derive.treatment_dummies, "sector", levels)
    return coded.select("pid", "syear", *[f"sector_{i}" for i in levels[1:]])


@query("found_dummies", """
    SELECT 'sector_' || CAST(sector AS INT) AS dummy, count(*) AS rows FROM master
    WHERE sector > (SELECT min(sector) FROM master) GROUP BY sector""")
def found_dummies(spark, sf_dir):
    """Dummies of the levels that the data hold, the lowest left out, and the rows of each."""
    master = inputs.stored_master(spark, sf_dir)
    levels = derive.category_levels(master, "sector")
    coded = derive.treatment_dummies(master, "sector")
    names = [f"sector_{int(level)}" for level in levels[1:]]
    sums = coded.agg(*[F.sum(n).cast("long").alias(n) for n in names])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("dummy"), F.col(n).alias("rows")) for n in names])))


STATE_CASE = "CASE " + " ".join(f"WHEN l11101 = {code} THEN '{name}'" for code, name, _ in STATES) + " END"


@query("label_lookup", f"SELECT pid, syear, l11101, {STATE_CASE} AS state_name FROM c_pequiv")
def label_lookup(spark, sf_dir):
    names = {code: name for code, name, _ in STATES}
    return dataset(spark, sf_dir, "pequiv").select(
        "pid", "syear", "l11101", C.label_of(F.col("l11101"), names).alias("state_name")
    )


@query("filter_fulltime_years", "SELECT pid, syear, hid, pgemplst FROM master")
def filter_fulltime_years(spark, sf_dir):
    return (
        inputs.panel(spark, sf_dir).transform(sample.full_time).transform(sample.in_years, STUDY_YEARS)
        .select("pid", "syear", "hid", "pgemplst")
    )


@query("valid_outcome", """
    SELECT pid, syear, plb0097, plb0095_v1 FROM derived WHERE plb0097 IN (0, 1) AND plb0095_v1 IN (0, 1)""")
def valid_outcome(spark, sf_dir):
    everyone = inputs.panel(spark, sf_dir).transform(plans.derived_panel, REGISTRY)
    return everyone.filter(sample.valid("plb0097") & sample.valid("plb0095_v1")).select(
        "pid", "syear", "plb0097", "plb0095_v1"
    )


@query("complete_cases", f"SELECT pid, syear, plh0173 FROM prep WHERE {_complete(VARYING_SQL)}")
def complete_cases(spark, sf_dir):
    return inputs.model_frame(spark, sf_dir).transform(sample.complete_cases, TIME_VARYING).select(
        "pid", "syear", "plh0173"
    )


_ALL = ("hid, sex, partner, migback, plb0097, plb0095_v1, plh0173, plb0193_h, pgisced97, pglfs, pgemplst, "
        "d11106, d11107, i11102, l11101, e11101, hlf0019_h, sqm_per_head, age, sector")


@query("export_views", f"""
    SELECT 'full' AS view, pid, syear FROM master
    UNION ALL SELECT 'complete', pid, syear FROM master WHERE {_complete(_ALL)}
    UNION ALL SELECT 'eligible', pid, syear FROM master WHERE plb0097 IN (0, 1) AND {_complete(_ALL)}""")
def views(spark, sf_dir):
    """The written views, read back."""
    folder = f"{stage_folder(spark)}/views-{uuid.uuid4().hex}"
    parts = [
        df.select(F.lit(name).alias("view"), "pid", "syear")
        for name, df in save_views(inputs.stored_master(spark, sf_dir), folder).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LABELLED = ("age", "sqm_per_head", "sector", "plb0193_h", "plh0173", "syear")


@query("labelled_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, '{REGISTRY.labels()[c]}' AS label, count({c}) AS n FROM master" for c in _LABELLED))
def labelled_columns(spark, sf_dir):
    """Valid n per column under its label, from the table of labels."""
    master = inputs.master(spark, sf_dir)
    counts = master.agg(*[F.count(c).alias(c) for c in _LABELLED]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("n")) for c in _LABELLED])))
    return label_table(spark, REGISTRY).join(F.broadcast(counts), "variable").select("variable", "label", "n")
