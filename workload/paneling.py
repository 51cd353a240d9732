"""Person means, deviations, code ranges and analysis samples."""

from pyspark.sql import functions as F

from panelweave.fixed_values import TIME_VARYING
from panelweave.functions import columns as C
from panelweave.operators import panel, ranges, sample
from panelweave.operators.sample import analysis_sample
from panelweave.session import stage
from workload import inputs
from workload.catalog import query, rounded
from workload.frames import CONTROLS_SQL, REGISTRY, dataset

_MEANS_SQL = ", ".join(f"round(avg({v}) OVER (PARTITION BY pid), 6) AS {v}_mean" for v in TIME_VARYING)


@query("mundlak_means", f"SELECT pid, syear, {_MEANS_SQL} FROM s1")
def mundlak_means(spark, sf_dir):
    rows = analysis_sample(inputs.master(spark, sf_dir), sample.PREFERENCE)
    means = [f"{v}_mean" for v in TIME_VARYING]
    with_means = panel.add_group_means(stage(rows.select("pid", "syear", *TIME_VARYING), "rows"), TIME_VARYING)
    return rounded(with_means.select("pid", "syear", *means), 6, *means)


_WITHIN_SQL = ", ".join(
    f"round({v} - avg({v}) OVER (PARTITION BY pid), 6) + 0.0 AS {v}_within" for v in ("plb0097", *TIME_VARYING)
)


@query("within_demean", f"SELECT pid, syear, {_WITHIN_SQL} FROM w1")
def within_demean(spark, sf_dir):
    columns = ["plb0097", *TIME_VARYING]
    rows = analysis_sample(inputs.master(spark, sf_dir), sample.PREFERENCE_WITHIN)
    within = panel.within_deviations(stage(rows.select("pid", "syear", *columns), "rows"), columns)
    # adding 0 turns a rounded -0.0 into 0.0
    return within.select("pid", "syear", *[(F.round(f"{c}_within", 6) + 0.0).alias(f"{c}_within") for c in columns])


def _ranges_sql(column, which):
    codes = ", ".join(
        f"({s.id}, {code})" for s in REGISTRY.sectors for code in (s.rev1 if which == 1 else s.rev2)
    )
    return f"""SELECT sector, {which} AS revision, string_agg(
          CASE WHEN low = high THEN CAST(low AS VARCHAR) ELSE CAST(low AS VARCHAR) || '--' || CAST(high AS VARCHAR) END,
          ', ' ORDER BY low) AS codes
      FROM (SELECT sector, min(code) AS low, max(code) AS high
            FROM (SELECT m.sector, m.code, m.code - row_number() OVER (PARTITION BY m.sector ORDER BY m.code) AS run
                  FROM (VALUES {codes}) m(sector, code) SEMI JOIN c_pgen p ON p.{column} = m.code)
            GROUP BY sector, run)
      GROUP BY sector"""


@query("range_collapse", f"{_ranges_sql('pgnace', 1)} UNION ALL {_ranges_sql('pgnace2', 2)}")
def range_collapse(spark, sf_dir):
    """Industry codes people report, per sector and classification, as ranges."""
    seen = dataset(spark, sf_dir, "pgen")
    rev1 = C.category_of("pgnace", [(s.id, s.rev1) for s in REGISTRY.sectors])
    rev2 = C.category_of("pgnace2", [(s.id, s.rev2) for s in REGISTRY.sectors])
    pairs = F.array(
        F.struct(rev1.alias("sector"), F.lit(1).alias("revision"), F.col("pgnace").alias("code")),
        F.struct(rev2.alias("sector"), F.lit(2).alias("revision"), F.col("pgnace2").alias("code")),
    )
    long = seen.select(F.inline(pairs)).filter("sector IS NOT NULL")
    return ranges.collapse_ranges(long, ["sector", "revision"], "code")


_SAMPLE_DIGITS = ("log_income", "sqm_per_head", "work_hrs_100")
_SAMPLE_SQL = ", ".join(
    f"round({c}, 6) AS {c}" if c in _SAMPLE_DIGITS else c for c in CONTROLS_SQL.split(", ")
)


def _sample(master, design):
    rows = analysis_sample(master, design)
    return rounded(rows.select(design.required()), 6, *[c for c in _SAMPLE_DIGITS if c in design.regressors])


@query("sample_stage1", f"SELECT pid, syear, plb0097, {_SAMPLE_SQL}, sector FROM s1")
def sample_stage1(spark, sf_dir):
    return _sample(inputs.master(spark, sf_dir), sample.PREFERENCE)


@query("sample_stage2", f"SELECT pid, syear, plb0095_v1, {_SAMPLE_SQL}, sector FROM s2")
def sample_stage2(spark, sf_dir):
    return _sample(inputs.master(spark, sf_dir), sample.REALIZATION)


@query("sample_stage2_full", f"SELECT pid, syear, plb0095_v1, plb0097, {_SAMPLE_SQL}, sector FROM s2full")
def sample_stage2_full(spark, sf_dir):
    return _sample(inputs.master(spark, sf_dir), sample.REALIZATION_FULL)


_FE_SQL = ", ".join(f"round({c}, 6) AS {c}" if c in _SAMPLE_DIGITS else c for c in TIME_VARYING)


@query("sample_fe", f"""
    SELECT 'Preference' AS stage, pid, syear, plb0097 AS outcome, {_FE_SQL} FROM w1
    UNION ALL SELECT 'Realization', pid, syear, plb0095_v1, {_FE_SQL} FROM w2""")
def sample_fe(spark, sf_dir):
    master = inputs.stored_master(spark, sf_dir)
    first, second = (
        _sample(master, design).withColumnRenamed(design.outcome, "outcome").withColumn("stage", F.lit(name))
        for name, design in (("Preference", sample.PREFERENCE_WITHIN), ("Realization", sample.REALIZATION_WITHIN))
    )
    return first.unionByName(second)
