"""Descriptive tables, shares, panel structure and single-variable statistics."""

from functools import reduce

from pyspark.sql import functions as F

from panelweave.fixed_values import STATES
from panelweave.operators import describe, panel, sample, shares, states
from panelweave.operators.quantiles import quantiles_by
from panelweave.operators.sample import PREFERENCE, REALIZATION, analysis_sample
from panelweave.plans import master as plans
from panelweave.session import stage
from workload import inputs
from workload.catalog import query, rounded
from workload.frames import REGISTRY, STUDY_YEARS
from workload.joining import REGION_SQL

VARIABLES = [v for v in REGISTRY.all_variables()]
NAMES = [v.name for v in VARIABLES]
CATEGORICAL = [v.name for v in VARIABLES if v.kind == "categorical"]


def long_sql(source: str, names=NAMES) -> str:
    """One row per variable and person-year, missing codes removed."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS variable, syear, CASE WHEN CAST({n} AS DOUBLE) NOT IN "
        f"(-8,-7,-6,-5,-4,-3,-2,-1) THEN CAST({n} AS DOUBLE) END AS value FROM {source}"
        for n in names
    )


def summary_sql(source: str) -> str:
    return f"""SELECT variable, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd,
        min(value) AS min, max(value) AS max FROM ({long_sql(source)}) GROUP BY variable"""


def distribution_sql(source: str) -> str:
    return f"""SELECT variable, CASE WHEN count(*) > 5 THEN '--' ELSE
          string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR) || ':' || format('{{:.0f}}', n * 100.0 / total) || '%',
                     ' / ' ORDER BY value) END AS distribution
        FROM (SELECT variable, value, count(*) AS n, sum(count(*)) OVER (PARTITION BY variable) AS total
              FROM ({long_sql(source, CATEGORICAL)}) WHERE value IS NOT NULL GROUP BY variable, value)
        GROUP BY variable"""


@query("var_summary", f"""
    SELECT variable, n, round(mean, 6) AS mean, round(sd, 6) AS sd, min, max FROM ({summary_sql('master')})""")
def var_summary(spark, sf_dir):
    return rounded(describe.summarise(inputs.master(spark, sf_dir), NAMES), 6, "mean", "sd")


@query("n_by_year", f"""
    SELECT variable, syear, count(value) AS n FROM ({long_sql('master')}) GROUP BY variable, syear""")
def n_by_year(spark, sf_dir):
    return describe.count_by_year(inputs.master(spark, sf_dir), NAMES)


@query("category_distribution", distribution_sql("master"))
def category_distribution(spark, sf_dir):
    return describe.category_distribution(inputs.master(spark, sf_dir), CATEGORICAL)


@query("sample_n", f"SELECT max(n) AS n FROM ({summary_sql('s1')})")
def sample_n(spark, sf_dir):
    sample_1 = analysis_sample(inputs.master(spark, sf_dir), PREFERENCE)
    return describe.sample_n(describe.summarise(sample_1, NAMES))


def cells_sql(source: str, digits: int) -> str:
    return f"""SELECT s.variable, s.n,
          CASE WHEN s.n = 0 OR k.kind = 'id' THEN '--'
               WHEN k.kind = 'categorical' THEN coalesce(d.distribution, '--')
               ELSE printf('%.{digits}f', s.mean) END AS mean_text,
          CASE WHEN s.n = 0 OR k.kind <> 'continuous' THEN '--' ELSE printf('%.{digits}f', s.sd) END AS sd_text
        FROM ({summary_sql(source)}) s JOIN ({REGISTRY_SQL}) k USING (variable)
        LEFT JOIN ({distribution_sql(source)}) d USING (variable)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_HARMONISED = {h.name for h in REGISTRY.harmonised}
REGISTRY_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {_quoted(label)}, {j}, '{v.name}', {_quoted(v.label)}, {_quoted(v.scale)}, '{v.kind}', "
    f"{str(v.name in _HARMONISED).lower()}, {str(bool(v.note)).lower()})"
    for i, (key, label) in enumerate(REGISTRY.panels) for j, v in enumerate(REGISTRY.variables[key])
) + ") r(panel_no, panel, variable_no, variable, label, scale, kind, harmonised, has_note)"


@query("descriptive_table", f"""
    SELECT r.*, a.n AS n_1, a.mean_text AS mean_1, a.sd_text AS sd_1,
           b.n AS n_2, b.mean_text AS mean_2, b.sd_text AS sd_2
    FROM ({REGISTRY_SQL}) r JOIN ({cells_sql('s1', 2)}) a USING (variable) JOIN ({cells_sql('s2', 2)}) b USING (variable)
    WHERE a.n > 0 OR b.n > 0""")
def descriptive_table(spark, sf_dir):
    master = inputs.stored_master(spark, sf_dir)
    return describe.descriptive_table(
        analysis_sample(master, PREFERENCE), analysis_sample(master, REALIZATION), REGISTRY
    )


@query("descriptive_states", f"""
    SELECT r.*, a.n AS n_1, a.mean_text AS mean_1, a.sd_text AS sd_1,
           b.n AS n_2, b.mean_text AS mean_2, b.sd_text AS sd_2
    FROM ({REGISTRY_SQL}) r JOIN ({cells_sql('s1', 2)}) a USING (variable) JOIN ({cells_sql('s2', 2)}) b USING (variable)
    WHERE a.n > 0 OR b.n > 0""")
def descriptive_states(spark, sf_dir):
    """The descriptive table of both samples from one pass over the model frame."""
    samples = {"Preference": sample.in_sample(PREFERENCE), "Realization": sample.in_sample(REALIZATION)}
    return states.descriptive_table(inputs.model_frame(spark, sf_dir), samples, REGISTRY)


@query("summary_states", " UNION ALL ".join(f"""
    SELECT '{name}' AS sample, variable, syear, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd,
           min(value) AS min, max(value) AS max FROM ({long_sql(source)}) GROUP BY variable, syear
    UNION ALL SELECT '{name}', variable, NULL, n, round(mean, 6), round(sd, 6), min, max FROM ({summary_sql(source)})"""
    for name, source in (("Preference", "s1"), ("Realization", "s2"))))
def summary_states(spark, sf_dir):
    """Totals and years of two samples, merged from the same states."""
    samples = {"Preference": sample.in_sample(PREFERENCE), "Realization": sample.in_sample(REALIZATION)}
    found = states.moment_states(inputs.model_frame(spark, sf_dir), NAMES, CATEGORICAL, samples)
    years = states.summary(found, ["syear"])
    seen = found.where("rows > 0").select("sample", "syear").distinct()
    totals = states.summary(found).withColumn("syear", F.lit(None).cast("int"))
    return rounded(years.join(seen, ["sample", "syear"], "left_semi").unionByName(totals), 6, "mean", "sd")


_YEAR_N = ", ".join(
    f"CAST(coalesce(sum(n) FILTER (WHERE syear = {y}), 0) AS BIGINT) AS n_{y}" for y in STUDY_YEARS
)
_YEAR_MAX = ", ".join(f"max(n_{y})" for y in STUDY_YEARS)
_YEAR_COLUMNS = ", ".join(f"y.n_{y}" for y in STUDY_YEARS)


_APPENDIX_SQL = f"""
    WITH rows_ AS (
      SELECT r.panel_no, r.variable_no, r.variable, {_YEAR_COLUMNS}, c.n, c.mean_text, c.sd_text
      FROM ({REGISTRY_SQL}) r JOIN ({cells_sql('master', 3)}) c USING (variable)
      JOIN (SELECT variable, {_YEAR_N} FROM (
              SELECT variable, syear, count(value) AS n FROM ({long_sql('master')}) GROUP BY variable, syear)
            GROUP BY variable) y USING (variable)
      WHERE c.n > 0)
    SELECT * FROM rows_ UNION ALL
    SELECT {len(REGISTRY.panels)}, 0, 'N', {_YEAR_MAX}, max(n), '--', '--' FROM rows_"""


@query("appendix_states", _APPENDIX_SQL)
def appendix_states(spark, sf_dir):
    """The appendix table from one pass."""
    return states.appendix_table(inputs.master(spark, sf_dir), REGISTRY)


@query("appendix_by_year", _APPENDIX_SQL)
def appendix_by_year(spark, sf_dir):
    return describe.appendix_table(inputs.stored_master(spark, sf_dir), REGISTRY)


@query("share_by_year", """
    SELECT syear,
      round(count(*) FILTER (WHERE plb0097 = 1) / greatest(count(*) FILTER (WHERE plb0097 IN (0, 1)), 1), 6)
        AS share_willing,
      round(count(*) FILTER (WHERE plb0095_v1 = 1) / greatest(count(*) FILTER (WHERE plb0095_v1 IN (0, 1)), 1), 6)
        AS share_actual
    FROM master GROUP BY syear""")
def share_by_year(spark, sf_dir):
    columns = {"plb0097": "share_willing", "plb0095_v1": "share_actual"}
    return rounded(
        shares.share_by_year(inputs.master(spark, sf_dir), columns), 6, "share_willing", "share_actual"
    )


STATE_CASE = "CASE " + " ".join(f"WHEN l11101 = {code} THEN '{name}'" for code, name, _ in STATES) + " END"


@query("share_by_region", f"""
    SELECT l11101, round(share, 6) AS plb0097, {STATE_CASE} AS state_name FROM ({REGION_SQL})""")
def share_by_region(spark, sf_dir):
    names = {code: name for code, name, _ in STATES}
    return rounded(
        shares.share_by_region(inputs.master(spark, sf_dir), STUDY_YEARS, "plb0097", "l11101", names), 6, "plb0097"
    )


def _stages(spark, sf_dir):
    master = inputs.stored_master(spark, sf_dir)
    return master, {
        "Preference": analysis_sample(master, PREFERENCE),
        "Realization": analysis_sample(master, REALIZATION),
    }


def _size_sql(name, source):
    return f"""SELECT '{name}' AS stage, CAST(sum(n) AS BIGINT) AS observations, count(*) AS individuals,
        round(avg(n), 6) AS mean_obs, min(n) AS min_obs, max(n) AS max_obs,
        (SELECT count(DISTINCT syear) FROM master) AS waves,
        round(sum(n) / (count(*) * (SELECT count(DISTINCT syear) FROM master)), 6) AS balance
      FROM (SELECT pid, count(*) AS n FROM {source} GROUP BY pid)"""


@query("panel_metadata", _size_sql("Preference", "s1") + " UNION ALL " + _size_sql("Realization", "s2"))
def panel_metadata(spark, sf_dir):
    master, stages = _stages(spark, sf_dir)
    first, second = (
        rounded(panel.panel_size(df, master), 6, "mean_obs", "balance").withColumn("stage", F.lit(name))
        for name, df in stages.items()
    )
    return first.unionByName(second)


def _histogram_sql(name, source):
    return f"""SELECT '{name}' AS stage, waves, count(*) AS persons,
        round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
      FROM (SELECT pid, count(*) AS waves FROM {source} GROUP BY pid) GROUP BY waves"""


@query("wave_histogram", _histogram_sql("Preference", "s1") + " UNION ALL " + _histogram_sql("Realization", "s2"))
def wave_histogram(spark, sf_dir):
    _, stages = _stages(spark, sf_dir)
    first, second = (
        rounded(panel.wave_histogram(df), 6, "percent").withColumn("stage", F.lit(name))
        for name, df in stages.items()
    )
    return first.unionByName(second)


_STRUCTURE_SQL = " UNION ALL ".join(f"""
    SELECT '{name}' AS stage, 'size' AS part, item, value FROM (
      SELECT unnest(['observations', 'individuals', 'mean_obs', 'min_obs', 'max_obs', 'waves', 'balance']) AS item,
             unnest([observations, individuals, mean_obs, min_obs, max_obs, waves, balance]) AS value FROM ({_size_sql(name, source)}))
    UNION ALL SELECT '{name}', 'histogram', CAST(waves AS VARCHAR), CAST(persons AS DOUBLE) FROM ({_histogram_sql(name, source)})
    UNION ALL SELECT '{name}', 'year', CAST(syear AS VARCHAR), NULL FROM (SELECT DISTINCT syear FROM {source})
    UNION ALL SELECT '{name}', 'pattern', pattern, CAST(count(*) AS DOUBLE) FROM (
      SELECT s.pid, string_agg(CASE WHEN p.pid IS NULL THEN '0' ELSE '1' END, '' ORDER BY y.syear) AS pattern
      FROM (SELECT DISTINCT pid FROM {source}) s
      CROSS JOIN (SELECT unnest(generate_series(min(syear), max(syear))) AS syear FROM {source}) y
      LEFT JOIN (SELECT DISTINCT pid, syear FROM {source}) p ON p.pid = s.pid AND p.syear = y.syear GROUP BY s.pid)
    GROUP BY pattern""" for name, source in (("Preference", "s1"), ("Realization", "s2")))


@query("panel_structure", _STRUCTURE_SQL)
def panel_structure(spark, sf_dir):
    """Sizes, histogram, years and participation of both samples, all from patterns of waves."""
    master, stages = _stages(spark, sf_dir)
    possible = panel.wave_patterns(master)
    parts = []
    for name, df in stages.items():
        patterns = stage(panel.wave_patterns(df), "patterns")
        size = rounded(panel.pattern_size(patterns, possible), 6, "mean_obs", "balance")
        items = F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in size.columns))
        rows = {
            "size": size.select(F.inline(items)),
            "histogram": panel.pattern_histogram(patterns).select(F.col("waves").cast("string").alias("item"), F.col("persons").cast("double").alias("value")),
            "year": panel.pattern_years(patterns).select(F.col("syear").cast("string").alias("item"), F.lit(None).cast("double").alias("value")),
            "pattern": panel.participation(patterns).select(F.col("pattern").alias("item"), F.col("persons").cast("double").alias("value")),
        }
        parts += [df.select(F.lit(name).alias("stage"), F.lit(part).alias("part"), "item", "value") for part, df in rows.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _five_sql(variable, source):
    quartiles = " ".join(
        f"UNION ALL SELECT {6 - 2 + i}, '{q}%', quantile_cont({variable}, {q / 100}) FROM {source}"
        for i, q in enumerate((25, 50, 75), 1)
    )
    return f"""SELECT 1 AS position, 'count' AS statistic, CAST(count({variable}) AS DOUBLE) AS value FROM {source}
      UNION ALL SELECT 2, 'mean', avg({variable}) FROM {source}
      UNION ALL SELECT 3, 'std', stddev_samp({variable}) FROM {source}
      UNION ALL SELECT 4, 'min', min({variable}) FROM {source} {quartiles}
      UNION ALL SELECT 8, 'max', max({variable}) FROM {source}"""


@query("variable_quartiles", f"SELECT position, statistic, round(value, 6) AS value FROM ({_five_sql('i11102', 'panel')})")
def variable_quartiles(spark, sf_dir):
    return rounded(describe.five_numbers(inputs.panel(spark, sf_dir), "i11102"), 6, "value")


CONTINUOUS = [v.name for v in VARIABLES if v.kind == "continuous"]


@query("quartiles_by_year", " UNION ALL ".join(f"""
    SELECT syear, variable, count(value) AS n, {q}::DOUBLE AS q, round(quantile_cont(value, {q}), 6) AS value
    FROM ({long_sql('master', CONTINUOUS)}) WHERE value IS NOT NULL GROUP BY syear, variable""" for q in (0.1, 0.25, 0.5, 0.75, 0.9)))
def quartiles_by_year(spark, sf_dir):
    """Quantiles of every continuous variable in every year, exact, from two scans."""
    found = quantiles_by(inputs.stored_master(spark, sf_dir), CONTINUOUS, (0.1, 0.25, 0.5, 0.75, 0.9), ["syear"])
    return rounded(found, 6, "value")


@query("stats_by_year", """
    SELECT syear, count(plh0173) AS n, round(avg(plh0173), 6) AS mean, round(stddev_samp(plh0173), 6) AS std
    FROM panel WHERE plh0173 IS NOT NULL GROUP BY syear""")
def stats_by_year(spark, sf_dir):
    return rounded(describe.stats_by_year(inputs.panel(spark, sf_dir), "plh0173"), 6, "mean", "std")


@query("missing_rate", """
    SELECT count(*) AS total, count(plb0097) AS valid, count(*) - count(plb0097) AS missing,
           round((count(*) - count(plb0097)) * 100.0 / count(*), 6) AS missing_pct FROM panel""")
def missing_rate(spark, sf_dir):
    return rounded(describe.missing_rate(inputs.panel(spark, sf_dir), "plb0097"), 6, "missing_pct")


@query("distinct_people", """
    SELECT 'Preference' AS stage, count(*) AS observations, count(DISTINCT pid) AS individuals FROM s1
    UNION ALL SELECT 'Realization', count(*), count(DISTINCT pid) FROM s2""")
def distinct_people(spark, sf_dir):
    _, stages = _stages(spark, sf_dir)
    first, second = (
        describe.distinct_people(df).withColumn("stage", F.lit(name)) for name, df in stages.items()
    )
    return first.unionByName(second)


@query("category_coverage", "SELECT count(sector) AS non_null, count(DISTINCT sector) AS categories FROM derived")
def category_coverage(spark, sf_dir):
    everyone = inputs.panel(spark, sf_dir).transform(plans.derived_panel, REGISTRY)
    return describe.category_coverage(everyone, "sector")


_YEARS = ", ".join(map(str, STUDY_YEARS))


@query("sample_funnel", f"""
    WITH t AS (SELECT count(*) AS n0, count(*) FILTER (WHERE pgemplst = 1) AS n1,
        count(*) FILTER (WHERE pgemplst = 1 AND syear IN ({_YEARS})) AS n2,
        count(*) FILTER (WHERE pgemplst = 1 AND syear IN ({_YEARS}) AND plb0097 IN (0, 1)) AS n3,
        count(*) FILTER (WHERE pgemplst = 1 AND syear IN ({_YEARS}) AND plb0097 IN (0, 1) AND sector IS NOT NULL)
          AS n4 FROM derived)
    SELECT 0 AS step_no, 'all rows' AS step, n0 AS rows_before, 0 AS rows_removed, n0 AS rows_after FROM t
    UNION ALL SELECT 1, 'full-time', n0, n0 - n1, n1 FROM t
    UNION ALL SELECT 2, 'study years', n1, n1 - n2, n2 FROM t
    UNION ALL SELECT 3, 'yes or no answer', n2, n2 - n3, n3 FROM t
    UNION ALL SELECT 4, 'sector known', n3, n3 - n4, n4 FROM t""")
def sample_funnel(spark, sf_dir):
    everyone = inputs.panel(spark, sf_dir).transform(plans.derived_panel, REGISTRY)
    return sample.funnel(everyone, {
        "full-time": F.col("pgemplst") == 1,
        "study years": F.col("syear").isin(*STUDY_YEARS),
        "yes or no answer": sample.valid("plb0097"),
        "sector known": F.col("sector").isNotNull(),
    })


@query("period_label", "SELECT CAST(min(syear) AS VARCHAR) || '–' || CAST(max(syear) AS VARCHAR) AS period FROM master")
def period_label(spark, sf_dir):
    return describe.period_label(inputs.master(spark, sf_dir))


@query("distinct_years", "SELECT DISTINCT syear FROM panel")
def distinct_years(spark, sf_dir):
    return describe.distinct_years(inputs.panel(spark, sf_dir))
