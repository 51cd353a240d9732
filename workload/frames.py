"""Survey datasets derived from the given tables.

One SQL text per dataset, run unchanged by Spark and by the checking engine. A
customer is a person, an order year a survey year, two neighbouring customers a
household. The values carry what real survey files carry: missing codes, both
versions of a question, both industry classifications, households of size 0,
incomes below 1, codes outside the classification, and person-years one source
knows and another does not: some orders count for the year after or before in
one dataset, as answers of a late or an early interview. Every row of the given
tables is used.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from panelweave.fixed_values import SECTORS
from panelweave.registry import Registry
from panelweave.sources.tables import clean_values, harmonise, typed_keys

STUDY_YEARS = (1996, 1997, 1998, 1999, 2000)
REGISTRY = Registry.default(study_years=STUDY_YEARS)

FRAMES = {
    "ppathl": """
SELECT pid, syear,
  CASE WHEN pid % 97 = 0 THEN -2 ELSE CAST((pid - pid % 2) / 2 AS BIGINT) END AS hid,
  1940 + CAST(pid % 50 AS INT) AS gebjahr,
  1 + CAST(pid % 2 AS INT) AS sex,
  CASE WHEN pid % 23 = 0 THEN -1 ELSE CAST((pid + syear) % 6 AS INT) END AS partner,
  CASE WHEN pid % 10 < 7 THEN 1 WHEN pid % 10 < 9 THEN 2 ELSE 3 END AS migback
FROM (SELECT DISTINCT o_custkey AS pid,
             CAST(year(o_orderdate) + CASE WHEN o_totalprice < 20000 THEN 1 ELSE 0 END AS INT) AS syear
      FROM {orders}) t""",
    "pl": """
SELECT pid, syear,
  CASE WHEN k % 13 = 0 THEN -1 WHEN k % 13 = 1 THEN -8
       WHEN k % 8 < 5 THEN 1 WHEN k % 8 < 7 THEN 2 ELSE 3 END AS plb0097,
  CASE WHEN k % 17 = 0 THEN -2 WHEN k % 7 < 3 THEN 1 ELSE 2 END AS plb0095_v1,
  CASE WHEN syear < 1998 THEN 1 + CAST(k % 2 AS INT) ELSE -5 END AS plb0193_v1,
  CASE WHEN syear >= 1998 THEN 1 + CAST(k % 2 AS INT) ELSE -5 END AS plb0193_v2,
  CASE WHEN k % 19 = 0 THEN -1 ELSE CAST(k % 11 AS INT) END AS plh0173
FROM (SELECT o_custkey AS pid,
             CAST(year(o_orderdate) + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS INT) AS syear,
             min(o_orderkey) AS k
      FROM {orders} GROUP BY 1, 2) t""",
    "pgen": """
SELECT pid, syear,
  1 + CAST(k % 6 AS INT) AS pgisced97,
  11 + CAST(k % 2 AS INT) AS pglfs,
  CASE WHEN k % 10 < 8 THEN 1 ELSE CAST(k % 10 AS INT) - 6 END AS pgemplst,
  CASE WHEN syear < 1999 THEN 1 + CAST(k % 99 AS INT) ELSE -8 END AS pgnace,
  CASE WHEN syear >= 1998 THEN 1 + CAST(k % 99 AS INT) ELSE -8 END AS pgnace2
FROM (SELECT o_custkey AS pid,
             CAST(year(o_orderdate) - CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INT) AS syear,
             max(o_orderkey) AS k
      FROM {orders} GROUP BY 1, 2) t""",
    "pequiv": """
SELECT o.o_custkey AS pid, CAST(year(o.o_orderdate) AS INT) AS syear,
  CAST(min(l.l_orderkey) % 5 AS INT) AS d11106,
  CAST(min(l.l_orderkey) % 4 AS INT) AS d11107,
  CAST(floor(max(o.o_totalprice) / 10) - 500 AS DOUBLE) AS i11102,
  CAST(max(c.c_nationkey) % 17 AS INT) AS l11101,
  sum(l.l_quantity) * 10 AS e11101
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
GROUP BY o.o_custkey, CAST(year(o.o_orderdate) AS INT)""",
    "hl": """
SELECT hid, syear,
  CASE WHEN (hid + syear) % 29 = 0 THEN -1 ELSE 30 + CAST((hid * 7 + syear) % 170 AS INT) END AS hlf0019_h
FROM (SELECT DISTINCT CAST((o_custkey - o_custkey % 2) / 2 AS BIGINT) AS hid,
             CAST(year(o_orderdate) + CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS INT) AS syear
      FROM {orders}) t""",
    # answers as text, the way survey files hold them
    "answers": """
SELECT o_orderkey AS id, o_custkey AS pid, CAST(year(o_orderdate) AS INT) AS syear,
  CASE CAST(o_orderkey % 9 AS INT)
    WHEN 0 THEN concat(CAST(o_orderkey AS VARCHAR(20)), 'd')
    WHEN 1 THEN concat('  ', CAST(o_orderkey % 50 AS VARCHAR(20)), ' ')
    WHEN 2 THEN o_orderpriority
    WHEN 3 THEN concat(CAST(o_orderkey % 7 AS VARCHAR(20)), 'e3')
    WHEN 4 THEN 'nan'
    WHEN 5 THEN ''
    WHEN 6 THEN CAST(o_custkey % 12 - 9 AS VARCHAR(20))
    WHEN 7 THEN '-1.5'
    ELSE concat('.', CAST(o_orderkey % 100 AS VARCHAR(20))) END AS answer
FROM {orders}""",
    # a codebook with one variable per part
    "codebook_variables": """
SELECT 'survey' AS study, lower(p_brand) AS dataset, '1' AS version,
  concat('V', CAST(p_partkey AS VARCHAR(20))) AS variable,
  CASE WHEN p_partkey % 13 = 0 THEN '' ELSE concat(p_name, ' ', p_type) END AS label,
  concat('DE ', p_name) AS label_de,
  lower(p_brand) AS source, p_partkey AS position
FROM {part}""",
    # one labelled value per order line, codes from line numbers and quantities
    "codebook_values": """
SELECT 'survey' AS study, lower(p.p_brand) AS dataset, '1' AS version,
  concat('V', CAST(l.l_partkey AS VARCHAR(20))) AS variable,
  CASE WHEN l.l_linenumber = 7 THEN 'n/a'
       ELSE CAST(CAST(l.l_quantity AS INT) - 8 AS VARCHAR(20)) END AS value,
  CASE WHEN l.l_returnflag = 'R' THEN ''
       ELSE concat(l.l_returnflag, ' ', CAST(l.l_orderkey AS VARCHAR(20))) END AS label,
  CASE WHEN l.l_linestatus = 'O' THEN concat('DE ', CAST(l.l_orderkey AS VARCHAR(20))) ELSE '' END AS label_de,
  lower(p.p_brand) AS source, l.l_orderkey * 10 + l.l_linenumber AS position
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey""",
}

TABLES = ("orders", "lineitem", "customer", "part")


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the handle is kept so that its schema is read once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived dataset, raw."""
    text = FRAMES[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def dataset(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived dataset, cleaned and harmonised the way an extracted file is."""
    key = REGISTRY.entity_key(name)
    raw = frame(spark, sf_dir, name)
    return harmonise(clean_values(typed_keys(raw, key), key), REGISTRY, name)


def person_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [dataset(spark, sf_dir, name) for name in ("ppathl", "pl", "pgen", "pequiv")]


def household_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [dataset(spark, sf_dir, "hl")]


# -- the same steps in SQL, as named subqueries for the checks ---------------------------

def _cleaned(column: str) -> str:
    return f"CASE WHEN {column} NOT IN (-8,-7,-6,-5,-4,-3,-2,-1) THEN CAST({column} AS DOUBLE) END"


def _sector_case(column: str, which: int) -> str:
    branches = " ".join(f"WHEN {column} IN ({", ".join(map(str, row[which]))}) THEN {row[0]}" for row in SECTORS)
    return f"CASE {branches} END"


_YEARS = ", ".join(str(y) for y in STUDY_YEARS)

CONTROLS_SQL = (
    "age, sex, migback_direct, migback_indirect, has_partner, pgisced97, log_income, "
    "has_children, sqm_per_head, work_hrs_100, plb0193_h, plh0173"
)
VARYING_SQL = (
    "age, has_partner, pgisced97, log_income, has_children, sqm_per_head, work_hrs_100, plb0193_h, plh0173"
)


def _complete(columns: str) -> str:
    return " AND ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(","))


SUBQUERIES = {
    **{name: text.format(**{t: t for t in TABLES}) for name, text in FRAMES.items()},
    "c_ppathl": f"""SELECT pid, syear, CASE WHEN hid NOT IN (-8,-7,-6,-5,-4,-3,-2,-1) THEN hid END AS hid,
        {_cleaned('gebjahr')} AS gebjahr, {_cleaned('sex')} AS sex, {_cleaned('partner')} AS partner,
        {_cleaned('migback')} AS migback FROM ppathl""",
    "c_pl": f"""SELECT pid, syear, {_cleaned('plb0097')} AS plb0097, {_cleaned('plb0095_v1')} AS plb0095_v1,
        {_cleaned('plh0173')} AS plh0173,
        CAST(coalesce(CASE plb0193_v1 WHEN 1 THEN 1 WHEN 2 THEN 0 END,
                      CASE plb0193_v2 WHEN 1 THEN 1 WHEN 2 THEN 0 END) AS DOUBLE) AS plb0193_h FROM pl""",
    "c_pgen": f"""SELECT pid, syear, {_cleaned('pgisced97')} AS pgisced97, {_cleaned('pglfs')} AS pglfs,
        {_cleaned('pgemplst')} AS pgemplst, {_cleaned('pgnace')} AS pgnace, {_cleaned('pgnace2')} AS pgnace2
        FROM pgen""",
    "c_pequiv": f"""SELECT pid, syear, {_cleaned('d11106')} AS d11106, {_cleaned('d11107')} AS d11107,
        {_cleaned('i11102')} AS i11102, {_cleaned('l11101')} AS l11101, {_cleaned('e11101')} AS e11101
        FROM pequiv""",
    "c_hl": f"SELECT hid, syear, {_cleaned('hlf0019_h')} AS hlf0019_h FROM hl",
    "person": """SELECT * FROM c_ppathl FULL JOIN c_pl USING (pid, syear)
        FULL JOIN c_pgen USING (pid, syear) FULL JOIN c_pequiv USING (pid, syear)""",
    "panel": "SELECT * FROM person LEFT JOIN c_hl USING (hid, syear)",
    "derived": f"""SELECT pid, syear, hid, partner, migback, plh0173, plb0193_h, pgisced97, pglfs, pgemplst,
        d11106, d11107, i11102, l11101, e11101, hlf0019_h,
        CASE WHEN sex = 1 THEN 0.0 WHEN sex = 2 THEN 1.0 ELSE sex END AS sex,
        CASE WHEN plb0097 = 2 THEN 0.0 ELSE plb0097 END AS plb0097,
        CASE WHEN plb0095_v1 = 2 THEN 0.0 ELSE plb0095_v1 END AS plb0095_v1,
        CASE WHEN d11106 > 0 THEN hlf0019_h / d11106 END AS sqm_per_head,
        syear - gebjahr AS age,
        coalesce({_sector_case('pgnace', 2)}, {_sector_case('pgnace2', 3)}) AS sector
        FROM panel""",
    "master": f"SELECT * FROM derived WHERE pgemplst = 1 AND syear IN ({_YEARS})",
    "prep": """SELECT * REPLACE (CAST(sector AS DOUBLE) AS sector),
        e11101 / 100 AS work_hrs_100, CAST(d11107 > 0 AS DOUBLE) AS has_children,
        CASE WHEN i11102 IS NOT NULL THEN ln(CASE WHEN i11102 > 1 THEN i11102 ELSE 1 END) END AS log_income,
        CAST(migback = 2 AS DOUBLE) AS migback_direct, CAST(migback = 3 AS DOUBLE) AS migback_indirect,
        CAST(partner IN (1, 2, 3, 4) AS DOUBLE) AS has_partner FROM master""",
    "s1": f"SELECT * FROM prep WHERE plb0097 IN (0, 1) AND {_complete(CONTROLS_SQL)} AND sector IS NOT NULL",
    "s2": f"""SELECT * FROM prep WHERE plb0097 = 1 AND plb0095_v1 IN (0, 1)
        AND {_complete(CONTROLS_SQL)} AND sector IS NOT NULL""",
    "s2full": f"""SELECT * FROM prep WHERE plb0097 IN (0, 1) AND plb0095_v1 IN (0, 1)
        AND {_complete(CONTROLS_SQL)} AND sector IS NOT NULL""",
    "w1": f"SELECT * FROM prep WHERE plb0097 IN (0, 1) AND {_complete(VARYING_SQL)}",
    "w2": f"SELECT * FROM prep WHERE plb0097 = 1 AND plb0095_v1 IN (0, 1) AND {_complete(VARYING_SQL)}",
}


def check_sql(select: str) -> str:
    """Full check text: the subqueries above, those of ``select`` itself, then its body."""
    # read several times by some checks
    kept = ("derived", "s1", "s2")
    ctes = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in kept else ''}({text})" for name, text in SUBQUERIES.items()
    )
    select = select.strip()
    more = select.startswith("WITH ")
    return f"WITH RECURSIVE {ctes}{',' if more else ''}\n{select.removeprefix('WITH ')}"
