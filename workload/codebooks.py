"""Codebook searches and variable profiles."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from panelweave.operators import codebook, label_index
from panelweave.session import stage_folder
from panelweave.sources import codebook as codebook_files
from workload import inputs
from workload.catalog import query
from workload.describing import _five_sql
from workload.frames import frame, table

TEXT_SQL = "lower(concat_ws(' ', variable, label))"
PREFERRED = ("brand#3", "brand#7")


@query("search_all_terms", f"""
    SELECT dataset, variable, label, label_de FROM codebook_variables
    WHERE contains({TEXT_SQL}, 'ring') AND contains({TEXT_SQL}, 'econ')""")
def search_all_terms(spark, sf_dir):
    return codebook.search_variables(frame(spark, sf_dir, "codebook_variables"), "RING econ")


@query("search_any_term", f"""
    SELECT dataset, variable, label, label_de FROM codebook_variables
    WHERE contains({TEXT_SQL}, 'red') OR contains({TEXT_SQL}, 'v12') OR contains({TEXT_SQL}, 'promo')""")
def search_any_term(spark, sf_dir):
    return codebook.search_variables(frame(spark, sf_dir, "codebook_variables"), "red V12 promo", match_any=True)


INDEXED = (("RING econ", False), ("red V12 promo", True), ("brush el", False), ("steel anodized tin", True))


@query("search_index", " UNION ALL ".join(f"""
    SELECT '{terms}' AS query, dataset, variable, label, label_de FROM codebook_variables
    WHERE {(' OR ' if any_ else ' AND ').join(f"contains({TEXT_SQL}, '{t}')" for t in terms.lower().split())}""" for terms, any_ in INDEXED))
def search_index(spark, sf_dir):
    """Searches for all and for any of some words by the lists of their trigrams."""
    folder = f"{stage_folder(spark)}/labels-{uuid.uuid4().hex}"
    label_index.build(frame(spark, sf_dir, "codebook_variables"), folder)
    found = [label_index.search(spark, folder, terms, match_any=any_).withColumn("query", F.lit(terms)) for terms, any_ in INDEXED]
    return reduce(lambda a, b: a.unionByName(b), found).select("query", "dataset", "variable", "label", "label_de")


@query("value_labels", """
    SELECT dataset, variable, value, label, label_de, CASE WHEN label <> '' THEN label ELSE label_de END AS shown
    FROM codebook_values""")
def value_labels(spark, sf_dir):
    return codebook.shown_labels(frame(spark, sf_dir, "codebook_values")).select(
        "dataset", "variable", "value", "label", "label_de", "shown"
    )


LABEL_MAP_SQL = """
    SELECT dataset, variable, code, arg_max(shown, position) AS label FROM (
      SELECT dataset, variable, position, CASE WHEN label <> '' THEN label ELSE label_de END AS shown,
             CASE WHEN regexp_matches(value, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(value AS BIGINT) END AS code
      FROM codebook_values)
    WHERE code IS NOT NULL AND shown <> '' GROUP BY dataset, variable, code"""


@query("value_label_map", LABEL_MAP_SQL)
def value_label_map(spark, sf_dir):
    return codebook.label_map(frame(spark, sf_dir, "codebook_values"), ["dataset", "variable"])


@query("scale_bounds", f"""
    SELECT dataset, variable, min(code) AS low, arg_min(label, code) AS low_label, max(code) AS high,
           arg_max(label, code) AS high_label
    FROM ({LABEL_MAP_SQL}) WHERE code >= 0 GROUP BY dataset, variable""")
def scale_bounds(spark, sf_dir):
    labels = codebook.label_map(frame(spark, sf_dir, "codebook_values"), ["dataset", "variable"])
    return codebook.scale_bounds(labels, ["dataset", "variable"])


@query("first_dataset_match", f"""
    SELECT lower(label_de) AS name, dataset FROM codebook_variables
    QUALIFY row_number() OVER (PARTITION BY lower(label_de)
      ORDER BY CASE WHEN source IN {PREFERRED} THEN 0 ELSE 1 END, source, position) = 1""")
def first_dataset_match(spark, sf_dir):
    """First dataset per German label: many variables share one, so there is a choice to make."""
    named = frame(spark, sf_dir, "codebook_variables").withColumn("name", F.lower("label_de"))
    return codebook.first_dataset(named, PREFERRED, ["name"])


@query("variable_profile", f"""
    SELECT 'missing' AS part, 'total' AS item, CAST(count(*) AS DOUBLE) AS value FROM panel
    UNION ALL SELECT 'missing', 'valid', count(e11101) FROM panel
    UNION ALL SELECT 'missing', 'missing', count(*) - count(e11101) FROM panel
    UNION ALL SELECT 'missing', 'missing_pct', round((count(*) - count(e11101)) * 100.0 / count(*), 6) FROM panel
    UNION ALL SELECT 'statistics', statistic, round(value, 6) FROM ({_five_sql('e11101', 'panel')})
    UNION ALL SELECT 'n', CAST(syear AS VARCHAR), count(*) FROM panel WHERE e11101 IS NOT NULL GROUP BY syear
    UNION ALL SELECT 'mean', CAST(syear AS VARCHAR), round(avg(e11101), 6) FROM panel WHERE e11101 IS NOT NULL GROUP BY syear
    UNION ALL SELECT 'std', CAST(syear AS VARCHAR), round(stddev_samp(e11101), 6) FROM panel
      WHERE e11101 IS NOT NULL GROUP BY syear
    UNION ALL (WITH m AS ({LABEL_MAP_SQL})
      SELECT 'scale', min(code) || ' ' || arg_min(label, code) || ' to ' || max(code) || ' ' || arg_max(label, code), NULL
      FROM m WHERE variable = 'V7' AND code >= 0)""")
def variable_profile(spark, sf_dir):
    """All parts of a profile; the labels are those of a codebook variable."""
    labels = codebook.label_map(frame(spark, sf_dir, "codebook_values").filter("variable = 'V7'"), [])
    parts = codebook.profile(inputs.panel(spark, sf_dir), "e11101", labels)
    missing = parts["missing"].select(F.lit("missing").alias("part"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("item"), F.round(F.col(c).cast("double"), 6).alias("value"))
        for c in ("total", "valid", "missing", "missing_pct")
    ])))
    statistics = parts["statistics"].select(
        F.lit("statistics").alias("part"), F.col("statistic").alias("item"), F.round("value", 6).alias("value")
    )
    by_year = parts["by_year"].select(F.col("syear").cast("string").alias("item"), F.inline(F.array(
        F.struct(F.lit("n").alias("part"), F.col("n").cast("double").alias("value")),
        F.struct(F.lit("mean").alias("part"), F.round("mean", 6).alias("value")),
        F.struct(F.lit("std").alias("part"), F.round("std", 6).alias("value")),
    )))
    ends = F.format_string("%d %s to %d %s", "low", "low_label", "high", "high_label")
    scale = parts["scale"].select(F.lit("scale").alias("part"), ends.alias("item"), F.lit(None).cast("double").alias("value"))
    return missing.unionByName(statistics).unionByName(by_year).unionByName(scale)


ODD_LABEL = """CASE WHEN l_linenumber % 3 = 0 THEN concat('two', chr(10), 'lines, "', l_returnflag, '"')
    WHEN l_linenumber % 3 = 1 AND l_orderkey % 97 = 0 THEN repeat('""x', 7000) ELSE l_linestatus END"""


def _codebook_files(spark, sf_dir):
    """Value files as a survey ships them: quotes, line breaks and long labels in quotes, rows of other lengths."""
    folder = f"{stage_folder(spark)}/codebook-{uuid.uuid4().hex}"
    rows = spark.sql(f"""
        SELECT lower(concat('book', CAST(l_suppkey % 3 AS STRING))) AS source, l_suppkey % 5 AS fields,
               concat('V', CAST(l_partkey % 50 AS STRING)) AS variable, CAST(l_linenumber AS STRING) AS value,
               {ODD_LABEL} AS label, concat('DE ', CAST(l_orderkey AS STRING)) AS label_de
        FROM {{lineitem}}""", lineitem=table(spark, sf_dir, "lineitem"))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
    start = F.concat_ws(",", F.lit("s"), "source", F.lit("1"), "variable", "value")
    line = F.when(F.col("fields") == 0, start).when(F.col("fields") == 1, F.concat_ws(",", start, quoted("label"))).otherwise(
        F.concat_ws(",", start, quoted("label"), quoted("label_de")))
    for source in ("book0", "book1", "book2"):
        rows.filter(F.col("source") == source).select(line.alias("value")).write.text(f"{folder}/{source}_values.csv")
    return folder


ODD_ROWS_SQL = f"""SELECT lower('book' || l_suppkey % 3) AS dataset, 'V' || l_partkey % 50 AS variable,
    l_linenumber::VARCHAR AS value, {ODD_LABEL} AS label, CASE WHEN l_suppkey % 5 = 1 THEN '' ELSE concat('DE ', l_orderkey) END AS label_de
    FROM lineitem WHERE l_suppkey % 5 <> 0"""


@query("codebook_scan", f"""
    SELECT dataset, variable, value, md5(label) AS label, label_de, count(*) AS n FROM ({ODD_ROWS_SQL}) GROUP BY ALL""")
def codebook_scan(spark, sf_dir):
    book = codebook_files.read_values(spark, _codebook_files(spark, sf_dir))
    return book.groupBy("dataset", "variable", "value", F.md5("label").alias("label"), "label_de").agg(F.count("*").alias("n"))


@query("value_labels_of_one", f"""
    SELECT dataset, value, md5(label) AS label, label_de, count(*) AS n FROM ({ODD_ROWS_SQL}) WHERE variable = 'V13' GROUP BY ALL""")
def value_labels_of_one(spark, sf_dir):
    """The values of one variable, straight from the files."""
    values = codebook_files.read_values(spark, _codebook_files(spark, sf_dir))
    return codebook.value_labels(values, "v13").groupBy("dataset", "value", F.md5("label").alias("label"), "label_de").agg(
        F.count("*").alias("n"))


@query("value_label_map_of_one", """
    SELECT code, arg_max(CASE WHEN label <> '' THEN label ELSE label_de END, position) AS label FROM (
      SELECT *, CASE WHEN regexp_matches(value, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(value AS BIGINT) END AS code
      FROM codebook_values WHERE variable = 'V7' AND source = 'brand#6')
    WHERE code IS NOT NULL AND (label <> '' OR label_de <> '') GROUP BY code""")
def value_label_map_of_one(spark, sf_dir):
    return codebook.value_label_map(frame(spark, sf_dir, "codebook_values"), "v7", "brand#6")


@query("codebook_of_texts", """
    SELECT doc_id::VARCHAR AS variable, length(coalesce(text, '')) AS letters, md5(coalesce(text, '')) AS label, coalesce(lang, '') AS label_de
    FROM documents""")
def codebook_of_texts(spark, sf_dir):
    """Files whose labels are whole texts with line breaks, written by as many tasks as read the texts, read by as many as they have splits."""
    folder = f"{stage_folder(spark)}/codebook-{uuid.uuid4().hex}"
    texts = table(spark, sf_dir, "documents").select(
        F.lit("s").alias("study"), F.lit("texts").alias("dataset"), F.lit("1").alias("version"),
        F.col("doc_id").cast("string").alias("variable"), "text", "lang")
    writer = texts.write.option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(f"{folder}/texts_variables.csv")
    book = codebook_files.read_variables(spark, folder)
    return book.select("variable", F.length("label").cast("long").alias("letters"), F.md5("label").alias("label"), "label_de")
