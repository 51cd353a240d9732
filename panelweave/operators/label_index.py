"""An index of trigrams over the labels of a codebook: substring searches read the lists of a few trigrams.

Every text is the name and the English label of a variable, in lower case. Its runs of three
characters are written with the number of its row, dealt to folders by trigram and sorted within them. A
word of a query can only be in texts that hold all of its trigrams; those are looked up and compared with
the whole word, so results are those of the scan. Words of one or two letters have no trigram: they are looked for in
the rows that the longer words leave, or by the scan if there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators.codebook import search_variables

#: Folders that trigrams are dealt to, and rows that one file of the codebook holds at most.
SHARDS, FILE_ROWS = 64, 1_000_000
FIELDS = ("source", "dataset", "variable", "label", "label_de")
#: Rows found that are named one by one to the scan of the codebook; more are joined.
NAMED = 1_000


def text_of() -> Column:
    return F.lower(F.concat_ws(" ", "variable", "label"))


def _shard(trigram: Column) -> Column:
    return F.pmod(F.xxhash64(trigram), F.lit(SHARDS)).cast("int")


def build(codebook: DataFrame, folder: str) -> None:
    """Write the rows of a codebook, numbered, and the trigrams of their texts to a new folder."""
    spark = codebook.sparkSession
    numbered = codebook.select(*FIELDS, "position").repartitionByRange("source", "position").sortWithinPartitions("source", "position")
    numbered.select(F.monotonically_increasing_id().alias("row"), *FIELDS).write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    text = text_of()
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("text") - 2), lambda i: F.substring(F.col("text"), i, F.lit(3))))
    long = rows.select("row", text.alias("text")).where(F.length("text") >= 3).select("row", F.explode(grams).alias("trigram"))
    # a trigram of very many rows goes over several tasks
    dealt = long.withColumn("shard", _shard(F.col("trigram"))).repartition("shard", F.pmod("row", F.lit(16)))
    dealt.sortWithinPartitions("shard", "trigram", "row").write.partitionBy("shard").parquet(f"{folder}/trigrams")


def _rows_with(spark: SparkSession, folder: str, terms: list[str]) -> DataFrame:
    """Numbers of the rows that hold all trigrams of each term, with the terms they may hold."""
    of_term = [sorted({term[i:i + 3] for i in range(len(term) - 2)}) for term in terms]
    trigrams = sorted({g for grams in of_term for g in grams})
    shards = [r[0] for r in spark.createDataFrame([(g,) for g in trigrams], "g string").select(_shard(F.col("g"))).distinct().collect()]
    lists = spark.read.schema("row long, trigram string, shard int").parquet(f"{folder}/trigrams").where(
        F.col("shard").isin(shards) & F.col("trigram").isin(trigrams))
    holds = lists.groupBy("row").agg(F.collect_set("trigram").alias("held"))
    met = F.filter(F.array(*(F.when(F.size(F.array_intersect("held", F.lit(grams))) == len(grams), F.lit(n))
                             for n, grams in enumerate(of_term))), lambda n: n.isNotNull())
    return holds.select("row", met.alias("met"))


def search(spark: SparkSession, folder: str, query: str, source: str | None = None, match_any: bool = False) -> DataFrame:
    """As ``search_variables`` on the codebook that the index was built from, which it reads no more than it has to."""
    rows = spark.read.parquet(f"{folder}/rows")
    terms = sorted(set(query.lower().split()))
    long = [t for t in terms if len(t) >= 3]
    if not long or (match_any and len(long) < len(terms)):
        return search_variables(rows, query, source, match_any)
    found = _rows_with(spark, folder, long)
    candidates = found.where(F.size("met") > 0 if match_any else F.size("met") == len(long)).select("row")
    few = [r.row for r in candidates.limit(NAMED + 1).collect()]
    if len(few) <= NAMED:
        kept = rows.where(F.col("row").isin(few)) if few else rows.limit(0)
    else:
        kept = rows.join(candidates, "row", "left_semi")
    return search_variables(kept, query, source, match_any)
