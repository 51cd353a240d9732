"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import (
    decontaminate, feistel, hard_negatives, jaccard_forest, language_id, learning, line_dedup, mixing, quality_mil,
    quality_rules, secret_scan, spelling, tool_calls, url_filter,
)
from panelweave.llm import checks, common
from panelweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(run):
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return register


@query("op1_line_dedup", checks.LINES)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "text")


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules.judge(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=("doc_id",))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason")


@query("op3_jaccard_forest")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_forest.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copies", "n_links")


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), carry=("doc_id",))
    kind = lambda k: F.size(F.filter("known", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "row.doc_id", kind(0).alias("n_assign"), kind(1).alias("n_access"), kind(2).alias("n_hex"),
        F.sha2(secret_scan.digest(F.col("known")), 256).alias("base_sha256"),
        secret_scan.digest(F.concat("known", "random")).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


#: What the two tools of op5 take.
SCHEMAS = {
    "configure": {"instruction": {"type": "string", "required": True, "min": 20, "max": 300},
                  "words": {"type": "integer", "required": True, "min": 5}},
    "reply": {"prompt": {"type": "string", "required": True, "min": 30, "max": 400},
              "turn": {"type": "integer", "required": True, "max": 6},
              "words": {"type": "integer", "required": True, "min": 5, "max": 60}},
}


def conversation_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as tool traffic: a system or user turn is a call that waits for the one two turns earlier, an
    assistant turn is the result of the call one turn earlier. Turns of any other role, or none, are results that
    name no call."""
    ident = lambda back: F.concat_ws(":", F.col("conv_id"), F.col("turn") - back)
    words = F.regexp_count("text", F.lit(common.WORD))
    system = F.col("role") == "system"
    arguments = F.when(system, F.to_json(F.struct(words.alias("words"), F.col("text").alias("instruction")))).otherwise(
        F.to_json(F.struct(words.alias("words"), "turn", F.col("text").alias("prompt"))))
    calls = messages.where(F.col("role").isin("system", "user")).select(
        "conv_id", ident(0).alias("call_id"), ident(2).alias("after_id"),
        F.when(system, "configure").otherwise("reply").alias("name"), arguments.alias("arguments"), "turn")
    results = messages.where(~F.coalesce(F.col("role").isin("system", "user"), F.lit(False))).select(
        "conv_id", F.when(F.col("role") == "assistant", ident(1)).alias("call_id"), F.col("text").alias("content"), "turn")
    return calls, results


@query("op5_tool_calls", checks.CALLS)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = conversation_calls(table(spark, sf_dir, "conversations"))
    linked = tool_calls.link(calls, results, SCHEMAS)
    return linked.select("conv_id", "call_id", "name", "position", "level", "status", "copies",
                         F.array_join("problems", "; ").alias("problems"), "json")


@query("op6_feistel_shards", checks.SHARDS)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = feistel.shard(table(spark, sf_dir, "documents"), 24, carry=("doc_id",))
    return placed.select(
        "row.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = learning.fold(F.col("doc_id"), 3) == 1
    model = language_id.learn(docs.where(~held_out).select(F.col("doc_id").alias("key"), "text", "lang"))
    found = language_id.identify(docs, model, carry=(F.col("doc_id"), held_out.alias("held_out")))
    return found.select("row.*", "lang_pred", "score")


@query("op9_source_mix", checks.MIX)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(table(spark, sf_dir, "documents"), carry=("doc_id",))
    return drawn.select("row.doc_id", "size", "source_size", "target", "taken")


#: Documents that score less are rejected.
GOOD = 0.3


@query("op10_quality_mil")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = learning.fold(F.col("doc_id"), 5) == 0
    model = quality_mil.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = quality_mil.score(docs, model, carry=(F.col("doc_id"), held_out.alias("held_out")))
    return scored.select("row.*", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@query("op11_hard_negatives", checks.NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


#: Rules of op12, and the words that put a site's host on its block list.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
BLOCKED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")


def blocked_sites(pages: DataFrame) -> DataFrame:
    """Hosts of the pages from the label on that holds one of the words between hyphens."""
    site = F.regexp_extract(url_filter.host_of(F.col("url")), rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(BLOCKED_WORDS)})(?:-[^.]*)?\..+)$", 1)
    return pages.select(site.alias("entry")).where("entry <> ''").distinct()


@query("op12_url_filter", checks.URLS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.judge(pages, RULES, blocked_sites(pages), carry=("page_id",))
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "listed")


@query("op13_spelling_variants", checks.SPELLING)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(table(spark, sf_dir, "documents"), edit=spelling.drop_a_letter(97))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
