"""Mixing sources to target weights: random order, prefix sums, exact budgets, repeated epochs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelweave.llm.common import WORD, packed, place, small_side, word_count
from panelweave.session import stage

WEIGHTS = (5, 2, 1)
VOLUME = (3, 2)
MOST = 2
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, volume: tuple[int, int] = VOLUME,
            most: int = MOST) -> DataFrame:
    """Rows (source, source_size) with ``target``: shares by weight, none above ``most`` times its size.

    Sorted by size over weight, the sources that reach their limit come first, so one
    running sum finds them; what they leave is shared among the rest by weight. All
    sums are whole numbers, so a target does not depend on the order of summation.
    The windows see one row a source.
    """
    up, down = volume
    common = math.lcm(*weights)
    big = lambda c: c.cast("decimal(38,0)")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn("rank", rank).withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))))
    ).withColumn("limit", F.col("source_size") * most)
    order = Window.orderBy((F.col("limit") * F.expr(f"{common} div weight")), "rank")
    everything = Window.partitionBy()
    left = big(F.lit(up) * F.sum("source_size").over(everything)) - big(
        F.lit(down) * F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    heavy = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    full = big(F.col("weight")) * left > big(heavy * down) * big(F.col("limit"))
    marked = ranked.withColumn("full", full)
    spare = F.lit(up) * F.sum("source_size").over(everything) - F.lit(down) * F.sum(
        F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything)
    shared = big(F.col("weight")) * big(spare)
    among = F.lit(down) * F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    return marked.select(
        "source", "source_size",
        F.when(F.col("full"), F.col("limit").cast("double"))
        .otherwise(shared.cast("double") / among.cast("double")).alias("target"),
    )


def mix(docs: DataFrame, *, source: str = "source", key: str = "doc_id", text: str = "text",
        carry: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, volume: tuple[int, int] = VOLUME,
        most: int = MOST, seed: str = SEED, name: str = "mix") -> DataFrame:
    """Rows (row, size, source_size, target, epochs, cut, taken) of every document.

    Documents of a source stand in the order of md5(seed, key), then key, size. The
    mix passes over the source as often as the whole budget allows (``epochs``) and
    takes the rest from the front; the document at the edge gives the words that are
    missing (``cut``), so the words taken from a source are the whole part of its target.

    * Null text: size 0, nothing to take. Null source: a source of its own, the last.
    * Null keys share one place in the order; rows equal in key and size stand in the
      order in which they were written, and exchanging them changes no result row.
    * A source without words has target 0. An empty table gives an empty result.

    ``docs`` should be a written table, as in the pipeline; write the result of joins or
    shuffles before (``panelweave.session.stage``).

    The running sums need no window over a source: sums by source and written file
    locate the file in which a budget ends, and only that file's rows of the source
    are summed one by one.
    """
    rows = docs.select(
        packed(docs, *carry).alias("row"), docs[source].alias("source"), word_count(docs[text]).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[key].cast("string"), F.lit("")))).alias("draw"),
        docs[key].alias("key"),
    )
    if carry:
        rows = stage(rows, f"{name}-rows")
    placed = place(rows, ["source", "draw", "key", "size"], name)
    by_file = stage(placed.groupBy("source", F.col("place.part").alias("part"), F.col("place.file").alias("file")).agg(
        F.sum("size").alias("words")), f"{name}-files")
    budgets = targets(by_file.groupBy("source").agg(F.sum("words").alias("source_size")), weights, volume, most)
    budgets = budgets.withColumn("budget", F.floor("target")).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0).cast("int")
    ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    budgets = small_side(budgets, f"{name}-budgets")

    files_before = Window.partitionBy("source").orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    edges = by_file.withColumn("before", F.coalesce(F.sum("words").over(files_before), F.lit(0)))
    edges = edges.join(budgets, edges["source"].eqNullSafe(budgets["source"])).where(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    ).select(edges["source"].alias("edge_source"), "file", "before", "rest")
    edge_rows = placed.join(
        small_side(edges, f"{name}-edges"),
        placed["source"].eqNullSafe(F.col("edge_source")) & (F.col("place.file") == F.col("file")),
    ).select("edge_source", "place", "size", "before", "rest")
    rows_before = Window.partitionBy("edge_source").orderBy("place.row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(rows_before), F.lit(0))
    cuts = edge_rows.withColumn("start", start).where(
        (F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("size"))
    ).select("edge_source", F.col("place").alias("edge"), (F.col("rest") - F.col("start")).alias("edge_words"))
    plan = small_side(
        budgets.join(cuts, budgets["source"].eqNullSafe(cuts["edge_source"]), "left").select(
            F.col("source").alias("plan_source"), "source_size", "target", "epochs", "edge", "edge_words"),
        f"{name}-plan")
    cut = F.when(F.col("place") < F.col("edge"), F.col("size")).when(
        F.col("place") == F.col("edge"), F.col("edge_words")).otherwise(0)
    return placed.join(plan, placed["source"].eqNullSafe(plan["plan_source"])).withColumn("cut", cut).select(
        "row", "size", "source_size", "target", "epochs", "cut",
        (F.col("epochs") * F.col("size") + F.col("cut")).alias("taken"),
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it stands."""
    gaps = F.slice(F.split(text, WORD, -1), F.lit(1), n.cast("int"))
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), n.cast("int"))
    return F.array_join(F.flatten(F.zip_with(gaps, words, lambda g, w: F.array(g, w))), "")


def mixed(docs: DataFrame, *, text: str = "text", chars: str = "n_chars", **settings) -> DataFrame:
    """The mix as documents: a row for each epoch that takes the document, texts cut where a budget ends.

    A document without words comes along whole in each full epoch, and once if there is none.
    """
    drawn = mix(docs, text=text, **settings)
    part = F.when(F.col("cut") > 0, F.array("cut")).otherwise(F.array().cast("array<bigint>"))
    times = F.when(F.col("size") == 0, F.greatest(F.col("epochs"), F.lit(1))).otherwise(F.col("epochs"))
    copies = F.concat(F.array_repeat("size", times), part)
    rows = drawn.select("row", "size", F.explode(copies).alias("words"))
    whole = F.col("words") == F.col("size")
    cut_text = F.when(whole, F.col("row")[text]).otherwise(first_words(F.col("row")[text], F.col("words")))
    out = []
    for c in docs.columns:
        value = F.col("row")[c]
        if c == text:
            value = cut_text
        elif c == chars:
            value = F.when(whole, value).otherwise(F.length(cut_text).cast(docs.schema[c].dataType))
        out.append(value.alias(c))
    return rows.select(*out)
