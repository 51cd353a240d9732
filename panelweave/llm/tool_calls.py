"""Tool-call linking: calls meet results by identifier, in an order that respects what each call waits for.

Calls are rows (conv_id, call_id, after_id, name, arguments, turn): ``arguments`` is
JSON text, ``after_id`` the call whose result this one builds on, or null. Results are
rows (conv_id, call_id, content, turn). Everything is joined by (conversation, call),
so a conversation that holds a third of all messages is spread like any other.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import place
from panelweave.llm.feistel import row_numbers
from panelweave.session import stage

#: JSON types by the type of a parsed value.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL.*)", "boolean": "BOOLEAN",
         "object": "OBJECT.*", "array": "ARRAY.*"}
ID = ("conv_id", "call_id")


def problems(name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, Mapping[str, Any]]]) -> Column:
    """What is wrong with parsed arguments, as "parameter: problem", by parameter in order of its name.

    A schema gives for each parameter its ``type`` and may give ``required``,
    ``min``/``max`` (of a number, or of the length of a string) and ``enum``.
    Parameters that no schema names are problems, as are unknown tools and text that
    is not a JSON object.
    """
    out = F.array(F.lit("unknown tool"))
    keys = F.json_object_keys(F.to_json(arguments))
    for tool, schema in sorted(schemas.items()):
        extra = F.array_except(keys, F.array(*map(F.lit, schema)))
        checks = [F.transform(F.array_sort(extra), lambda k: F.concat(k, F.lit(": not in the schema")))]
        for parameter, rule in sorted(schema.items()):
            path = f"$.{parameter}"
            present = F.array_contains(keys, parameter)
            kind = F.schema_of_variant(F.try_variant_get(arguments, path, "variant"))
            right = kind.rlike(f"^{TYPES[rule['type']]}$")
            text = F.try_variant_get(arguments, path, "string")
            measure = F.length(text) if rule["type"] == "string" else F.try_variant_get(arguments, path, "double")
            tests = [(~right, f"not of type {rule['type']}")]
            if "min" in rule:
                tests.append((measure < rule["min"], f"below {rule['min']}"))
            if "max" in rule:
                tests.append((measure > rule["max"], f"above {rule['max']}"))
            if "enum" in rule:
                tests.append((~text.isin(*rule["enum"]), "not one of the values"))
            found = F.when(~present, F.lit(f"{parameter}: missing") if rule.get("required") else F.lit(None))
            for bad, what in tests:
                found = found.when(bad, F.lit(f"{parameter}: {what}"))
            checks.append(F.array_compact(F.array(found.otherwise(F.lit(None).cast("string")))))
        out = F.when(name == tool, F.concat(*checks)).otherwise(out)
    return F.when(arguments.isNull() | ~F.schema_of_variant(arguments).rlike("^OBJECT"), F.array(F.lit("not a JSON object"))).otherwise(out)


def levels(calls: DataFrame, name: str = "levels") -> DataFrame:
    """Rows (conv_id, call_id, level): 0 for calls that wait for none, else one more than the call waited for.

    Each round doubles the distance every pointer spans, so a chain of n calls takes
    log2(n) rounds, and only calls that still wait go into the next. Calls on a cycle, or behind
    one, still point somewhere after that and get no level. ``calls`` has one row a (conversation, call).
    """
    known = calls.select(*ID).withColumnsRenamed({"conv_id": "c", "call_id": "i"})
    state = stage(calls.join(known, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("after_id").eqNullSafe(F.col("i")), "left").select(
        *ID, F.col("i").alias("pointer"), F.when(F.col("i").isNull(), 0).otherwise(1).cast("long").alias("level")), name)
    done, waiting = state.where("pointer IS NULL"), state.where("pointer IS NOT NULL")
    rounds, left, n = 0, *state.agg(F.count("pointer"), F.count("*")).first()
    while left and rounds <= math.ceil(math.log2(n + 1)):
        ahead = done.unionByName(waiting).select(
            F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("pointer").alias("next"), F.col("level").alias("more"))
        moved = stage(waiting.join(
            ahead, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("pointer") == F.col("i")), "left"
        ).select(*ID, F.col("next").alias("pointer"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), name)
        done, waiting = done.unionByName(moved.where("pointer IS NULL")), moved.where("pointer IS NOT NULL")
        rounds += 1
        left = waiting.count()
    return done.select(*ID, "level").unionByName(waiting.select(*ID, F.lit(None).cast("long").alias("level")))


CALL, ANSWER = ("turn", "after_id", "name", "arguments"), ("turn", "content")


def _gathered(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls and results as one table, equal rows once with their number; what the caller has besides goes along as a struct."""
    own = lambda df, columns, known: df.select(*ID, *known, (
        F.struct(*(df[f"`{c}`"] for c in df.columns if c not in (*ID, *columns))) if set(df.columns) - {*ID, *columns}
        else F.lit(None).cast("string")).alias("more"))
    kind = {"after_id": calls.schema["after_id"].dataType, "name": "string", "arguments": "string", "content": "string", "turn": "long"}
    single = []
    for side, (df, columns) in enumerate(((calls, CALL), (results, ANSWER))):
        typed = [(F.col(c) if c in columns else F.lit(None)).cast(t).alias(c) for c, t in kind.items()]
        rows = own(df, columns, typed).withColumn("side", F.lit(side)).withColumnRenamed("more", f"more_{side}")
        single.append(rows.groupBy("side", *ID, *kind).agg(F.count("*").alias("copies"), F.min(f"more_{side}").alias(f"more_{side}")))
    return single[0].unionByName(single[1], allowMissingColumns=True)


def link(calls: DataFrame, results: DataFrame, schemas: Mapping, name: str = "tool-calls") -> DataFrame:
    """One row for each call and for each result that no call takes, in order within its conversation.

    ``status``: linked, unanswered, duplicate call (an earlier call has the identifier),
    duplicate result, orphan result, cycle (waits for itself). ``position`` counts from 0
    in the order level, turn, identifier; calls without a level follow, then left-over
    results. ``problems`` lists what the schemas object to, ``json`` is canonical: keys
    sorted at all levels, no blanks, nulls kept. ``call`` and ``result`` hold the other columns of the
    call and of the result (null if there are none), so their names clash with nothing here.

    Equal rows are one row with ``copies`` and, if their other columns differ, the least of those. Null identifiers match null
    identifiers of the same conversation. Invalid JSON, nulls, empty and very long texts are reported, not dropped
    or cut. Empty tables give an empty result. Other columns must be of types that can be ordered.

    Calls and results are gathered by identifier once: a row of that says which call meets which result.
    Only identifiers with several calls or results are looked at again for the rows that are left over.
    """
    rows = stage(_gathered(calls, results), f"{name}-rows")
    met = stage(rows.groupBy(*ID).agg(
        F.min(F.when(F.col("side") == 0, F.struct(*CALL, "copies", "more_0"))).alias("one"),
        F.min(F.when(F.col("side") == 1, F.struct(*ANSWER, "copies", "more_1"))).alias("answer"),
        F.count_if(F.col("side") == 0).alias("n_calls"), F.count_if(F.col("side") == 1).alias("n_results")), f"{name}-met")
    called = met.where("one IS NOT NULL")
    level = levels(called.select(*ID, "one.after_id"), f"{name}-levels").withColumnsRenamed({"conv_id": "c", "call_id": "i"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("call_id").eqNullSafe(F.col("i"))
    linked = called.join(level, same, "left").select(
        *ID, "one.after_id", "one.name", "one.arguments", "one.turn", "answer.content", F.col("answer.turn").alias("result_turn"), "one.copies",
        F.col("one.more_0").alias("call"), F.col("answer.more_1").alias("result"), "level",
        F.when(F.col("level").isNull(), "cycle").when(F.col("answer").isNotNull(), "linked").otherwise("unanswered").alias("status"))
    spare = lambda status: (
        *ID, "after_id", "name", "arguments", F.when(F.col("side") == 0, F.col("turn")).alias("turn"), "content",
        F.when(F.col("side") == 1, F.col("turn")).alias("result_turn"), "copies", F.col("more_0").alias("call"), F.col("more_1").alias("result"),
        F.lit(None).cast("long").alias("level"), status.alias("status"))
    several = met.where("n_calls > 1 OR n_results > 1 OR n_calls = 0").select(
        F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "one", "answer", (F.col("n_calls") > 0).alias("called"))
    taken = F.when(F.col("side") == 0, F.struct(*CALL).eqNullSafe(F.struct(*(F.col(f"one.{c}") for c in CALL)))).otherwise(
        F.col("called") & F.struct(*ANSWER).eqNullSafe(F.struct(*(F.col(f"answer.{c}") for c in ANSWER))))
    extra = rows.join(several, same).where(~taken).select(*spare(
        F.when(F.col("side") == 0, "duplicate call").when(F.col("called"), "duplicate result").otherwise("orphan result")))
    rows = linked.unionByName(extra)

    rows = rows.withColumn("parsed", F.try_parse_json("arguments"))
    rows = rows.withColumn("problems", F.when(F.col("status").endswith("result"), F.array().cast("array<string>")).otherwise(
        problems(F.col("name"), F.col("parsed"), schemas))).withColumn("arguments", F.coalesce(F.to_json("parsed"), F.lit("null")))
    rows = rows.drop("parsed").withColumn("kind", F.when(
        F.col("status").endswith("result"), 2).when(F.col("level").isNull(), 1).otherwise(0))
    at = F.coalesce("turn", "result_turn")
    order = ["conv_id", "kind", "level", "at", "call_id", "content", "arguments", "name", "after_id"]
    rows = stage(rows.withColumn("at", at), f"{name}-linked")
    numbered = row_numbers(place(rows, order, f"{name}-order"), f"{name}-order")
    starts = numbered.groupBy(F.col("conv_id").alias("c")).agg(F.min("number").alias("start"))
    placed = numbered.join(starts, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn(
        "position", F.col("number") - F.col("start"))
    quoted = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1), F.lit("null"))
    text = lambda c: F.when(F.col(c).isNull(), "null").otherwise(quoted(c))
    json = F.concat(
        F.lit('{"arguments":'), "arguments", F.lit(',"call_id":'), text("call_id"), F.lit(',"name":'), text("name"),
        F.lit(',"position":'), F.col("position").cast("string"), F.lit(',"result":'), text("content"),
        F.lit(',"status":'), text("status"), F.lit("}"))
    return placed.select("conv_id", "call_id", "after_id", "name", "position", "level", "status", "copies", "problems",
                         json.alias("json"), "call", "result")
