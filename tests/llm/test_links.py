"""Tool calls with other columns, long contents, long chains, hot identifiers; and the plan."""

import json
import random

from pyspark.sql import functions as F

from panelweave.llm import tool_calls

SCHEMAS = {"find": {"q": {"type": "string", "required": True}}}


def plain(calls, results):
    """Status of every row by dictionaries, (conv, call, status) with the text that tells rows apart."""
    order = lambda row: tuple((x is not None, x) for x in row)
    first, answer = {}, {}
    for conv, call, after, name, arguments, turn in set(calls):
        key = (turn, after, name, arguments)
        if (conv, call) not in first or order(key) < order(first[conv, call]):
            first[conv, call] = key
    for conv, call, content, turn in set(results):
        if (conv, call) not in answer or order((turn, content)) < order(answer[conv, call]):
            answer[conv, call] = (turn, content)
    out = []
    for conv, call, after, name, arguments, turn in set(calls):
        status = "duplicate call"
        if first[conv, call] == (turn, after, name, arguments):
            status, seen, at = "linked" if (conv, call) in answer else "unanswered", {call} - {None}, after
            while (conv, at) in first and at is not None:  # nobody waits for a call without an identifier
                if at in seen:
                    status = "cycle"
                    break
                seen.add(at)
                at = first[conv, at][1]
        out.append((conv, call, status, arguments))
    for conv, call, content, turn in set(results):
        if (conv, call) not in first:
            out.append((conv, call, "orphan result", content))
        elif answer[conv, call] != (turn, content):
            out.append((conv, call, "duplicate result", content))
    return sorted(out, key=repr)


def tables(seed, n=300):
    draw = random.Random(seed)
    ident = lambda: draw.choice([None, *range(12)])
    calls = [(draw.choice([None, 1, 2]), ident(), ident(), "find", json.dumps({"q": str(draw.randrange(4))}), draw.choice([None, 1, 2])) for _ in range(n)]
    results = [(draw.choice([None, 1, 2, 3]), ident(), f"r{draw.randrange(5)}", draw.choice([None, 1, 2])) for _ in range(n)]
    return calls, results


def frames(spark, calls, results):
    return (spark.createDataFrame(calls, "conv_id long, call_id long, after_id long, name string, arguments string, turn long"),
            spark.createDataFrame(results, "conv_id long, call_id long, content string, turn long"))


def test_links_equal_dictionaries(spark):
    for seed in (1, 2, 3):
        calls, results = tables(seed)
        rows = tool_calls.link(*frames(spark, calls, results), SCHEMAS).collect()
        got = [(r.conv_id, r.call_id, r.status, json.loads(r.json)["result"] if r.status.endswith("result") else None) for r in rows]
        want = [(c, i, s, text if s.endswith("result") else None) for c, i, s, text in plain(calls, results)]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        assert sum(r.copies for r in rows if not r.status.endswith("result")) == len(calls)


def test_other_columns_go_along(spark):
    """Names of ours among them; equal rows with different ones keep the least."""
    calls = spark.createDataFrame(
        [(1, 1, None, "find", '{"q": "a"}', 1, "x", "s", 7, [1]), (1, 1, None, "find", '{"q": "a"}', 1, "y", "s", 7, [0])],
        "conv_id long, call_id long, after_id long, name string, arguments string, turn long, level string, side string, copies long, more_0 array<int>")
    results = spark.createDataFrame([(1, 1, "text", 2, "z")], "conv_id long, call_id long, content string, turn long, status string")
    (row,) = tool_calls.link(calls, results, SCHEMAS).collect()
    assert (row.status, row.copies, row.level) == ("linked", 2, 0)
    assert row.call.asDict() == {"level": "x", "side": "s", "copies": 7, "more_0": [1]} and row.result.status == "z"
    bare = tool_calls.link(calls.drop("level", "side", "copies", "more_0"), results.drop("status"), SCHEMAS).first()
    assert bare.call is None and bare.result is None


def test_long_contents_and_a_long_chain(spark):
    n = 3000
    calls = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("call_id"), (F.col("id") - 1).alias("after_id"),
                                  F.lit("find").alias("name"), F.lit('{"q": "x"}').alias("arguments"), F.lit(0).cast("long").alias("turn"))
    results = spark.createDataFrame([(1, 5, "long " * 400_000, 1)], "conv_id long, call_id long, content string, turn long")
    linked = tool_calls.link(calls, results, SCHEMAS)
    assert linked.where("level = call_id AND position = call_id").count() == n
    assert linked.where("status = 'linked'").select(F.length(F.get_json_object("json", "$.result"))).first()[0] == 2_000_000


def test_calls_and_results_meet_in_one_shuffle(spark, monkeypatch):
    """Joins and exchanges of all jobs of a link."""
    plans, stage = [], tool_calls.stage
    monkeypatch.setattr(tool_calls, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df, name))
    calls, results = tables(4)
    out = tool_calls.link(*frames(spark, calls, results), SCHEMAS)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("Exchange ") for p in plans) < 24
