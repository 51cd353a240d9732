"""Turns of roles that are neither calls nor answers."""

from panelweave.llm import tool_calls
from panelweave.llm.queries import SCHEMAS, conversation_calls


def test_other_roles_are_orphan_results(spark):
    messages = spark.createDataFrame([
        (1, 0, "system", "a system text of some length for the test"), (1, 1, "assistant", "yes"), (1, 2, None, "no role"),
        (1, 3, "tool", "from a tool"), (1, 0, "function", "from a function"), (2, 0, "tool", None)],
        "conv_id long, turn long, role string, text string")
    rows = tool_calls.link(*conversation_calls(messages), SCHEMAS, name="roles").collect()
    assert sorted((r.conv_id, r.status) for r in rows) == [
        (1, "linked"), *[(1, "orphan result")] * 3, (2, "orphan result")]
    assert {r.call_id for r in rows if r.status == "orphan result"} == {None}
    assert sum("from a tool" in r.json or "from a function" in r.json or "no role" in r.json for r in rows) == 3
