"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.session import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows (node, label) for the nodes of ``edges`` (a, b); ``label`` is the least node of the component.

    Every round takes the least label among neighbours and then follows labels one step
    further, each written to the shared folder. Rounds end when no label changes. A node
    with very many neighbours is summed up before the shuffle.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                 f"{name}-edges")
    state = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("label")), name)
    while True:
        told = both.join(state, both["b"] == state["node"]).groupBy("a").agg(F.min("label").alias("told"))
        near = state.join(told, state["node"] == told["a"]).select(
            "node", "label", F.least("label", "told").alias("next"))
        further = state.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        moved = stage(near.join(further, F.col("next") == F.col("via")).select(
            "node", F.least("next", "beyond").alias("label"), (F.least("next", "beyond") != F.col("label")).alias("changed")), name)
        state = moved.select("node", "label")
        if not moved.agg(F.max("changed")).first()[0]:
            return state
