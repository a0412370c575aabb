"""Connected components of links between texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.session import materialise


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label): the least label reachable over ``edges`` (a, b) from each node of ``nodes`` (node, label).

    Labels are structs whose field ``node`` names the node they come from. Each round takes the least label of the
    neighbours, then that of the node one's label came from, so long chains shrink by halves. Each round is written to the
    shared folder, which cuts the lineage; both sides of its joins are plain scans, so a node with many
    neighbours, or a label that many nodes have, can be split.
    """
    both = materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "component-edges")
    state = materialise(nodes, "component-labels")
    while True:
        seen = both.join(state, both["a"] == state["node"]).groupBy("b").agg(F.min("label").alias("seen"))
        hooked = state.join(seen, state["node"] == seen["b"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("seen", "label")).alias("label"))
        known = state.select(F.col("node").alias("from"), F.col("label").alias("theirs"))
        jumped = hooked.join(known, F.col("label.node") == F.col("from"), "left").select(
            "node", F.least("label", F.coalesce("theirs", "label")).alias("label"), F.col("old"))
        state = materialise(jumped.select("node", "label", (F.col("label") != F.col("old")).alias("moved")), "component-labels")
        if not state.where("moved").limit(1).count():
            return state.select("node", "label")
        state = state.select("node", "label")
