"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``; the label is the component's smallest node.

    Each round a node takes the smallest label among its own and its neighbours', and
    then its label's label (pointer jumping), so long chains shrink by doubling. Sums
    over a hub's links combine map-side, joins on a hub can be split by adaptive
    execution, and each round's labels are stored in place of the last round's. Only the number of changed labels
    comes to the driver. Self links and repeated links are harmless. Each node is kept as a
    neighbour of its own, so that one join brings its label along with the others'.
    """
    ends = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x in "ab" for y in "ab"]
    edges = stored(links.filter("a <> b").select(F.inline(F.array(*ends))).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels")
    while True:
        own = F.when(F.col("a") == F.col("b"), F.col("label"))
        hooked = stored(
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min(own).alias("before"), F.min("label").alias("label")),
            "hooked",
        )
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("top"))
        seen = Observation()
        jumped = hooked.join(above, "label").select(
            "node", F.col("top").alias("label"), (F.col("top") != F.col("before")).alias("moved")
        ).observe(seen, F.sum(F.col("moved").cast("bigint")).alias("moved"))
        before, labels = labels, stored(jumped, "labels")
        discard(before, hooked)
        if not seen.get["moved"]:
            discard(edges)
            return labels.select("node", "label")
