"""Connected components of a graph of links, by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import stored


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over ``links`` (a, b). ``nodes`` has node.

    Every round takes the least label among neighbours and then the label of that label, so chains halve
    from round to round. Labels and links are tables, aggregated before they are shuffled; a node with
    very many links is a row per task on one side and a split join partition on the other.
    """
    both = stored(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-links")
    # only linked nodes take part; the others are their own component
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        offered = both.join(label, F.col("b") == F.col("node")).groupBy(F.col("a").alias("to")).agg(F.min("label").alias("offer"))
        taken = label.join(offered, F.col("node") == F.col("to")).select("node", F.col("label").alias("was"), F.least("label", "offer").alias("label"))
        taken = stored(taken, "labels")
        ahead = taken.select(F.col("node").alias("via"), F.col("label").alias("far"))
        jumped = taken.join(ahead, F.col("label") == F.col("via")).select("node", "was", F.least("label", "far").alias("label"))
        jumped = stored(jumped, "labels")
        if jumped.where(F.col("label") != F.col("was")).isEmpty():
            break
        label = jumped.select("node", "label")
    found = jumped.select(F.col("node").alias("__n"), "label")
    return nodes.join(found, F.col("node") == F.col("__n"), "left").select("node", F.coalesce("label", "node").alias("component"))
