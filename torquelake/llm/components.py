"""Connected components by contraction: nodes hook onto a smaller neighbour; all state is in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torquelake.llm.common import match, match_hot, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the ends of ``a, b``; a component is its smallest node.

    In a round every node hooks onto its smallest neighbour, if that is smaller, and trees of hooks
    become their roots. Only edges between different roots go into the next round, each once, so
    edges are joined about once in all and not once for each round. At the end, roots of later
    rounds are handed back to the nodes of the rounds before. Minima are combined before
    they are shuffled. A hub of many edges, and a label that many nodes have, are looked up by
    broadcast, as there can only be few of them. Without edges the result is empty.
    """
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = stored(edges.filter("a <> b").select(*ends).distinct(), "edges")
    n_links, rounds = links.count(), []
    while n_links or not rounds:
        both = links.union(links.select("b", "a"))
        first = F.least(F.first("a"), F.min("b")).alias("component")
        hooked = both.groupBy(F.col("a").alias("node")).agg(first, F.count(F.lit(1)).alias("degree"))
        labels = _roots(stored(hooked, "labels"))
        rounds.append(labels.select("node", "component"))
        for a, b in ("a", "b"), ("b", "a"):
            found = match_hot(links.withColumnRenamed(a, "node"), labels, ["node"], F.col("degree"), n_links)
            links = found.select(F.col("component").alias(a), b)
        links = stored(links.filter("a <> b").select(*ends).distinct(), "edges")
        n_links = links.count()
    whole = rounds.pop()
    for labels in reversed(rounds):
        users = labels.groupBy("component").agg(F.count(F.lit(1)).alias("_users"))
        later = match(users, whole.select(F.col("node").alias("component"), F.col("component").alias("_next")), ["component"], "left")
        later = stored(later.withColumn("_next", F.coalesce("_next", "component")), "label-hops")
        found = match_hot(labels, later, ["component"], F.col("_users"), labels.count())
        whole = stored(found.select("node", F.col("_next").alias("component")), "labels")
    return whole


def _roots(labels: DataFrame) -> DataFrame:
    """``node, component, degree`` with the root in the place of the node that each hooks onto.

    What a node hooks onto is a node of the table, and no larger one. Every hop doubles the way.
    """
    n_nodes = labels.count()
    while True:
        users = labels.groupBy("component").agg(F.count(F.lit(1)).alias("_users"))
        hop = match(labels.select(F.col("node").alias("component"), F.col("component").alias("_next")), users, ["component"])
        found = match_hot(labels, stored(hop, "label-hops"), ["component"], F.col("_users"), n_nodes)
        labels = stored(found.select("node", F.col("_next").alias("component"), "degree", (F.col("component") != F.col("_next")).alias("_moved")), "labels")
        if labels.filter("_moved").isEmpty():
            return labels.drop("_moved")
