"""Connected groups of a link table, by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.plans.runtime import staged


def connected_components(links: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``links``; component is the group's smallest node.

    Each round takes the smallest label among a node and its neighbours, then that label's own
    label, and is written out, so lineage stays short. Rounds grow with the logarithm of the
    longest chain. No links give no rows.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("to")).union(links.select(F.col(b).alias("node"), F.col(a).alias("to"))).distinct()
    both = staged(both, "links")
    labels = staged(both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("component")), "labels")
    for _ in range(rounds):
        seen = both.join(labels.select(F.col("node").alias("to"), "component"), "to").groupBy("node").agg(F.min("component").alias("near"))
        met = labels.join(seen, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        now = staged(met.join(jump, "component", "left").select("node", "old", F.least(F.col("component"), F.coalesce("beyond", "component")).alias("component")), "labels")
        labels = now.select("node", "component")
        if now.where("component <> old").isEmpty():
            break
    else:
        raise RuntimeError(f"the groups did not settle in {rounds} rounds")
    return labels
