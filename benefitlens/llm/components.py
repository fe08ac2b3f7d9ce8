"""Connected components of an edge list, by hooking to the smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) of the nodes of an edge list (a, b).

    Each round a node takes the smallest label among its neighbours', and then its label's label; rounds grow with the
    logarithm of a component's width. Every round's table is written, so a lost executor costs no earlier round.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", F.least("label", "m").alias("label"), F.col("label").alias("was"))
        hooked = written(hooked, "labels")
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = hooked.join(jump, "label", "left").select("node", F.coalesce("next", "label").alias("label"), "was")
        jumped = written(jumped, "labels")
        if jumped.filter("label != was").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
