"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import written


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for every node of ``links`` (a, b: long).

    Each round takes the least label among the neighbours and then follows the
    label's own label, so a path halves at least. Labels and edges are rows
    with map-side combined minima: a node with very many links, or a component
    with a third of all nodes, is spread like any other rows. The driver sees
    one count per round.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(spark, both.filter("a <> b").distinct(), "component-edges")
    labels = written(spark, edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "component-labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = written(spark, labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "component-hooked")
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = written(spark, hooked.join(jump, "root").select("node", "old", F.col("next").alias("root")), "component-labels")
        labels = after.select("node", "root")
        if not after.filter("root <> old").count():
            return labels
