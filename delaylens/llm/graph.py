"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links(a, b): the smallest node that
    its links reach. Each round takes the smallest label among a node and its
    neighbours, then the label of that label, so long chains halve; every round
    is written to the shared folder. Only a count comes to the driver. No
    links: no rows."""
    both = stage(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges"
    )
    labels = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        taken = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        above = labels.select(F.col("node").alias("low"), F.col("component").alias("above"))
        jumped = taken.join(above, "low", "left").select("node", F.coalesce("above", "low").alias("component"), (F.coalesce("above", "low") < F.col("component")).alias("moved"))
        after = stage(jumped, "labels")
        labels = after.select("node", "component")
        if after.where("moved").isEmpty():
            return labels
