"""Connected components of a link table, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage


def components(spark: SparkSession, links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b); linked nodes only.

    Every round each node takes the smallest label among its neighbours' (a partial aggregate, so a
    node with very many links is no burden), then the label of its label until that stands still.
    A round's labels are a table in the shared folder.  Null ends and loops are left out.
    """
    good = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    edges = stage(spark, good.union(good.select("b", "a")).distinct(), f"{label}-links")
    labels = stage(spark, edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("component")), f"{label}-0")
    number = 0
    while True:
        number += 1
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        # A label learns of smaller labels at its members too, so that chains of labels meet.
        offers = (labels.join(near, "node")
                  .select("node", F.col("component").alias("was"), F.least("component", "near").alias("to")))
        hooks = offers.where("to < was").groupBy(F.col("was").alias("node")).agg(F.min("to").alias("hook"))
        moved = (offers.join(hooks, "node", "left")
                 .select("node", "was", F.least("to", "hook").alias("component")))
        moved = stage(spark, moved, f"{label}-{number}a")
        up = moved.select(F.col("node").alias("component"), F.col("component").alias("upper"))
        jumped = (moved.join(up, "component", "left")
                  .select("node", "was", F.least("component", "upper").alias("component")))
        jumped = stage(spark, jumped, f"{label}-{number}b")
        labels = jumped.select("node", "component")
        if not jumped.where("component < was").limit(1).count():
            return labels
