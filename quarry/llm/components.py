"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


def connected_components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(node, label): the smallest node of every node's component. Each round
    takes the smallest label around a node and then that label's own label;
    tables are written between rounds, so every join has two plain shuffles
    (a hot node's edges are split) and no lineage grows."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct()
    both = written(both, f"{name}-edges")
    labels = written(both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("label")).withColumnRenamed("u", "node"), f"{name}-0")
    step = 0
    while True:
        step += 1
        around = (
            both.join(labels.select(F.col("node").alias("v"), F.col("label").alias("l")), "v")
            .groupBy(F.col("u").alias("n")).agg(F.min("l").alias("l"))
        )
        near = written(
            labels.join(around, F.col("node") == F.col("n"))
            .select("node", F.col("label").alias("old"), F.least("label", "l").alias("label")),
            f"{name}-{step}a",
        )
        up = near.select(F.col("node").alias("at"), F.col("label").alias("above"))
        labels = written(
            near.join(up, F.col("label") == F.col("at"))
            .select("node", "old", F.least("label", "above").alias("label")),
            f"{name}-{step}b",
        )
        if labels.where("label <> old").limit(1).count() == 0:
            return labels.select("node", "label")
