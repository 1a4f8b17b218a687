"""Connected components of an undirected graph by label propagation with checkpoints."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("on a cluster, spark.checkpoint.dir must name a shared folder")
            shared = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(shared)
    return df.checkpoint()


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of edges (a, b); component is the least node. A loop (a, a) names a node without neighbours."""
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")))
    for _ in range(most_rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low"))
        step = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "low").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("further"))
        after = checkpointed(step.join(jump, "low", "left").select("node", "was", F.least("low", F.coalesce("further", "low")).alias("component")))
        labels = after.select("node", "component")
        if not after.where("was <> component").limit(1).count():
            return labels
    raise RuntimeError("connected() needs more rounds")
