"""Connected components of a link table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: long); root is the smallest node reachable.

    Each round a node takes the least label of its neighbours and then its label's label, so that the labels of a
    chain of n nodes settle in about log(n) rounds. Labels are written to the shared folder each round: a lost executor costs a
    part of one round. Neighbours are combined by a partial minimum, never gathered."""
    pairs = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = materialise(spark, pairs.where("a <> b").distinct(), "links")
    labels = materialise(spark, pairs.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "labels")
    while True:
        near = (pairs.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        met = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("best"))
        jump = labels.select(F.col("node").alias("best"), F.col("root").alias("further"))
        after = met.join(jump, "best").select("node", F.least("best", "further").alias("root"),
                                              (F.least("best", "further") != F.col("root")).alias("changed"))
        after = materialise(spark, after, "labels")
        labels = after.select("node", "root")
        if after.where("changed").isEmpty():
            return labels
