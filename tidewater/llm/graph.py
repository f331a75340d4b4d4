"""Connected components of an undirected graph, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node that it
    is linked to, however far.

    Each round takes the smallest label among the neighbours and then that
    label's own label, so paths shorten by doubling. Labels are written every
    round; only whether any has changed reaches the driver.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(own, "label").select("node", F.least("label", "further").alias("label"), F.col("old"))
        found = written(step, "labels")
        labels = found.select("node", "label")
        if found.where("label != old").isEmpty():
            return labels
