"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the nodes of ``edges`` (a, b); comp is the least node of the component.

    Each round takes the least label among neighbours and then follows labels twice, so that long chains shrink
    quickly. Labels are written out after each round; only the number of changes reaches the driver. A node with very
    many edges is summed before the shuffle.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select("node", F.least("node", "n").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        lower = stored(lower, "labels")
        step = lower.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        jumped = lower.join(step, "comp").select("node", "was", F.col("next").alias("comp"))
        labels = stored(jumped, "labels")
        if labels.where("comp <> was").limit(1).count() == 0:
            return labels.select("node", "comp")
