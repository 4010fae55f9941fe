"""Connected components by joins: labels move along links and jump to their own labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it can reach) for all nodes of ``links`` (``a``, ``b``).

    In each round a label goes under the smallest label beside it, or under the one that this goes under, so long
    chains shrink by halves; links with a common label leave. A label is always a node of the same component and
    no larger than its node, and after the last round all links of a component lead to one root; labels then jump to their
    own labels until they are roots. Nothing but flags reaches the driver.
    """
    both = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    labels = materialize(both.select("node", F.col("node").alias("label")), "labels")
    edges = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        up = edges.groupBy("b").agg(F.min("a").alias("up"))
        over = up.select(F.col("b").alias("up"), F.col("up").alias("top"))
        up = up.join(over, "up", "left").select(F.col("b").alias("label"), F.coalesce("top", "up").alias("new"))
        labels = materialize(labels.join(up, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")
        la = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
        lb = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = materialize(edges.join(la, "a").join(lb, "b").where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    while True:
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = labels.join(own, "label")
        if jumped.where("root <> label").isEmpty():
            return labels
        labels = materialize(jumped.select("node", F.col("root").alias("label")), "labels")
