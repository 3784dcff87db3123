"""Connected components of links by alternating nearest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import tidied, written


@tidied
def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``links`` (a, b): the smallest node that links reach.

    Each round a component takes the smallest component among its neighbours, then labels are followed to their
    roots. Links inside a component are dropped, so every round has at most half as many components left to
    join. Rounds are written, nothing is collected but one count.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = written(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        root = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("comp"), F.least("a", "b").alias("root"))
        root = _followed(written(root, "roots"))
        moved = labels.join(root, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
        labels = written(moved, "labels")
        left, right = root.toDF("a", "root_a"), root.toDF("b", "root_b")
        between = edges.join(left, "a").join(right, "b").where("root_a <> root_b")
        edges = written(between.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
    return labels


def _followed(root: DataFrame) -> DataFrame:
    """Each comp with the root that its chain of roots ends at."""
    while True:
        above = root.toDF("root", "above")
        jumped = written(root.join(above, "root").select("comp", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "roots")
        root = jumped.select("comp", "root")
        if jumped.where("moved").isEmpty():
            return root
