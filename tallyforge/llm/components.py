"""Connected components of an edge table, labelled with the smallest node of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import written


def labelled(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b).

    Each round a node takes the smallest label among its own and its neighbours', then the label of that label, so
    chains halve from round to round. Every round is a written table; only the number of changes reaches the driver.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        better = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        moved = written(better.join(jump, "next", "left").select(
            "node", F.least("next", F.coalesce("beyond", "next")).alias("label"),
            (F.least("next", F.coalesce("beyond", "next")) < F.col("label")).alias("moved")), "labels")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels
