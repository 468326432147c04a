"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with, for every node in ``links`` (``a``, ``b``: longs).

    In each round a node takes the smallest label among itself and its neighbours, and then the label of its label, so
    the rounds grow with the logarithm of the longest path rather than with the path. Labels are written to the shared
    folder after each round. A node with very many neighbours is summed in parts before it is shuffled."""
    both = written(links.select("a", "b").union(links.select("b", "a")).filter("a != b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        lower = written(lower, "labels")
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = lower.join(up, "root").select("node", F.least("root", "top").alias("root"), "was")
        jumped = written(jumped, "labels")
        if jumped.filter("root != was").isEmpty():
            return jumped.select("node", "root")
        labels = jumped.select("node", "root")
