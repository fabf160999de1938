"""Connected components of a link table by hooking and pointer jumping, each round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the least node of its component.

    A round gives each node the least label among itself and its neighbours, then the label of that
    label. Rounds end when no label falls; a star takes two, a chain about the logarithm of its length.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    labels = stored(labels, "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        hooked = (labels.join(near, labels.node == near.a)
                  .select("node", F.col("label").alias("old"), F.least("label", "near").alias("low")))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        jumped = hooked.join(up, "low").select("node", "old", F.least("low", "up").alias("label"))
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label < old").isEmpty():
            return labels
