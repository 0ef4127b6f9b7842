"""Connected components of a graph whose links stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.session import materialize


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(_id, _comp): the smallest identifier reachable from each of ``nodes`` over ``links`` (x, y).

    Each round takes the smallest label among a node's neighbours and then
    the label of that label, so chains shorten by half at least. Labels are
    stored after every round; the driver only learns whether any changed.
    A node without links keeps its own identifier.
    """
    both = materialize(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
                       .distinct(), "links")
    labels = materialize(nodes.select("_id", F.col("_id").alias("_comp")), "labels")
    while True:
        near = (both.join(labels, both["y"] == labels["_id"]).groupBy("x").agg(F.min("_comp").alias("_near")))
        nearer = (labels.join(near, labels["_id"] == near["x"], "left")
                  .select("_id", F.col("_comp").alias("_old"), F.least("_comp", "_near").alias("_comp")))
        jump = labels.select(F.col("_id").alias("_at"), F.col("_comp").alias("_jump"))
        after = materialize(nearer.join(jump, nearer["_comp"] == jump["_at"], "left")
                            .select("_id", F.least("_comp", "_jump").alias("_comp"), "_old"), "labels")
        labels = after.select("_id", "_comp")
        if after.where("_comp <> _old").isEmpty():
            return labels
