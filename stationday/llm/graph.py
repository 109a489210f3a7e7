"""Connected components of an edge table, in rounds that end in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every vertex of ``edges`` (columns ``a, b``): the smallest id that it is linked with.

    Each round takes the smallest label among the neighbours, then the label of that label, so chains
    shorten by more than half. Duplicate edges and self-loops do no harm; no edges give no rows.
    """
    both = stage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        # a label is itself a vertex, whose own label is as small or smaller
        ends = labels.select(F.col("id").alias("component"), F.col("component").alias("end"))
        after = stage(
            lowered.join(ends, "component", "left").select(
                "id", "old", F.least("component", F.coalesce("end", "component")).alias("component")
            ),
            "labels",
        )
        changed = not after.where("component != old").isEmpty()
        labels = after.select("id", "component")
        if not changed:
            return labels
