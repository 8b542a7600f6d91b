"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.tables import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of ``links`` (a, b) can reach.

    Every round takes the smallest label among neighbours and then the label's own label,
    so that long chains shorten by half. Rounds are written to the shared folder; only the
    number of changed labels comes to the driver. Ids are bigint; loops do no harm.
    """
    edges = materialize(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("a", "b").distinct(), "links"
    )
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    changed = True
    while changed:
        labels = materialize(labels, "labels")
        around = edges.join(labels, F.col("b") == F.col("id")).select(F.col("a").alias("id"), "component")
        least = around.union(labels).groupBy("id").agg(F.min("component").alias("component"))
        far = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        jumped = least.join(far, "component", "left").select(
            "id", F.least("component", "further").alias("component")
        )
        jumped = materialize(jumped, "labels")
        before = labels.select("id", F.col("component").alias("before"))
        changed = not jumped.join(before, "id").filter("before <> component").isEmpty()
        labels = jumped
    return labels
