"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palabre.llm.common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``links (a, b)``; the smallest id names it.

    Each round takes the smallest label among an id and its neighbours, then the label
    of that label, so that chains shorten by half. Every round is written to the shared
    folder, nothing but the count of changes comes to the driver. Labels are minima
    that are summed up before each shuffle; an id with very many links is the single
    row of its join, whose other side adaptive execution splits.
    """
    both = stage(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "links",
    )
    labels = stage(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")),
        "labels",
    )
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).select(F.col("a").alias("id"), "component")
        least = labels.unionByName(near).groupBy("id").agg(F.min("component").alias("component"))
        least = stage(least, "labels")
        heads = least.select(F.col("id").alias("head"), F.col("component").alias("further"))
        jumped = least.join(heads, F.col("component") == F.col("head")).select(
            "id", F.col("further").alias("component")
        )
        new = stage(jumped, "labels")
        old = labels.select("id", F.col("component").alias("old"))
        if new.join(old, "id").filter("component <> old").isEmpty():
            return new
        labels = new
