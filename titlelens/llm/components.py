"""Connected components by alternating stars, with map-side minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's neighbours (the larger ones, or the smaller ones and itself) on the
    smallest of them.  Minima are taken before the shuffle; a node of many edges meets only its
    one minimum in a join."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
        else edges
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    hung = both.join(low.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    if large:
        moved = hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            low.select("a", F.col("low").alias("b")))
    return moved.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is the least node of its component.

    Nulls and self-links are left out.  No edges, no rows.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a > b").distinct()
    now, before = stored(now, "links"), None
    while True:
        now = stored(_star(_star(now, large=True), large=False), "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if seen == before:
            break
        before = seen
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(labels.select("label", "label").distinct())
