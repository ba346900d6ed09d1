"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import durable_table


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the node's smallest neighbour, or on the node if that is smaller."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return near.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """`doc_id, component`: for every id in the links `a, b` (long), the smallest id that can be reached from it.

    Each round is written to the shared folder, which cuts the lineage; rounds end when nothing changes. They are few:
    the longest way shrinks by a factor with each. Nothing but two numbers a round goes to the driver.
    """
    edges = durable_table(links.select("a", "b").filter("a <> b").distinct(), name)
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        edges = durable_table(_small_star(_large_star(edges)), name)
    own = edges.select(F.col("b").alias("doc_id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("doc_id"), F.col("b").alias("component")).unionByName(own)
