"""Which partitions of a log are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.uri import with_uri_parts
from tidelog.operators.small import checked_broadcast

PARTITION = ["topic_uri", "partition"]


def catalog(log: DataFrame) -> DataFrame:
    """Topic partitions of a log with the parts of their URI. Reads partition columns only."""
    return with_uri_parts(log.select(*PARTITION).distinct())


def by_topics(log: DataFrame, uris: list[str]) -> DataFrame:
    return log.where(F.col("topic_uri").isin(uris))


def topics_matching(topic_catalog: DataFrame, pattern: str, cluster: str | None = None) -> DataFrame:
    """Partitions whose whole topic name matches, inside one cluster when given."""
    found = topic_catalog.where(F.col("rn_parts.topic").rlike(f"^(?:{pattern})$"))
    if cluster:
        found = found.where(F.col("rn_parts.cluster") == cluster)
    return found.select(*PARTITION)


def uris_matching(topic_catalog: DataFrame, pattern: str) -> DataFrame:
    """The older form: the pattern must match the whole topic URI."""
    return topic_catalog.where(F.col("topic_uri").rlike(f"^(?:{pattern})$")).select(*PARTITION)


def chosen_by(topic_catalog: DataFrame, choose: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user function from catalog to the rows to subscribe to."""
    return choose(topic_catalog).select(*PARTITION).distinct()


def missing_partitions(topic_catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.select(*PARTITION).distinct().join(topic_catalog, PARTITION, "left_anti")


def explicit_partitions(topic_catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted set, or an error naming partitions that do not exist."""
    absent = missing_partitions(topic_catalog, wanted).limit(5).collect()
    if absent:
        raise ValueError(f"no such partition: {[tuple(r) for r in absent]}")
    return wanted.select(*PARTITION).distinct()


def subscribe(log: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted topics or partitions (semi-join; names few enough become a scan filter)."""
    on = [c for c in PARTITION if c in wanted.columns]
    side = checked_broadcast(wanted.select(*on).distinct())
    return side.narrow(log, "topic_uri").join(side.df, on, "left_semi")


def without(log: DataFrame, paused: DataFrame) -> DataFrame:
    """Rows of all partitions but the paused ones."""
    return log.join(checked_broadcast(paused.select(*PARTITION).distinct()).df, PARTITION, "left_anti")


def partition_changes(known: DataFrame, fetched: DataFrame) -> DataFrame:
    """Partitions that appeared or vanished between two catalogs."""
    new = fetched.select(*PARTITION).exceptAll(known.select(*PARTITION)).withColumn("change", F.lit("new"))
    gone = known.select(*PARTITION).exceptAll(fetched.select(*PARTITION)).withColumn("change", F.lit("removed"))
    return new.unionByName(gone)


def keep_subscribed(saved_offsets: DataFrame, wanted: DataFrame, enabled: bool = True) -> DataFrame:
    """Saved offsets of topics still subscribed; with `enabled=False` all are kept."""
    if not enabled:
        return saved_offsets
    return saved_offsets.join(wanted.select("topic_uri").distinct(), "topic_uri", "left_semi")


def union_topics(*logs: DataFrame) -> DataFrame:
    first, *rest = logs
    for other in rest:
        first = first.unionByName(other)
    return first
