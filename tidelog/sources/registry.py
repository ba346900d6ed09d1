"""Logical streams: stream id -> clusters -> topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_DDL = (
    "streamId STRING, clusterMetadataList ARRAY<STRUCT<clusterId: STRING, bootstrapServers: STRING, "
    "clusterUriString: STRING, topics: ARRAY<STRING>>>"
)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """A registry of one JSON object per stream, as (stream_id, cluster_id, servers, cluster_uri, topic, topic_uri)."""
    return flatten_registry(spark.read.schema(REGISTRY_DDL).json(path))


def flatten_registry(registry: DataFrame) -> DataFrame:
    clusters = registry.select("streamId", F.explode("clusterMetadataList").alias("c"))
    topics = clusters.select(
        F.col("streamId").alias("stream_id"), F.col("c.clusterId").alias("cluster_id"),
        F.col("c.bootstrapServers").alias("servers"), F.col("c.clusterUriString").alias("cluster_uri"),
        F.explode("c.topics").alias("topic"),
    )
    return topics.withColumn("topic_uri", F.concat("cluster_uri", "topic"))


def describe_streams(streams: DataFrame, stream_ids: list[str] | None = None) -> DataFrame:
    """Clusters and topic count per stream."""
    if stream_ids is not None:
        streams = streams.where(F.col("stream_id").isin(stream_ids))
    return streams.groupBy("stream_id").agg(
        F.countDistinct("cluster_id").alias("n_clusters"), F.countDistinct("topic_uri").alias("n_topics"))


def active_clusters(streams: DataFrame) -> DataFrame:
    """A cluster is active while some stream names it."""
    return streams.select("cluster_id").distinct()


def single_cluster_streams(catalog: DataFrame, cluster: str | None = None) -> DataFrame:
    """Every topic of a cluster as a stream of the same name; `catalog` has rn_parts."""
    rows = catalog.select(
        F.col("rn_parts.topic").alias("stream_id"), F.col("rn_parts.cluster").alias("cluster_id"), "topic_uri",
    ).distinct()
    return rows.where(F.col("cluster_id") == cluster) if cluster else rows


def streams_named(streams: DataFrame, ids: list[str]) -> DataFrame:
    return streams.where(F.col("stream_id").isin(ids)).select("topic_uri").distinct()


def streams_matching(streams: DataFrame, pattern: str) -> DataFrame:
    """The pattern may match anywhere in the stream id."""
    return streams.where(F.col("stream_id").rlike(pattern)).select("topic_uri").distinct()


def topic_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(cluster_id, topic_uri, change) with change one of added, removed, common."""
    b = before.select("cluster_id", "topic_uri").distinct().withColumn("_b", F.lit(True))
    a = after.select("cluster_id", "topic_uri").distinct().withColumn("_a", F.lit(True))
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").otherwise("common")
    return b.join(a, ["cluster_id", "topic_uri"], "full").select("cluster_id", "topic_uri", change.alias("change"))
