"""Option mapping for reading and writing the same slices on Kafka. Needs Spark's Kafka package at run time."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_options(
    servers: str, topics: list[str] | None = None, pattern: str | None = None,
    partitions: dict[str, list[int]] | None = None,
    start: str | dict = "earliest", stop: str | dict | None = None,
    start_timestamp_ms: int | None = None, stop_timestamp_ms: int | None = None,
    rate: float | None = None, trigger_seconds: float = 1.0, min_partitions: int | None = None,
    isolation: str | None = None,
) -> dict[str, str]:
    """Options of format("kafka") for a subscription, start, stop, rate and isolation."""
    given = [x is not None for x in (topics, pattern, partitions)]
    if sum(given) != 1:
        raise ValueError("give exactly one of topics, pattern, partitions")
    opts = {"kafka.bootstrap.servers": servers, "includeHeaders": "true"}
    if topics is not None:
        opts["subscribe"] = ",".join(topics)
    elif pattern is not None:
        opts["subscribePattern"] = pattern
    else:
        opts["assign"] = json.dumps(partitions)
    text = lambda v: v if isinstance(v, str) else json.dumps(v)
    if start_timestamp_ms is not None:
        opts["startingTimestamp"] = str(start_timestamp_ms)
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        opts["startingOffsets"] = text(start)
    if stop_timestamp_ms is not None:
        opts["endingTimestamp"] = str(stop_timestamp_ms)
    elif stop is not None:
        opts["endingOffsets"] = text(stop)
    if rate is not None:
        opts["maxOffsetsPerTrigger"] = str(max(1, int(rate * trigger_seconds)))
    if min_partitions is not None:
        opts["minPartitions"] = str(min_partitions)
    if isolation is not None:
        opts["kafka.isolation.level"] = isolation
    return opts


def header_map(headers: Column) -> Column:
    """Kafka's list of headers as a map. A name may come several times; its last value counts."""
    last = F.filter(headers, lambda h, i: ~F.exists(F.slice(headers, i + 2, F.size(headers)), lambda x: x["key"] == h["key"]))
    return F.map_from_entries(F.transform(last, lambda h: F.struct(h["key"], h["value"])))


def read_log(spark: SparkSession, cluster_uri: str, streaming: bool = False, **options) -> DataFrame:
    """Kafka records as topic-log rows; `cluster_uri` ends in a colon and becomes the topics' prefix."""
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**read_options(**options)).load()
    return raw.select(
        F.concat(F.lit(cluster_uri), "topic").alias("topic_uri"), "partition", "offset", "timestamp", "key", "value",
        header_map(F.col("headers")).alias("headers"),
    )


def write_rows(outbox: DataFrame) -> DataFrame:
    """Outbox rows in the shape format("kafka") writes."""
    entries = F.transform(F.map_entries("headers"), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return outbox.select(
        F.element_at(F.split("topic_uri", ":", -1), -1).alias("topic"), "partition", "key", "value",
        entries.alias("headers"),
    )
