"""Per-topic and per-partition numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import headers as H
from tidelog.operators.ordered import next_row, offset_slice
from tidelog.operators.percentiles import histogram

PARTITION = ["topic_uri", "partition"]

# Points a histogram reports.
HISTOGRAM_POINTS = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_messages"), F.count("key").alias("n_keyed"),
        F.count_if(F.col("value").isNull()).alias("n_null_value"),
    ]


def message_counters(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    return log.groupBy(*(by or PARTITION)).agg(*_counters())


def roll_up_counters(counts: DataFrame) -> DataFrame:
    """Counters per partition, topic, cluster, region and in all, from rows per partition with `region` and `cluster`.

    The log is reduced to one row per partition first, so the levels cost nothing extra.
    """
    return counts.rollup("region", "cluster", "topic_uri", "partition").agg(
        F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in ("n_messages", "n_keyed", "n_null_value")])


def size_histograms(log: DataFrame, by: list[str], points: dict[str, float] | None = None) -> DataFrame:
    """Key and value sizes (-1 for null) per group, as rows `side` = key / value."""
    sizes = log.select(*by, F.explode(F.array(
        F.struct(F.lit("key").alias("side"), H.payload_size(F.col("key")).cast("bigint").alias("size")),
        F.struct(F.lit("value").alias("side"), H.payload_size(F.col("value")).cast("bigint").alias("size")),
    )).alias("_s")).select(*by, "_s.side", "_s.size")
    return histogram(sizes, [*by, "side"], "size", points or HISTOGRAM_POINTS)


def lag_histogram(log: DataFrame, by: list[str], as_of_ms: Column, points: dict[str, float] | None = None) -> DataFrame:
    published = F.unix_millis("timestamp")
    lags = log.select(*by, H.message_lag_ms(F.col("headers"), published, as_of_ms).alias("lag_ms"))
    return histogram(lags, by, "lag_ms", points or HISTOGRAM_POINTS)


def offset_histogram(log: DataFrame, by: list[str], points: dict[str, float] | None = None) -> DataFrame:
    return histogram(log.select(*by, "offset"), by, "offset", points or HISTOGRAM_POINTS)


def consumer_lag(bounds: DataFrame, group_offsets: DataFrame) -> DataFrame:
    """End offset minus position for every group that committed anything and every partition of the log."""
    groups = group_offsets.select("group_id", "topic_uri").distinct()
    wanted = bounds.join(groups, "topic_uri")
    mine = group_offsets.select("group_id", *PARTITION, "next_offset")
    position = F.coalesce("next_offset", "earliest")
    return wanted.join(mine, ["group_id", *PARTITION], "left").select(
        "group_id", *PARTITION, position.alias("position"), (F.col("latest") - position).alias("lag"))


def offset_gauges(log: DataFrame, group_offsets: DataFrame, group_id: str) -> DataFrame:
    """Current (last read) and committed offset per partition."""
    current = log.groupBy(*PARTITION).agg(F.max("offset").alias("current_offset"))
    mine = group_offsets.where(F.col("group_id") == group_id).select(
        *PARTITION, F.col("next_offset").alias("committed_offset"))
    return current.join(mine, PARTITION, "left")


def commit_counts(commits: DataFrame) -> DataFrame:
    """Commits that succeeded and failed per group; `commits` has a boolean `succeeded`."""
    return commits.groupBy("group_id").agg(
        F.count_if("succeeded").alias("n_succeeded"), F.count_if(~F.col("succeeded")).alias("n_failed"))


def first_offsets(log: DataFrame, arrival: list[str]) -> DataFrame:
    """The offset that arrived first, per partition."""
    return log.groupBy(*PARTITION).agg(F.min_by("offset", F.struct(*arrival)).alias("first_offset"))


def bytes_in(log: DataFrame, by: list[str]) -> DataFrame:
    size = F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))
    return log.groupBy(*by).agg(F.sum(size.cast("bigint")).alias("bytes_in"))


def duplicates(df: DataFrame, id_columns: list[str]) -> DataFrame:
    """Ids seen more than once."""
    return df.groupBy(*id_columns).agg(F.count(F.lit(1)).alias("n_seen")).where("n_seen > 1")


def gaps(df: DataFrame, keys: list[str], position: str, slice_rows: int | None = None) -> DataFrame:
    """Missing runs of a per-group sequence: last number before the gap, how many are missing."""
    sliced = df.select(*keys, position).withColumn("_slice", offset_slice(position, slice_rows))
    following = next_row(sliced, keys, [position], "_slice", "_next", [position])
    step = F.col(f"_next.{position}") - F.col(position)
    return following.where(step > 1).select(*keys, F.col(position).alias("after"), (step - 1).alias("n_missing"))


def produced_vs_acknowledged(outbox: DataFrame, acknowledged: DataFrame) -> DataFrame:
    """Rows handed to the sink against rows in committed transactions, per partition."""
    sent = outbox.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("n_produced"))
    done = acknowledged.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("n_acknowledged"))
    return sent.join(done, PARTITION, "full").select(
        *PARTITION, F.coalesce("n_produced", F.lit(0)).alias("n_produced"),
        F.coalesce("n_acknowledged", F.lit(0)).alias("n_acknowledged"))


def tag_summary(tagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per tag; `tagged` has an array column `tags`."""
    by = by or ["topic_uri"]
    return tagged.select(*by, F.explode("tags").alias("tag")).groupBy(*by, "tag").agg(F.count(F.lit(1)).alias("n_rows"))


def trim_commits(commits: DataFrame, keep: int) -> DataFrame:
    """The newest `keep` commit rows of every group (T04). Spark limits each task to `keep` rows before the shuffle."""
    newest = Window.partitionBy("group_id").orderBy(F.col("committed_at").desc(), F.col("commit_id").desc())
    return commits.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= keep).drop("_n")
