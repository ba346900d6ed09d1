"""Queries over counters, histograms, lag, audits, event time and watermarks."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import headers as H
from tidelog.operators import eventtime, metrics, project, ranges, subscribe
from tidelog.operators.ordered import range_chunks
from tidelog.plans import fixture as fx
from tidelog.plans.catalog import query

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
AS_OF_MS = int(AS_OF.timestamp() * 1000)
_PCT = {name: p for name, p in metrics.HISTOGRAM_POINTS.items()}


def _quantiles(column: str) -> str:
    return ", ".join(f"round(quantile_cont({column}, {p}), 3) AS {name}" for name, p in _PCT.items())


def _basics(column: str) -> str:
    return (f"count({column}) AS n, min({column}) AS min_value, max({column}) AS max_value, round(avg({column}), 3) AS mean_value")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(f.name, 3).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema])


@query("a01_partition_counters", fx.sql(
    "SELECT topic_uri, part, count(*) AS n_messages, count(k) AS n_keyed, count(*) FILTER (v IS NULL) AS n_null_value "
    "FROM topic_log GROUP BY 1, 2"))
def a01(spark, sf):
    return fx.out(metrics.message_counters(fx.topic_log(spark, sf)))


@query("a02_topic_counters", fx.sql(
    "SELECT topic_uri, count(*) AS n_messages, count(k) AS n_keyed, count(*) FILTER (v IS NULL) AS n_null_value "
    "FROM topic_log GROUP BY 1"))
def a02(spark, sf):
    return metrics.message_counters(fx.topic_log(spark, sf), ["topic_uri"])


@query("a03_counters_by_level", fx.sql(
    "SELECT region, cluster, topic_uri, part, grouping(region, cluster, topic_uri, part) AS level, count(*) AS n_messages, "
    "count(k) AS n_keyed, count(*) FILTER (v IS NULL) AS n_null_value FROM (SELECT *, 'region1' AS region FROM topic_log) "
    "GROUP BY ROLLUP (region, cluster, topic_uri, part)"))
def a03(spark, sf):
    log = fx.topic_log(spark, sf)
    place = fx.catalog(spark, sf).select(
        "topic_uri", "partition", F.col("rn_parts.region").alias("region"), F.col("rn_parts.cluster").alias("cluster"))
    counts = metrics.message_counters(log).join(place, ["topic_uri", "partition"])
    return fx.out(metrics.roll_up_counters(counts))


@query("a04_size_histograms", fx.sql(
    f"SELECT topic_uri, side, {_basics('size')}, {_quantiles('size')} FROM ("
    "SELECT topic_uri, 'key' AS side, coalesce(strlen(k), -1) AS size FROM topic_log UNION ALL "
    "SELECT topic_uri, 'value', coalesce(strlen(v), -1) FROM topic_log) GROUP BY 1, 2"))
def a04(spark, sf):
    return _rounded(metrics.size_histograms(fx.topic_log(spark, sf), ["topic_uri"]))


_LAG = (
    f"CASE WHEN event_id % 19 = 0 OR event_id % 101 = 0 THEN {AS_OF_MS} - epoch_us(ts) // 1000 "
    f"WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 7 = 0 THEN ({AS_OF_MS} * 1000 - (epoch_us(ts) // 1000) * 1000) // 1000 "
    f"ELSE {AS_OF_MS} - epoch_us(ts) // 1000 END")


@query("a05_lag_histogram", fx.sql(
    f"SELECT topic_uri, part, {_basics('lag')}, {_quantiles('lag')} FROM (SELECT topic_uri, part, {_LAG} AS lag FROM topic_log) GROUP BY 1, 2"))
def a05(spark, sf):
    """Lag at a fixed instant; microsecond stamps are recognised, corrupt ones give no sample."""
    return fx.out(_rounded(metrics.lag_histogram(
        fx.topic_log(spark, sf), ["topic_uri", "partition"], F.lit(AS_OF_MS).cast("bigint"))))


@query("a06_consumer_lag", fx.sql(
    "SELECT 'g1' AS group_id, b.topic_uri, b.part, coalesce(g.next_offset, b.earliest) AS position, "
    "b.latest - coalesce(g.next_offset, b.earliest) AS lag FROM bounds b LEFT JOIN group_offsets g "
    "ON g.topic_uri = b.topic_uri AND g.part = b.part WHERE b.topic_uri IN (SELECT topic_uri FROM group_offsets)"))
def a06(spark, sf):
    log = fx.topic_log(spark, sf)
    return fx.out(metrics.consumer_lag(fx.bounds(spark, sf), fx.group_offsets(log)))


@query("a07_offset_gauges", fx.sql(
    "SELECT b.topic_uri, b.part, b.latest - 1 AS current_offset, g.next_offset AS committed_offset FROM bounds b "
    "LEFT JOIN group_offsets g ON g.topic_uri = b.topic_uri AND g.part = b.part"))
def a07(spark, sf):
    log = fx.topic_log(spark, sf)
    return fx.out(metrics.offset_gauges(log, fx.group_offsets(log), "g1"))


@query("a07_commit_counts", fx.sql(
    "SELECT topic_uri AS group_id, count(*) FILTER (event_id % 4 <> 0) AS n_succeeded, count(*) FILTER (event_id % 4 = 0) AS n_failed "
    "FROM topic_log GROUP BY 1"))
def a07_commits(spark, sf):
    e = fx.table(spark, sf, "events")
    topic = F.concat(F.lit(fx.CLUSTER), (F.col("user_id") % 2).cast("string"), F.lit(":"), "event_type")
    return metrics.commit_counts(e.select(topic.alias("group_id"), (F.col("event_id") % 4 != 0).alias("succeeded")))


@query("a08_first_offset", fx.sql(
    "SELECT topic_uri, part, arg_min(off, (arrived, off)) AS first_offset FROM (SELECT *, ts + to_seconds((off * 37 + part * 11) % 600) AS arrived FROM topic_log) GROUP BY 1, 2"))
def a08(spark, sf):
    """The offset of the message that each partition delivered first, by an arrival time that is not the log's order."""
    delay = F.make_dt_interval(secs=((F.col("offset") * 37 + F.col("partition") * 11) % 600).cast("decimal(18,6)"))
    log = fx.topic_log(spark, sf).withColumn("arrived", F.col("timestamp") + delay)
    return fx.out(metrics.first_offsets(log, ["arrived", "offset"]))


@query("a09_offset_histogram", fx.sql(
    f"SELECT topic_uri, {_basics('off')}, {_quantiles('off')} FROM topic_log GROUP BY 1"))
def a09(spark, sf):
    return _rounded(metrics.offset_histogram(fx.topic_log(spark, sf), ["topic_uri"]))


@query("a10_bytes_in", fx.sql(
    "SELECT topic_uri, CAST(sum(coalesce(strlen(k), 0) + coalesce(strlen(v), 0)) AS BIGINT) AS bytes_in FROM topic_log GROUP BY 1"))
def a10(spark, sf):
    return metrics.bytes_in(fx.topic_log(spark, sf), ["topic_uri"])


@query("a14_gaps", fx.sql(
    "SELECT topic_uri, part, off AS after, nxt - off - 1 AS n_missing FROM (SELECT topic_uri, part, off, "
    "lead(off) OVER (PARTITION BY topic_uri, part ORDER BY off) AS nxt FROM topic_log WHERE v IS NOT NULL) WHERE nxt - off > 1"))
def a14_gaps(spark, sf):
    """Offsets missing once tombstones are taken out."""
    rows = fx.topic_log(spark, sf).where(F.col("value").isNotNull())
    return fx.out(metrics.gaps(rows, ["topic_uri", "partition"], "offset", slice_rows=50))


@query("a14_duplicates", fx.sql(
    "SELECT id, count(*) AS n_seen FROM (SELECT event_id AS id FROM topic_log WHERE v IS NOT NULL UNION ALL "
    "SELECT event_id FROM topic_log WHERE v IS NOT NULL AND part = 1) GROUP BY 1 HAVING count(*) > 1"))
def a14_duplicates(spark, sf):
    """Ids delivered twice when one partition is replayed."""
    t = project.read_table(fx.topic_log(spark, sf), "event_id BIGINT", metadata_columns={"part": "partition"}, null_values="skip")
    ids = t.select(F.col("event_id").alias("id"), "part")
    return metrics.duplicates(ids.unionByName(ids.where("part = 1")), ["id"])


@query("a15_smallest_partition_count", fx.sql(
    "SELECT min(n) AS smallest FROM (SELECT topic_uri, count(DISTINCT part) AS n FROM topic_log GROUP BY 1)"))
def a15(spark, sf):
    return ranges.smallest_partition_count(fx.catalog(spark, sf))


@query("a17_produced_vs_acknowledged", fx.sql(
    "SELECT topic_uri, part, count(*) AS n_produced, count(*) FILTER (n < 2) AS n_acknowledged FROM isolated GROUP BY 1, 2", fx.ISOLATED_SQL))
def a17(spark, sf):
    """All rows written against those of transactions that have a marker."""
    log = fx.isolated(spark, sf)
    return fx.out(metrics.produced_vs_acknowledged(log.read("uncommitted"), log.read()))


# --- event time --------------------------------------------------------------------------------------------
@query("w01_tumble", fx.sql(
    "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_rows, "
    "max(cents) AS max_cents FROM topic_log WHERE v IS NOT NULL GROUP BY 1, 2"))
def w01(spark, sf):
    t = project.read_table(fx.topic_log(spark, sf), "cents BIGINT", metadata_columns={"ts": "timestamp"}, null_values="skip")
    w = eventtime.tumble(t, "ts", "1 hour", [F.count(F.lit(1)).alias("n_rows"), F.max("cents").alias("max_cents")])
    return fx.out(w)


@query("w02_tumble_by_partition", fx.sql(
    "SELECT part, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_rows "
    "FROM topic_log GROUP BY 1, 2, 3"))
def w02(spark, sf):
    log = fx.topic_log(spark, sf).withColumnRenamed("timestamp", "ts")
    return fx.out(eventtime.tumble(log, "ts", "1 hour", [F.count(F.lit(1)).alias("n_rows")], ["partition"]))


@query("w03_event_time", fx.sql(
    "SELECT topic_uri, part, off, CASE WHEN event_id % 19 = 0 OR event_id % 101 = 0 OR event_id % 97 = 0 THEN ts "
    "WHEN event_id % 7 = 0 THEN ts ELSE make_timestamp((epoch_us(ts) // 1000) * 1000) END AS event_ts FROM topic_log"))
def w03(spark, sf):
    """The produce header's time where it is a millisecond stamp, the publish time otherwise."""
    stamp = H.produce_timestamp(F.col("headers"))
    extracted = F.when(stamp < AS_OF_MS, F.timestamp_millis(stamp))
    log = fx.topic_log(spark, sf).withColumn("event_ts", eventtime.event_time(extracted, F.col("timestamp")))
    return fx.out(log.select("topic_uri", "partition", "offset", "event_ts"))


_SEEN = ("marks AS (SELECT *, max(ts) OVER (PARTITION BY topic_uri, part ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
         "- INTERVAL 2 MINUTE AS watermark FROM late_log)")


@query("w04_bounded_watermark", fx.sql("SELECT topic_uri, part, off, ts, watermark FROM marks", _SEEN))
def w04(spark, sf):
    log = eventtime.row_watermark(fx.late_log(spark, sf), "2 minutes", slice_rows=20)
    return fx.out(log.select("topic_uri", "partition", "offset", F.col("timestamp").alias("ts"), "watermark"))


@query("w05_overall_watermark", fx.sql(
    "SELECT topic_uri, min(m) AS watermark, count(*) AS n_partitions FROM (SELECT topic_uri, part, max(ts) AS m FROM topic_log GROUP BY 1, 2) GROUP BY 1"))
def w05(spark, sf):
    return fx.out(eventtime.overall_watermark(eventtime.partition_progress(fx.topic_log(spark, sf)), ["topic_uri"]))


@query("w06_idle_partitions", fx.sql(
    "SELECT min(m) AS watermark, count(*) AS n_partitions, cluster FROM (SELECT cluster, topic_uri, part, max(ts) AS m FROM topic_log GROUP BY 1, 2, 3) "
    "WHERE m >= TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 20 HOUR GROUP BY cluster"))
def w06(spark, sf):
    """Partitions silent for 20 hours do not hold the watermark back."""
    progress = eventtime.partition_progress(fx.topic_log(spark, sf)).withColumn(
        "cluster", F.element_at(F.split("topic_uri", ":"), -2))
    now = F.lit("2024-01-30 23:00:00").cast("timestamp")
    return fx.out(eventtime.overall_watermark(progress, ["cluster"], "20 hours", now))


@query("w07_late_rows", fx.sql("SELECT topic_uri, part, off, ts, watermark FROM marks WHERE ts < watermark", _SEEN))
def w07(spark, sf):
    late = eventtime.late_rows(fx.late_log(spark, sf), "2 minutes")
    return fx.out(late.select("topic_uri", "partition", "offset", F.col("timestamp").alias("ts"), "watermark"))


@query("w08_merged_watermark", fx.sql(
    "SELECT topic_uri, event_id, merged FROM (SELECT *, max(merged) OVER (PARTITION BY topic_uri ORDER BY arrived, event_id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT topic_uri, event_id, arrived, "
    "CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL AND p2 IS NOT NULL AND p3 IS NOT NULL THEN least(p0, p1, p2, p3) END AS merged FROM ("
    "SELECT topic_uri, event_id, arrived, " + ", ".join(
        f"max(CASE WHEN part = {p} THEN ts END) OVER (PARTITION BY topic_uri ORDER BY arrived, event_id) AS p{p}" for p in range(4)) +
    " FROM late_log))) WHERE merged IS NOT NULL AND (before IS NULL OR merged > before)"))
def w08(spark, sf):
    """Four producers write to each topic; a reader may advance to the least of their watermarks."""
    e = fx.table(spark, sf, "events")
    delay = F.make_dt_interval(secs=((F.col("event_id") * 37) % 600).cast("decimal(18,6)"))
    marks = e.select(
        F.concat(F.lit(fx.CLUSTER), (F.col("user_id") % 2).cast("string"), F.lit(":"), "event_type").alias("topic_uri"),
        F.floor((F.col("user_id") % 8) / 2.0).cast("int").alias("producer"),
        "event_id", (F.col("ts") + delay).alias("arrived"), F.col("ts").alias("watermark"))
    order = ["arrived", "event_id"]
    laid = range_chunks(marks, ["topic_uri", *order])
    merged = eventtime.merged_producer_watermark(laid, ["topic_uri"], order, "_chunk", "producer", "watermark", 4)
    return fx.out(merged.select("topic_uri", "event_id", "merged"))


def flagship(spark, sf_dir: str) -> DataFrame:
    """Pattern subscription, start by time, stop by offset, typed decode, metadata, hourly counts per topic."""
    log = fx.topic_log(spark, sf_dir)
    wanted = subscribe.topics_matching(fx.catalog(spark, sf_dir), "click|view|purchase")
    mine = subscribe.subscribe(log, wanted)
    known = subscribe.subscribe(fx.bounds(spark, sf_dir), wanted)
    piece = ranges.read_slice(mine, ranges.at_timestamp(datetime(2024, 1, 5), fx.store(spark, sf_dir)), ranges.latest(), known)
    t = project.read_table(
        piece, "user_id BIGINT, event_id BIGINT, cents BIGINT", metadata_columns={"topic_uri": "topic-uri", "ts": "timestamp"},
        null_values="skip")
    counts = [F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("sum_cents")]
    return fx.out(eventtime.tumble(t, "ts", "1 hour", counts, ["topic_uri"]))


@query("flagship_hourly_counts", fx.sql(
    "SELECT l.topic_uri, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, "
    "count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS sum_cents FROM topic_log l JOIN (SELECT topic_uri, part, min(off) AS f FROM topic_log "
    "WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' GROUP BY 1, 2) s ON s.topic_uri = l.topic_uri AND s.part = l.part "
    "WHERE l.off >= s.f AND event_type IN ('click', 'view', 'purchase') AND v IS NOT NULL GROUP BY 1, 2, 3"))
def flagship_query(spark, sf):
    return flagship(spark, sf)
