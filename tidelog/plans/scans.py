"""Queries over subscriptions, start and stop positions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.operators import metrics, produce, ranges, subscribe
from tidelog.plans import fixture as fx
from tidelog.plans.catalog import query
from tidelog.session import scratch_dir
from tidelog.sources import registry as reg
from tidelog.sources.topiclog import TopicLog

AT = datetime(2024, 1, 15, 12, 0, 0)
AT_SQL = "TIMESTAMP '2024-01-15 12:00:00'"
UNTIL = datetime(2024, 1, 20, 0, 0, 0)
UNTIL_SQL = "TIMESTAMP '2024-01-20 00:00:00'"
CLICK0 = fx.CLUSTER + "0:click"
SPEC_TEXT = "partition:0,offset:2;partition:1,offset:5"

_ROW = "topic_uri, part, off, ts, k, v"


def _rows(df: DataFrame) -> DataFrame:
    return fx.out(df.select(
        "topic_uri", "partition", "offset", F.col("timestamp").alias("ts"), F.col("key").alias("k"),
        F.col("value").alias("v")))


def _ids(df: DataFrame) -> DataFrame:
    return fx.out(df.select("topic_uri", "partition", "offset"))


def _bounds(df: DataFrame) -> DataFrame:
    return fx.out(df)


# --- scan and subscribe ------------------------------------------------------------------------------------
@query("s01_log_scan", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def s01(spark: SparkSession, sf: str) -> DataFrame:
    return _rows(fx.topic_log(spark, sf))


@query("s02_topic_list", fx.sql(f"SELECT {_ROW} FROM topic_log WHERE topic_uri IN "
                                f"('{CLICK0}', '{fx.CLUSTER}1:view')"))
def s02(spark, sf):
    return _rows(subscribe.by_topics(fx.topic_log(spark, sf), [CLICK0, fx.CLUSTER + "1:view"]))


@query("s03_topic_pattern", fx.sql(
    f"SELECT {_ROW} FROM topic_log WHERE regexp_full_match(split_part(topic_uri, ':', 8), 'c.*|view|purch') "
    "AND cluster = 'cluster1'"))
def s03(spark, sf):
    log = fx.topic_log(spark, sf)
    wanted = subscribe.topics_matching(fx.catalog(spark, sf), "c.*|view|purch", "cluster1")
    return _rows(subscribe.subscribe(log, wanted))


@query("s03_uri_pattern", fx.sql(
    f"SELECT {_ROW} FROM topic_log WHERE regexp_full_match(topic_uri, '.*cluster1:(click|err)')"))
def s03_uri(spark, sf):
    log = fx.topic_log(spark, sf)
    return _rows(subscribe.subscribe(log, subscribe.uris_matching(fx.catalog(spark, sf), ".*cluster1:(click|err)")))


@query("s04_partition_set", fx.sql(
    f"SELECT {_ROW} FROM topic_log WHERE (topic_uri = '{CLICK0}' AND part IN (0, 2)) "
    f"OR (topic_uri = '{fx.CLUSTER}1:view' AND part = 1)"))
def s04(spark, sf):
    log = fx.topic_log(spark, sf)
    wanted = spark.createDataFrame(
        [(CLICK0, 0), (CLICK0, 2), (fx.CLUSTER + "1:view", 1)], "topic_uri STRING, partition INT")
    return _rows(subscribe.subscribe(log, subscribe.explicit_partitions(fx.catalog(spark, sf), wanted)))


@query("s04_missing_partitions", fx.sql(
    "SELECT w.topic_uri, w.part FROM (SELECT DISTINCT topic_uri, part + 2 AS part FROM topic_log) w "
    "LEFT JOIN bounds b ON w.topic_uri = b.topic_uri AND w.part = b.part WHERE b.part IS NULL"))
def s04_missing(spark, sf):
    known = fx.catalog(spark, sf)
    wanted = known.select("topic_uri", (F.col("partition") + 2).alias("partition"))
    return fx.out(subscribe.missing_partitions(known, wanted))


@query("s05_custom_subscriber", fx.sql(
    f"SELECT {_ROW} FROM topic_log WHERE cluster = 'cluster0' AND part % 2 = 1"))
def s05(spark, sf):
    log = fx.topic_log(spark, sf)
    wanted = subscribe.chosen_by(
        fx.catalog(spark, sf), lambda c: c.where((F.col("rn_parts.cluster") == "cluster0") & (F.col("partition") % 2 == 1)))
    return _rows(subscribe.subscribe(log, wanted))


@query("s06_stream_set", fx.sql(
    f"SELECT {_ROW} FROM topic_log WHERE topic_uri IN (SELECT topic_uri FROM stream_topics WHERE stream_id IN ('s0', 's1'))"))
def s06(spark, sf):
    streams = reg.flatten_registry(fx.registry(spark))
    return _rows(subscribe.subscribe(fx.topic_log(spark, sf), reg.streams_named(streams, ["s0", "s1"])))


@query("s07_stream_pattern", fx.sql(
    f"SELECT {_ROW} FROM topic_log WHERE topic_uri IN (SELECT topic_uri FROM stream_topics WHERE regexp_matches(stream_id, 's0'))"))
def s07(spark, sf):
    streams = reg.flatten_registry(fx.registry(spark))
    return _rows(subscribe.subscribe(fx.topic_log(spark, sf), reg.streams_matching(streams, "s0")))


@query("s08_registry_volume", fx.sql(
    "SELECT s.stream_id, count(DISTINCT s.cluster_id) AS n_clusters, count(DISTINCT s.topic_uri) AS n_topics, "
    "count(*) AS n_rows FROM stream_topics s JOIN topic_log l ON s.topic_uri = l.topic_uri GROUP BY s.stream_id"))
def s08(spark, sf):
    """Streams described, with the rows their topics hold now."""
    streams = reg.flatten_registry(fx.registry(spark))
    described = reg.describe_streams(streams)
    volume = fx.topic_log(spark, sf).groupBy("topic_uri").agg(F.count(F.lit(1)).alias("n"))
    per_stream = streams.join(volume, "topic_uri").groupBy("stream_id").agg(F.sum("n").alias("n_rows"))
    return described.join(per_stream, "stream_id")


@query("s08_active_clusters", fx.sql(
    "SELECT l.cluster AS cluster_id, count(*) AS n_rows FROM topic_log l "
    "WHERE l.cluster IN (SELECT cluster_id FROM streams) GROUP BY 1"))
def s08_active(spark, sf):
    active = reg.active_clusters(reg.flatten_registry(fx.registry(spark)))
    log = fx.catalog(spark, sf).select(
        F.col("rn_parts.cluster").alias("cluster_id"), "topic_uri", "partition").join(active, "cluster_id", "left_semi")
    rows = fx.topic_log(spark, sf).groupBy("topic_uri", "partition").agg(F.count(F.lit(1)).alias("n"))
    return log.join(rows, ["topic_uri", "partition"]).groupBy("cluster_id").agg(F.sum("n").alias("n_rows"))


@query("s09_single_cluster_registry", fx.sql(
    "SELECT DISTINCT split_part(topic_uri, ':', 8) AS stream_id, cluster AS cluster_id, topic_uri FROM topic_log"))
def s09(spark, sf):
    return reg.single_cluster_streams(fx.catalog(spark, sf))


# --- start positions ---------------------------------------------------------------------------------------
@query("s10_start_earliest", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def s10(spark, sf):
    return _rows(ranges.read_slice(fx.topic_log(spark, sf), ranges.earliest(), known=fx.bounds(spark, sf)))


@query("s11_start_latest", fx.sql(f"SELECT {_ROW} FROM topic_log WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'"))
def s11(spark, sf):
    """The ends are taken, rows are appended, and reading from the ends gives those rows."""
    log, messages = TopicLog(spark, scratch_dir(spark, "latest")), fx._messages(spark, sf)
    middle, order = F.lit("2024-01-15").cast("timestamp"), ["timestamp", "event_id"]
    log.append(messages.where(F.col("timestamp") < middle), "l-0", order)
    known = log.catalog().join(log.bounds(), ["topic_uri", "partition"])
    ends = ranges.resolve(log.read(), ranges.latest(), known=known)
    log.append(messages.where(F.col("timestamp") >= middle), "l-1", order)
    return _rows(ranges.cut(log.read(), ends))


@query("s12_start_committed", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN bounds b ON l.topic_uri = b.topic_uri AND l.part = b.part "
    "LEFT JOIN group_offsets g ON g.topic_uri = l.topic_uri AND g.part = l.part "
    "WHERE l.off >= coalesce(g.next_offset, b.earliest)"))
def s12(spark, sf):
    log = fx.topic_log(spark, sf)
    return _ids(ranges.read_slice(log, ranges.committed(fx.group_offsets(log), "g1", "earliest"), known=fx.bounds(spark, sf)))


@query("s12_start_committed_reset_latest", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN group_offsets g "
    "ON g.topic_uri = l.topic_uri AND g.part = l.part WHERE l.off >= g.next_offset"))
def s12_latest(spark, sf):
    log = fx.topic_log(spark, sf)
    return _ids(ranges.read_slice(log, ranges.committed(fx.group_offsets(log), "g1", "latest"), known=fx.bounds(spark, sf)))


@query("s13_start_timestamp", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM late_log l JOIN "
    f"(SELECT topic_uri, part, min(off) AS f FROM late_log WHERE ts >= {AT_SQL} GROUP BY 1, 2) s "
    "ON s.topic_uri = l.topic_uri AND s.part = l.part WHERE l.off >= s.f"))
def s13(spark, sf):
    return _ids(ranges.read_slice(
        fx.late_log(spark, sf), ranges.at_timestamp(AT, fx._store(spark, sf, "late")), known=fx.bounds(spark, sf, "late")))


_SPEC = ("spec(topic_uri, part, next_offset) AS "
         f"(VALUES ('{CLICK0}', 0, 2), ('{CLICK0}', 1, 5))")


@query("s14_start_specific", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN bounds b ON l.topic_uri = b.topic_uri AND l.part = b.part "
    "LEFT JOIN spec s ON s.topic_uri = l.topic_uri AND s.part = l.part "
    "LEFT JOIN group_offsets g ON g.topic_uri = l.topic_uri AND g.part = l.part "
    "WHERE l.off >= coalesce(s.next_offset, g.next_offset, b.earliest)", _SPEC))
def s14(spark, sf):
    log = fx.topic_log(spark, sf)
    given = ranges.offsets_from_text(spark, [CLICK0], SPEC_TEXT)
    return _ids(ranges.read_slice(
        log, ranges.specific(given, fx.group_offsets(log), "g1"), known=fx.bounds(spark, sf)))


# --- stop positions ----------------------------------------------------------------------------------------
@query("s16_stop_latest", fx.sql("SELECT topic_uri, part, off FROM topic_log"))
def s16(spark, sf):
    return _ids(ranges.read_slice(fx.topic_log(spark, sf), ranges.earliest(), ranges.latest(), fx.bounds(spark, sf)))


@query("s17_stop_committed", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN ("
    "SELECT topic_uri, part, next_offset FROM group_offsets UNION ALL SELECT topic_uri, part, latest // 5 FROM bounds WHERE part = 3) g "
    "ON g.topic_uri = l.topic_uri AND g.part = l.part WHERE l.off < g.next_offset"))
def s17(spark, sf):
    """Every partition up to its own commit; partition 3 is committed late, a fifth of the way."""
    log = fx.topic_log(spark, sf)
    late = fx.bounds(spark, sf).where("partition = 3").select(
        F.lit("g1").alias("group_id"), "topic_uri", "partition", F.floor(F.col("latest") / 5).cast("bigint").alias("next_offset"),
        F.lit("2024-02-02").cast("timestamp").alias("committed_at"))
    committed = fx.group_offsets(log).unionByName(late)
    return _ids(ranges.read_slice(log, ranges.earliest(), ranges.committed_only(committed, "g1"), fx.bounds(spark, sf)))


@query("s18_stop_timestamp", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM late_log l LEFT JOIN "
    f"(SELECT topic_uri, part, min(off) AS f FROM late_log WHERE ts >= {UNTIL_SQL} GROUP BY 1, 2) s "
    "ON s.topic_uri = l.topic_uri AND s.part = l.part WHERE s.f IS NULL OR l.off < s.f"))
def s18(spark, sf):
    """By position: rows behind the first late-enough one are cut even if they are older."""
    return _ids(ranges.read_slice(
        fx.late_log(spark, sf), ranges.earliest(), ranges.at_timestamp(UNTIL, fx._store(spark, sf, "late")),
        fx.bounds(spark, sf, "late")))


@query("s19_stop_specific", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l LEFT JOIN spec s ON s.topic_uri = l.topic_uri AND s.part = l.part "
    "JOIN bounds b ON b.topic_uri = l.topic_uri AND b.part = l.part WHERE l.off < coalesce(s.next_offset, b.latest)", _SPEC))
def s19(spark, sf):
    """Given stops where there are any, the end of the partition elsewhere."""
    stop = ranges.specific(ranges.offsets_from_text(spark, [CLICK0], SPEC_TEXT), reset="latest")
    return _ids(ranges.read_slice(fx.topic_log(spark, sf), ranges.earliest(), stop, fx.bounds(spark, sf)))


@query("s20_empty_ranges_removed", fx.sql(
    "SELECT b.topic_uri, b.part, f AS start, next_offset AS stop FROM group_offsets g JOIN bounds b "
    "ON b.topic_uri = g.topic_uri AND b.part = g.part JOIN "
    f"(SELECT b.topic_uri, b.part, coalesce(min(l.off), min(b.latest)) AS f FROM bounds b LEFT JOIN topic_log l "
    f"ON l.topic_uri = b.topic_uri AND l.part = b.part AND l.ts >= {AT_SQL} GROUP BY 1, 2) s "
    "ON s.topic_uri = g.topic_uri AND s.part = g.part WHERE s.f < g.next_offset"))
def s20(spark, sf):
    log = fx.topic_log(spark, sf)
    stop = ranges.committed(fx.group_offsets(log), "g1", "earliest")
    return fx.out(ranges.resolve(log, ranges.at_timestamp(AT, fx.store(spark, sf)), stop, fx.bounds(spark, sf)))


@query("s21_offset_text", fx.sql(
    "SELECT topic_uri, CAST(regexp_extract(p, 'partition:(\\d+),offset:(\\d+)', 1) AS INT) AS part, "
    "CAST(regexp_extract(p, 'partition:(\\d+),offset:(\\d+)', 2) AS BIGINT) AS next_offset FROM "
    "(SELECT topic_uri, unnest(string_split(txt, ';')) AS p FROM "
    "(SELECT topic_uri, string_agg('partition:' || part || ',offset:' || latest, ';') AS txt FROM bounds GROUP BY 1))"))
def s21(spark, sf):
    """Positions written as offset text, one text per topic, and read back."""
    ends = fx.bounds(spark, sf)
    piece = F.concat(F.lit("partition:"), F.col("partition").cast("string"), F.lit(",offset:"), F.col("latest").cast("string"))
    texts = ends.groupBy("topic_uri").agg(F.array_join(F.collect_list(piece), ";").alias("txt"))
    return fx.out(ranges.offset_text_columns(texts, "topic_uri", "txt"))


@query("s23_partition_changes", fx.sql(
    "SELECT DISTINCT topic_uri, part, 'new' AS change FROM topic_log t WHERE NOT EXISTS "
    f"(SELECT 1 FROM topic_log o WHERE o.topic_uri = t.topic_uri AND o.part = t.part AND o.ts < {AT_SQL} AND o.part < 3) "
    "UNION ALL SELECT topic_uri, part + 4, 'removed' FROM bounds WHERE part = 0"))
def s23(spark, sf):
    """What is there now comes from the store; what was there at a time, from the first times of its files."""
    store = fx.store(spark, sf)
    early = F.min("min_timestamp") < F.lit(AT)
    older = store.ranges().where("partition < 3").groupBy("topic_uri", "partition").agg(early.alias("early")).where("early").drop("early")
    now = store.catalog()
    gone = now.where("partition = 0").select("topic_uri", (F.col("partition") + 4).alias("partition"))
    return fx.out(subscribe.partition_changes(older.unionByName(gone), now))


@query("s26_rescale", fx.sql("SELECT count(*) AS n_rows, 19::BIGINT AS n_tasks FROM topic_log"))
def s26(spark, sf):
    """Rows, and the tasks they are in after 19 were asked for; the topics have four partitions."""
    log = fx.topic_log(spark, sf)
    wide = ranges.rescale(log, 19, fx.catalog(spark, sf))
    return wide.select(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("task").alias("n_tasks"))


@query("s27_read_committed", fx.sql(
    "SELECT 'committed' AS isolation, topic_uri, part, off, txn FROM isolated WHERE n < 2 UNION ALL "
    "SELECT 'uncommitted', topic_uri, part, off, txn FROM isolated", fx.ISOLATED_SQL))
def s27(spark, sf):
    """The log's own two readings; one transaction was staged and has no marker."""
    log = fx.isolated(spark, sf)
    seen = [log.read(how, with_txn=True).select(F.lit(how).alias("isolation"), "topic_uri", "partition", "offset", "txn")
            for how in ("committed", "uncommitted")]
    return fx.out(seen[0].unionByName(seen[1]))


@query("s28_interleaved", fx.sql(
    "SELECT topic_uri, part, off, off AS turn, row_number() OVER (ORDER BY off, topic_uri, part) - 1 AS position FROM topic_log"))
def s28(spark, sf):
    merged = produce.interleave(fx.topic_log(spark, sf), ["topic_uri", "partition"], ["offset"])
    return fx.out(merged.select("topic_uri", "partition", "offset", "turn", "position"))


@query("s29_paused", fx.sql("SELECT topic_uri, part, off FROM topic_log WHERE NOT (part = 1 AND cluster = 'cluster0')"))
def s29(spark, sf):
    log = fx.topic_log(spark, sf)
    paused = fx.catalog(spark, sf).where((F.col("partition") == 1) & (F.col("rn_parts.cluster") == "cluster0"))
    return _ids(subscribe.without(log, paused))


_SEEK = (
    "targets AS (SELECT topic_uri, part, CASE part WHEN 0 THEN 'after' WHEN 1 THEN 'timestamp' WHEN 2 THEN 'offset' "
    "ELSE 'end' END AS kind FROM bounds)"
)


@query("s30_seek", fx.sql(
    "SELECT b.topic_uri, b.part, CASE kind WHEN 'after' THEN 8 WHEN 'offset' THEN 3 WHEN 'end' THEN b.latest ELSE "
    f"coalesce((SELECT min(off) FROM topic_log l WHERE l.topic_uri = b.topic_uri AND l.part = b.part AND ts >= {AT_SQL}), b.latest) "
    "END AS start FROM bounds b JOIN targets t ON t.topic_uri = b.topic_uri AND t.part = b.part", _SEEK))
def s30(spark, sf):
    store, p = fx.store(spark, sf), F.col("partition")
    targets = store.catalog().select(
        "topic_uri", "partition",
        F.when(p == 0, "after").when(p == 1, "timestamp").when(p == 2, "offset").otherwise("end").alias("kind"),
        F.when(p == 0, 7).when(p == 1, F.unix_micros(F.lit(AT).cast("timestamp"))).when(p == 2, 3).cast("bigint").alias("target"))
    return fx.out(ranges.resolve(store.read(), ranges.seek(targets, store), known=store.bounds()).drop("stop"))


@query("s31_partition_batches", fx.sql(
    "SELECT topic_uri, part, count(*) AS n_rows, min(off) AS first_off, max(off) AS last_off FROM topic_log GROUP BY 1, 2"))
def s31(spark, sf):
    """What each partition contributed to a polled batch."""
    return fx.out(fx.topic_log(spark, sf).groupBy("topic_uri", "partition").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("offset").alias("first_off"), F.max("offset").alias("last_off")))


@query("s31_one_partition", fx.sql(f"SELECT {_ROW} FROM topic_log WHERE topic_uri = '{CLICK0}' AND part = 2"))
def s31_one(spark, sf):
    return _rows(fx.topic_log(spark, sf).where((F.col("topic_uri") == CLICK0) & (F.col("partition") == 2)))


@query("s32_poll_cap", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN group_offsets g ON g.topic_uri = l.topic_uri AND g.part = l.part "
    "WHERE l.off >= g.next_offset QUALIFY row_number() OVER (PARTITION BY l.topic_uri, l.part ORDER BY l.off) <= 25"))
def s32(spark, sf):
    log = fx.topic_log(spark, sf)
    start = fx.group_offsets(log).select("topic_uri", "partition", F.col("next_offset").alias("start"))
    return _ids(ranges.poll(log, 25, start, store=fx.store(spark, sf)))


@query("s33_topic_catalog", fx.sql(
    "SELECT topic_uri, cluster, split_part(topic_uri, ':', 8) AS topic, count(DISTINCT part) AS n_partitions "
    "FROM topic_log GROUP BY 1, 2, 3"))
def s33(spark, sf):
    c = fx.catalog(spark, sf)
    return c.groupBy("topic_uri", F.col("rn_parts.cluster").alias("cluster"), F.col("rn_parts.topic").alias("topic")).agg(
        F.countDistinct("partition").alias("n_partitions"))


@query("s34_offset_listing", fx.sql(
    "SELECT b.topic_uri, b.part, b.earliest, b.latest, "
    "coalesce(s.f, b.latest) AS at_time, g.next_offset AS committed FROM bounds b LEFT JOIN "
    f"(SELECT topic_uri, part, min(off) AS f FROM topic_log WHERE ts >= {AT_SQL} GROUP BY 1, 2) s "
    "ON s.topic_uri = b.topic_uri AND s.part = b.part LEFT JOIN group_offsets g "
    "ON g.topic_uri = b.topic_uri AND g.part = b.part"))
def s34(spark, sf):
    """Bounds from the store, the time from one file of each partition, and what the group has committed."""
    store, both = fx.store(spark, sf), ["topic_uri", "partition"]
    known = store.bounds()
    at = ranges.at_timestamp(AT, store)(store.read(), known).withColumnRenamed("position", "at_time")
    mine = fx.group_offsets(store.read()).select(*both, F.col("next_offset").alias("committed"))
    return fx.out(known.join(at, both).join(mine, both, "left").select(*both, "earliest", "latest", "at_time", "committed"))


@query("s34_bounds_from_store", fx.sql("SELECT topic_uri, part, earliest, latest FROM bounds"))
def s34_store(spark, sf):
    """The same bounds from the ranges each transaction recorded."""
    return fx.out(fx.store(spark, sf).bounds())


# --- joins with subscriptions and ranges -------------------------------------------------------------------
@query("j03_subscription_semi_join", fx.sql(
    "SELECT topic_uri, part, off FROM topic_log WHERE topic_uri IN (SELECT topic_uri FROM bounds WHERE part = 3 AND latest > 20)"))
def j03(spark, sf):
    log = fx.topic_log(spark, sf)
    wanted = fx.bounds(spark, sf).where("partition = 3 AND latest > 20").select("topic_uri")
    return _ids(subscribe.subscribe(log, wanted))


@query("j04_restored_offsets", fx.sql(
    "SELECT topic_uri, part, next_offset FROM group_offsets WHERE topic_uri IN (SELECT topic_uri FROM stream_topics)"))
def j04(spark, sf):
    saved = fx.group_offsets(fx.topic_log(spark, sf)).select("topic_uri", "partition", "next_offset")
    return fx.out(subscribe.keep_subscribed(saved, reg.flatten_registry(fx.registry(spark))))


@query("j05_offset_range_join", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN bounds b ON b.topic_uri = l.topic_uri AND b.part = l.part "
    "WHERE l.off >= b.latest // 4 AND l.off < b.latest // 2"))
def j05(spark, sf):
    log = fx.topic_log(spark, sf)
    part = ["topic_uri", "partition"]
    quarter = fx.bounds(spark, sf).select(
        *part, F.floor(F.col("latest") / 4).cast("bigint").alias("start"), F.floor(F.col("latest") / 2).cast("bigint").alias("stop"))
    return _ids(ranges.cut(log, quarter))


# --- order -------------------------------------------------------------------------------------------------
@query("t01_partition_order", fx.sql("SELECT topic_uri, part, count(*) AS n_rows, 0::BIGINT AS n_behind FROM topic_log GROUP BY 1, 2"))
def t01(spark, sf):
    """Rows that come in any order; after the operator none stands behind a later one of its partition in a task."""
    mixed = fx.topic_log(spark, sf).repartition(8, F.xxhash64("offset", "key")).sortWithinPartitions(F.xxhash64("offset", "key"))
    ordered = produce.in_partition_order(mixed).select("topic_uri", "partition", "offset", F.spark_partition_id().alias("task"),
                                                       F.monotonically_increasing_id().alias("place"))
    before = F.lag("offset").over(Window.partitionBy("task", "topic_uri", "partition").orderBy("place"))
    behind = ordered.withColumn("behind", F.coalesce(before > F.col("offset"), F.lit(False)))
    return fx.out(behind.groupBy("topic_uri", "partition").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("behind").alias("n_behind")))


@query("t02_first_n", fx.sql("SELECT topic_uri, part, off FROM topic_log WHERE off < 10"))
def t02(spark, sf):
    return _ids(ranges.poll(fx.topic_log(spark, sf), 10, store=fx.store(spark, sf)))


@query("t03_fair_merge", fx.sql(
    "SELECT cluster, topic_uri, part, off, row_number() OVER (ORDER BY turn, cluster) - 1 AS position FROM "
    "(SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY ts, event_id) - 1 AS turn FROM topic_log)"))
def t03(spark, sf):
    """Clusters merged fairly: each gives its next row by publish time."""
    cluster = F.element_at(F.split("topic_uri", ":"), -2)
    log = fx.topic_log(spark, sf).withColumn("cluster", cluster)
    merged = produce.interleave(log, ["cluster"], ["timestamp", "topic_uri", "partition", "offset"])
    return fx.out(merged.select("cluster", "topic_uri", "partition", "offset", "position"))


@query("t04_newest_commits", fx.sql(
    "SELECT topic_uri || '|' || part AS group_id, off AS commit_id, ts AS committed_at FROM topic_log "
    "QUALIFY row_number() OVER (PARTITION BY topic_uri, part ORDER BY ts DESC, off DESC) <= 3"))
def t04(spark, sf):
    commits = fx.topic_log(spark, sf).select(
        F.concat_ws("|", "topic_uri", F.col("partition").cast("string")).alias("group_id"), F.col("offset").alias("commit_id"), F.col("timestamp").alias("committed_at"))
    return fx.out(metrics.trim_commits(commits, 3))


# --- set operations ----------------------------------------------------------------------------------------
@query("u01_union", fx.sql(
    "SELECT topic_uri, CAST(k AS VARCHAR) AS k, ts FROM topic_log UNION ALL "
    "SELECT 'plaintext:/rn:kafka:env:cloud_region1::cluster2:orders', CAST(o_custkey AS VARCHAR), o_orderdate FROM orders"))
def u01(spark, sf):
    """Topics of two clusters and a third one as one stream."""
    log = fx.topic_log(spark, sf).select("topic_uri", F.col("key").cast("string").alias("k"), F.col("timestamp").alias("ts"))
    one, two = log.where(F.col("topic_uri").contains("cluster0:")), log.where(~F.col("topic_uri").contains("cluster0:"))
    orders = fx.table(spark, sf, "orders").select(
        F.lit(fx.CLUSTER + "2:orders").alias("topic_uri"), F.col("o_custkey").cast("string").alias("k"),
        F.col("o_orderdate").cast("timestamp").alias("ts"))
    return fx.out(subscribe.union_topics(one, two, orders))


@query("u04_partition_difference", fx.sql(
    f"SELECT topic_uri, part FROM bounds EXCEPT SELECT topic_uri, part FROM topic_log WHERE topic_uri = '{CLICK0}' OR part = 2"))
def u04(spark, sf):
    now = fx.store(spark, sf).catalog()
    known = now.where((F.col("topic_uri") == CLICK0) | (F.col("partition") == 2))
    return fx.out(subscribe.partition_changes(known, now).drop("change"))


@query("u05_cluster_topic_changes", fx.sql(
    "SELECT coalesce(a.cluster_id, b.cluster_id) AS cluster_id, coalesce(a.topic_uri, b.topic_uri) AS topic_uri, "
    "CASE WHEN b.topic_uri IS NULL THEN 'added' WHEN a.topic_uri IS NULL THEN 'removed' ELSE 'common' END AS change "
    "FROM (SELECT DISTINCT cluster AS cluster_id, topic_uri FROM topic_log WHERE event_type <> 'view') a FULL JOIN "
    "(SELECT DISTINCT cluster_id, topic_uri FROM stream_topics) b ON a.cluster_id = b.cluster_id AND a.topic_uri = b.topic_uri"))
def u05(spark, sf):
    before = reg.flatten_registry(fx.registry(spark))
    after = reg.single_cluster_streams(fx.catalog(spark, sf)).where("stream_id <> 'view'")
    return reg.topic_changes(before, after)
