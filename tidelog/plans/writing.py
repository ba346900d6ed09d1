"""Queries that write a log and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog import constants as C
from tidelog.functions import headers as H
from tidelog.functions import partitioners
from tidelog.functions.binary import decode_integer
from tidelog.operators import produce
from tidelog.plans import fixture as fx
from tidelog.plans.catalog import query
from tidelog.session import scratch_dir
from tidelog.sources import datasource
from tidelog.sources.topiclog import TopicLog, outbox
from tidelog.streaming import shuffle

_ROW = "topic_uri, part, off, ts, k, v"


def _rows(df: DataFrame) -> DataFrame:
    return fx.out(df.select(
        "topic_uri", "partition", "offset", F.col("timestamp").alias("ts"), F.col("key").alias("k"),
        F.col("value").alias("v")))


def new_log(spark, name: str) -> TopicLog:
    return TopicLog(spark, scratch_dir(spark, name))


@query("k01_append", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def k01(spark, sf):
    """Two appends; the second continues every partition's offsets. Appending a transaction again changes nothing."""
    log = new_log(spark, "append")
    messages = fx._messages(spark, sf)
    middle = F.lit("2024-01-15").cast("timestamp")
    order = ["timestamp", "event_id"]
    log.append(messages.where(F.col("timestamp") < middle), "a-0", order)
    log.append(messages.where(F.col("timestamp") >= middle), "a-1", order)
    log.append(messages, "a-1", order)
    return _rows(log.read())


@query("k01_compaction", fx.sql(f"SELECT 'batch' AS how, {_ROW} FROM topic_log UNION ALL SELECT 'source', {_ROW} FROM topic_log"))
def k01_compaction(spark, sf):
    """Six appends, compacted after the third and again after the last, the replaced files dropped; read by Spark and
    through the source."""
    log, messages = new_log(spark, "compaction"), fx._messages(spark, sf)
    order, day = ["timestamp", "event_id"], F.dayofmonth("timestamp")
    for n in range(6):
        log.append(messages.where((day > 5 * n) & (day <= (5 * n + 5 if n < 5 else 31))), f"c-{n}", order)
        if n in (2, 5):
            log.compact()
    log.drop_replaced()
    log.append(messages, "c-1", order)  # committed before, so nothing happens
    datasource.register(spark)
    source = spark.read.format("topiclog").option("path", log.root).load()
    return _rows(log.read()).withColumn("how", F.lit("batch")).unionByName(_rows(source).withColumn("how", F.lit("source")))


@query("k05_abort_lingering", fx.sql(f"SELECT {_ROW} FROM topic_log WHERE ts < TIMESTAMP '2024-01-15 00:00:00'"))
def k05(spark, sf):
    """Staged work of a lost writer, also under its old prefix, is not seen and is dropped on restart."""
    log = new_log(spark, "abort")
    messages = fx._messages(spark, sf)
    middle = F.lit("2024-01-15").cast("timestamp")
    order = ["timestamp", "event_id"]
    log.append(messages.where(F.col("timestamp") < middle), "new-0", order)
    log.stage(messages.where(F.col("timestamp") >= middle), "old-7", order)
    log.abort_lingering(["new", "old"])
    return _rows(log.read("uncommitted"))


def _orders(spark, sf) -> DataFrame:
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("day"),
        F.encode(F.col("o_custkey").cast("string"), "UTF-8").alias("key"))


@query("k07_partition_by_key", (
    "SELECT CAST(o_custkey AS VARCHAR) AS k, 1 AS n_partitions, count(*) AS n_rows FROM orders GROUP BY 1"))
def k07(spark, sf):
    placed = _orders(spark, sf).withColumn("partition", partitioners.by_key(F.col("key"), 16))
    in_range = placed.where("partition BETWEEN 0 AND 15")
    return fx.out(in_range.groupBy(F.col("key").alias("k")).agg(
        F.countDistinct("partition").cast("int").alias("n_partitions"), F.count(F.lit(1)).alias("n_rows")))


@query("k07_keys_use_all_partitions", "SELECT count(*) AS n_rows, 8::BIGINT AS n_used FROM orders")
def k07_used(spark, sf):
    placed = _orders(spark, sf).withColumn("partition", partitioners.by_key(F.col("key"), 8))
    return placed.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("partition").alias("n_used"))


@query("k07_keyless_rows_spread", (
    "SELECT count(*) AS n_rows, true AS all_used FROM orders"))
def k07_spread(spark, sf):
    placed = _orders(spark, sf).withColumn("partition", partitioners.by_key(F.lit(None).cast("binary"), 4))
    return placed.groupBy("partition").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), (F.count(F.lit(1)) == 4).alias("all_used"))


@query("k08_partition_by_task", "SELECT count(*) AS n_rows, 0 AS n_split, 4::BIGINT AS n_used FROM orders")
def k08(spark, sf):
    """All rows of a task share one partition, and eight tasks use all four."""
    tasks = _orders(spark, sf).repartition(8)
    placed = tasks.withColumn("task", F.spark_partition_id()).withColumn("partition", partitioners.by_task(4))
    per_task = placed.groupBy("task").agg(
        F.countDistinct("partition").alias("p"), F.min("partition").alias("one"), F.count(F.lit(1)).alias("n"))
    return per_task.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("p") > 1).cast("int").alias("n_split"),
                        F.countDistinct("one").alias("n_used"))


@query("k09_round_robin", (
    "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 5 AS INT) AS part FROM orders"))
def k09(spark, sf):
    return fx.out(partitioners.round_robin(_orders(spark, sf), ["o_orderkey"], 5).select("o_orderkey", "partition"))


@query("k10_custom_partitioner", "SELECT o_orderkey, CAST(o_custkey % 7 AS INT) AS part FROM orders")
def k10(spark, sf):
    o = _orders(spark, sf)
    part = partitioners.custom(
        lambda row, key, value, topic, n: row["o_custkey"] % n, F.struct("o_custkey"), F.col("key"), F.lit(None), F.lit("t"), 7)
    return fx.out(o.select("o_orderkey", part.alias("partition")))


def _routed(spark, sf) -> TopicLog:
    log = new_log(spark, "routed")
    o = produce.route(_orders(spark, sf), F.concat(
        F.lit(fx.CLUSTER), F.lit("9:orders-"), F.lower(F.substring("o_orderpriority", 3, 20))))
    o = o.withColumn("topic_uri", F.regexp_replace("topic_uri", " ", "_")).withColumn(
        "partition", (F.col("o_custkey") % 4).cast("int"))
    value = produce.encode_columns(["o_orderkey", "o_orderpriority"])
    headers = H.set_headers(F.lit(None).cast("map<string,binary>"), {"origin": F.encode(F.lit("orders"), "UTF-8")})
    headers = H.stamp_produce_headers(headers, F.col("key"), value, F.unix_millis("day"))
    rows = outbox(o, F.col("topic_uri"), F.col("key"), value, F.col("day"), headers, keep=["partition", "o_orderkey"])
    log.append(rows, "route-0", ["o_orderkey"], tasks=8)
    return log


_ROUTED = """routed AS (
  SELECT 'plaintext:/rn:kafka:env:cloud_region1::cluster9:orders-' || replace(lower(substring(o_orderpriority, 3, 20)), ' ', '_') AS topic_uri,
         CAST(o_custkey % 4 AS INT) AS part, o_orderkey, CAST(o_custkey AS VARCHAR) AS k, o_orderdate AS ts,
         '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS v FROM orders),
sent AS (SELECT *, row_number() OVER (PARTITION BY topic_uri, part ORDER BY o_orderkey) - 1 AS off FROM routed)"""


@query("k11_topic_routing", fx.sql(f"SELECT {_ROW} FROM sent", _ROUTED))
def k11(spark, sf):
    """Each order goes to the topic of its priority; offsets are dense in every partition."""
    return _rows(_routed(spark, sf).read())


@query("k12_header_provider", fx.sql("SELECT topic_uri, part, off, 'orders' AS origin, 4 AS n_headers FROM sent", _ROUTED))
def k12(spark, sf):
    rows = _routed(spark, sf).read()
    return fx.out(rows.select("topic_uri", "partition", "offset",
                              H.header(F.col("headers"), "origin").cast("string").alias("origin"),
                              F.size("headers").alias("n_headers")))


@query("k14_writable_metadata", fx.sql(
    "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN epoch_us(ts) // 1000 END AS stamp_ms, "
    "1 + CAST(event_id % 3 = 0 AS INT) AS n_headers FROM topic_log"))
def k14(spark, sf):
    """A negative time is not written; headers without a value are dropped."""
    e = fx.table(spark, sf, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    given = F.when(F.col("event_id") % 5 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("ms"))
    some = F.create_map(F.lit("a"), F.encode(F.lit("1"), "UTF-8"),
                        F.lit("b"), F.when(F.col("event_id") % 3 == 0, F.encode(F.lit("2"), "UTF-8")))
    return e.select("event_id", H.writable_timestamp(given).alias("stamp_ms"),
                    F.size(H.writable_headers(some)).alias("n_headers"))


@query("k18_write_time", fx.sql(
    "SELECT event_id, ts AS event_time, true AS stamped_now FROM topic_log"))
def k18(spark, sf):
    e = fx.table(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    mine, now = produce.write_timestamp(F.col("at"), True), produce.write_timestamp(F.col("at"), False)
    return fx.out(e.select("event_id", mine.alias("event_time"), (now > F.lit("2024-06-01").cast("timestamp")).alias("stamped_now")))


@query("k19_sink_parallelism", fx.sql("SELECT count(*) AS n_rows, 3::BIGINT AS n_tasks FROM topic_log"))
def k19(spark, sf):
    """Rows, and the tasks that would write them when three are asked for."""
    placed = produce.sink_parallelism(fx.topic_log(spark, sf), 3).select(F.spark_partition_id().alias("task"))
    return placed.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("task").alias("n_tasks"))


@query("k20_produce_headers", fx.sql(
    "SELECT topic_uri, part, off, epoch_us(ts) // 1000 AS produced, CAST(strlen(k) AS INT) AS key_size, "
    "CAST(strlen(v) AS INT) AS value_size FROM sent", _ROUTED))
def k20(spark, sf):
    rows = _routed(spark, sf).read()
    h = F.col("headers")
    size = lambda name: decode_integer(H.header(h, name), 4).cast("int")
    return fx.out(rows.select(
        "topic_uri", "partition", "offset", H.produce_timestamp(h).alias("produced"),
        size(C.KEY_SIZE_HEADER).alias("key_size"), size(C.VALUE_SIZE_HEADER).alias("value_size")))


# --- persistent keyed shuffle ------------------------------------------------------------------------------
_SHUFFLED = fx.CLUSTER + "0:conversations"


def _shuffled(spark, sf) -> TopicLog:
    log = new_log(spark, "shuffle")
    c = fx.table(spark, sf, "conversations")
    when = F.when(F.col("turn") % 2 == 0, F.timestamp_seconds(F.col("conv_id") * 100 + F.col("turn")))
    for producer in range(2):
        mine = c.where(F.col("turn") % 2 == producer)
        reached = mine.agg(F.max(F.col("conv_id") * 100 + F.col("turn"))).first()[0]  # one number
        shuffle.write_key_by(
            mine, log, _SHUFFLED, F.encode(F.col("conv_id").cast("string"), "UTF-8"),
            F.encode("text", "UTF-8"), 8, f"w{producer}-0", ["conv_id", "turn"], record_time=when,
            published=F.lit("2024-03-01").cast("timestamp"), producer=producer,
            watermark=F.timestamp_seconds(F.lit(reached)))
    return log


@query("x07_shuffle_write", (
    "SELECT CAST(conv_id AS VARCHAR) AS k, text AS v FROM conversations"))
def x07(spark, sf):
    """Whole conversations through a keyed shuffle log, two producers."""
    return fx.out(shuffle.read_key_by(_shuffled(spark, sf), _SHUFFLED).select(F.col("key").alias("k"), F.col("value").alias("v")))


@query("x07_shuffle_watermarks", (
    "SELECT CAST(p AS INT) AS part, CAST(turn % 2 AS INT) AS producer, make_timestamp(max(conv_id * 100 + turn) * 1000000) AS watermark "
    "FROM range(8) t(p), conversations GROUP BY 1, 2"))
def x07_marks(spark, sf):
    """Every partition gets every producer's watermark, the highest record time it has written."""
    return fx.out(shuffle.watermarks(_shuffled(spark, sf)).drop("txn"))


@query("x09_key_in_one_partition", (
    "SELECT CAST(conv_id AS VARCHAR) AS k, 1 AS n_partitions, count(*) AS n_rows FROM conversations GROUP BY 1"))
def x09(spark, sf):
    rows = shuffle.read_key_by(_shuffled(spark, sf), _SHUFFLED)
    return fx.out(rows.groupBy(F.col("key").alias("k")).agg(
        F.countDistinct("partition").cast("int").alias("n_partitions"), F.count(F.lit(1)).alias("n_rows")))


@query("x10_record_time", (
    "SELECT CAST(conv_id AS VARCHAR) AS k, text AS v, CASE WHEN turn % 2 = 0 THEN make_timestamp((conv_id * 100 + turn) * 1000000) "
    "ELSE TIMESTAMP '2024-03-01 00:00:00' END AS record_time FROM conversations"))
def x10(spark, sf):
    rows = shuffle.read_key_by(_shuffled(spark, sf), _SHUFFLED)
    return fx.out(rows.select(F.col("key").alias("k"), F.col("value").alias("v"), "record_time"))
