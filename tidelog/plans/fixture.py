"""The topic log derived from the `events` table, in Spark (stored, transactional) and in SQL.

The log is written once per application and table folder through `TopicLog`, below the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import constants as C
from tidelog.functions.binary import encode_integer
from tidelog.functions.uri import with_uri_parts
from tidelog.session import scratch_dir
from tidelog.sources.registry import REGISTRY_DDL
from tidelog.sources.topiclog import TopicLog, outbox

CLUSTER = "plaintext:/rn:kafka:env:cloud_region1::cluster"

ISOLATED_SQL = """isolated AS (
  SELECT topic_uri, part, event_id % 3 AS n, 'p-' || CAST(event_id % 3 AS VARCHAR) AS txn, k,
         row_number() OVER (PARTITION BY topic_uri, part ORDER BY event_id % 3, ts, event_id) - 1 AS off FROM m)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    user = F.col("user_id")
    published = F.col("ts").cast("timestamp")
    body = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user_id":'), user.cast("string"),
        F.lit(',"event_type":"'), F.col("event_type"), F.lit('","cents":'), F.col("cents").cast("string"),
        F.lit(',"props":'), F.col("props"), F.lit("}"))
    key = F.when(F.col("event_id") % 13 != 12, F.encode(user.cast("string"), "UTF-8"))
    value = F.when(F.col("event_id") % 10 != 9, F.encode(body, "UTF-8"))
    rows = e.select(
        "event_id", "ts",
        F.concat(F.lit(CLUSTER), (user % 2).cast("string"), F.lit(":"), "event_type").alias("topic"),
        F.floor((user % 8) / 2.0).cast("int").alias("partition"),
        key.alias("k"), value.alias("v"), published.alias("published"))
    shaped = outbox(rows, F.col("topic"), F.col("k"), F.col("v"), F.col("published"), _headers(),
                    keep=["event_id", "partition"])
    return shaped


def _headers() -> Column:
    """Headers by the rules of the fixture: see HEADER_SQL for the same in SQL."""
    n, ms = F.col("event_id"), F.unix_millis("published")
    stamp = F.when(n % 7 == 0, ms * 1000).otherwise(ms)
    stamp_bytes = F.when(n % 97 == 0, encode_integer(stamp, 4)).otherwise(encode_integer(stamp, 8))
    key_size = F.coalesce(F.octet_length("k"), F.lit(-1))
    value_size = F.coalesce(F.octet_length("v"), F.lit(-1)) + F.when(n % 17 == 0, 1).otherwise(0)

    def entry(name: str, value: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("key"), value.alias("value")))

    entries = F.array_compact(F.array(
        entry("trace", F.encode(n.cast("string"), "UTF-8"), F.lit(True)),
        entry(C.PRODUCE_TIMESTAMP_HEADER, stamp_bytes, n % 101 != 0),
        entry(C.KEY_SIZE_HEADER, encode_integer(key_size, 4), n % 3 != 0),
        entry(C.VALUE_SIZE_HEADER, encode_integer(value_size, 4), n % 3 != 0),
    ))
    return F.when(n % 19 != 0, F.map_from_entries(entries))


_logs: dict[tuple[str, str, str], TopicLog] = {}


def _store(spark: SparkSession, sf_dir: str, kind: str) -> TopicLog:
    at = (spark.sparkContext.applicationId, sf_dir, kind)
    if at not in _logs:
        log = TopicLog(spark, scratch_dir(spark, f"log-{kind}"))
        messages = _messages(spark, sf_dir)
        if kind == "late":
            delay = F.make_dt_interval(secs=((F.col("event_id") * 37) % 600).cast("decimal(18,6)"))
            messages = messages.withColumn("arrived", F.col("timestamp") + delay)
            log.append(messages, "load-0", ["arrived", "event_id"])
        elif kind == "isolated":
            # three transactions, of which the last has no marker
            for n in range(3):
                part = messages.where(F.col("event_id") % 3 == n)
                (log.append if n < 2 else log.stage)(part, f"p-{n}", ["timestamp", "event_id"])
        else:
            log.append(messages, "load-0", ["timestamp", "event_id"])
        _logs[at] = log
    return _logs[at]


def store(spark: SparkSession, sf_dir: str) -> TopicLog:
    return _store(spark, sf_dir, "ordered")


def isolated(spark: SparkSession, sf_dir: str) -> TopicLog:
    """The rows in three transactions, the last of them staged and never committed; see ISOLATED_SQL."""
    return _store(spark, sf_dir, "isolated")


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in publish order."""
    return _store(spark, sf_dir, "ordered").read()


def late_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows appended in a disordered arrival sequence."""
    return _store(spark, sf_dir, "late").read()


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic partitions and the parts of their names, from the store's own ranges: no scan of the rows."""
    return with_uri_parts(store(spark, sf_dir).catalog())


def bounds(spark: SparkSession, sf_dir: str, kind: str = "ordered") -> DataFrame:
    """Earliest and end offsets, also from the store."""
    return _store(spark, sf_dir, kind).bounds()


def group_offsets(log: DataFrame) -> DataFrame:
    """Group g1 is half way through partitions 0-2 and never committed partition 3."""
    half = F.floor((F.max("offset") + 1) / 2).cast("bigint")
    return (
        log.where("partition <> 3").groupBy("topic_uri", "partition").agg(half.alias("next_offset"))
        .withColumn("group_id", F.lit("g1")).withColumn("committed_at", F.lit("2024-02-01").cast("timestamp"))
    )


STREAMS = [
    ("s0", "cluster0", "click"), ("s0", "cluster0", "view"), ("s0", "cluster1", "click"),
    ("s1", "cluster1", "purchase"), ("xs0x", "cluster0", "error"),
]


def registry(spark: SparkSession) -> DataFrame:
    """The stream registry as nested rows, one per stream, the way registry files hold it."""
    streams: dict[str, dict[str, list[str]]] = {}
    for stream, cluster, topic in STREAMS:
        streams.setdefault(stream, {}).setdefault(cluster, []).append(topic)
    rows = [
        (s, [(c, f"{c}:9092", f"plaintext:/rn:kafka:env:cloud_region1::{c}:", topics) for c, topics in by.items()])
        for s, by in streams.items()
    ]
    return spark.createDataFrame(rows, REGISTRY_DDL)


def out(df: DataFrame) -> DataFrame:
    """Rename to the short names results use and drop the zone of timestamps."""
    short = {"partition": "part", "offset": "off"}
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "timestamp":
            c = c.cast("timestamp_ntz")
        elif f.dataType.typeName() == "binary":
            c = c.cast("string")
        columns.append(c.alias(short.get(f.name, f.name)))
    return df.select(*columns)


# --- the same in SQL ---------------------------------------------------------------------------------------
_BASE_SQL = """
WITH b AS (
  SELECT 'plaintext:/rn:kafka:env:cloud_region1::cluster' || CAST(user_id % 2 AS VARCHAR) || ':' || event_type AS topic_uri,
         CAST(floor((user_id % 8) / 2.0) AS INT) AS part,
         ts, event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, props
  FROM events),
m AS (
  SELECT topic_uri, part, ts,
         CASE WHEN event_id % 13 = 12 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS k,
         CASE WHEN event_id % 10 = 9 THEN NULL ELSE
           '{"event_id":' || CAST(event_id AS VARCHAR) || ',"user_id":' || CAST(user_id AS VARCHAR) ||
           ',"event_type":"' || event_type || '","cents":' || CAST(cents AS VARCHAR) || ',"props":' || props || '}' END AS v,
         event_id, user_id, event_type, cents, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k,
         'cluster' || CAST(user_id % 2 AS VARCHAR) AS cluster
  FROM b),
topic_log AS (
  SELECT *, row_number() OVER (PARTITION BY topic_uri, part ORDER BY ts, event_id) - 1 AS off FROM m),
late_log AS (
  SELECT *, ts + to_seconds((event_id * 37) % 600) AS arrived,
         row_number() OVER (PARTITION BY topic_uri, part
                            ORDER BY ts + to_seconds((event_id * 37) % 600), event_id) - 1 AS off FROM m),
bounds AS (
  SELECT topic_uri, part, min(off) AS earliest, max(off) + 1 AS latest FROM topic_log GROUP BY topic_uri, part),
group_offsets AS (
  SELECT 'g1' AS group_id, topic_uri, part, CAST(floor((max(off) + 1) / 2) AS BIGINT) AS next_offset
  FROM topic_log WHERE part <> 3 GROUP BY topic_uri, part),
streams(stream_id, cluster_id, topic) AS (
  VALUES ('s0', 'cluster0', 'click'), ('s0', 'cluster0', 'view'), ('s0', 'cluster1', 'click'),
         ('s1', 'cluster1', 'purchase'), ('xs0x', 'cluster0', 'error')),
stream_topics AS (
  SELECT stream_id, cluster_id, 'plaintext:/rn:kafka:env:cloud_region1::' || cluster_id || ':' AS cluster_uri, topic,
         'plaintext:/rn:kafka:env:cloud_region1::' || cluster_id || ':' || topic AS topic_uri FROM streams)
"""


def sql(select: str, *ctes: str) -> str:
    """A query over the fixture's common tables."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"{_BASE_SQL.rstrip()}{extra}\n{select}"
