"""Queries over projections, metadata and payload decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import constants as C
from tidelog.functions import binary, cdc, uri
from tidelog.functions import headers as H
from tidelog.functions import offsets as composite
from tidelog.operators import metrics, project, ranges
from tidelog.operators.ordered import offset_slice, previous_row, rank
from tidelog.plans import fixture as fx
from tidelog.plans.catalog import query

VALUE_DDL = "event_id BIGINT, user_id BIGINT, event_type STRING, cents BIGINT, props STRUCT<k: BIGINT>"
_WITH_VALUE = "v IS NOT NULL"


def _table(spark, sf, *args, **kwargs) -> DataFrame:
    """A table over the log's messages that have a value."""
    return project.read_table(fx.topic_log(spark, sf), *args, null_values="skip", **kwargs)


# --- projections -------------------------------------------------------------------------------------------
@query("p01_key_prefix", fx.sql(
    f"SELECT topic_uri, off, CAST(k AS BIGINT) AS k_user_id, cents FROM topic_log WHERE {_WITH_VALUE}"))
def p01(spark, sf):
    """Key field k_user_id (prefix stripped for the key format), value fields without the key."""
    t = _table(spark, sf, "k_user_id BIGINT, cents BIGINT", ["k_user_id"], prefix="k_", strategy="EXCEPT_KEY",
        key_format="raw", metadata_columns={"topic_uri": "topic-uri", "offset": "offset"})
    return fx.out(t)


@query("p02_value_except_key", fx.sql(
    f"SELECT CAST(k AS BIGINT) AS user_id, event_id, event_type, cents FROM topic_log WHERE {_WITH_VALUE}"))
def p02_except(spark, sf):
    return _table(spark, sf, "user_id BIGINT, event_id BIGINT, event_type STRING, cents BIGINT", ["user_id"],
        strategy="EXCEPT_KEY", key_format="raw")


@query("p02_value_all", fx.sql(
    f"SELECT user_id, event_id, event_type, cents FROM topic_log WHERE {_WITH_VALUE}"))
def p02_all(spark, sf):
    """All columns come from the value, so rows without a key have a user as well."""
    return _table(spark, sf, "user_id BIGINT, event_id BIGINT, event_type STRING, cents BIGINT", ["user_id"],
        strategy="ALL", key_format="raw")


_HAS = "event_id % 19 <> 0"


@query("p03_metadata", fx.sql(
    'SELECT topic_uri, part, off, ts, '
    f"CASE WHEN {_HAS} THEN CAST(event_id AS VARCHAR) END AS trace, "
    f"CASE WHEN {_HAS} THEN 1 END AS n_headers, "
    f"CASE WHEN {_HAS} THEN CAST(event_id % 101 <> 0 AS INT) + 2 * CAST(event_id % 3 <> 0 AS INT) END AS n_system "
    "FROM topic_log"))
def p03(spark, sf):
    """Topic, partition, offset, timestamp and both halves of the headers."""
    log = fx.topic_log(spark, sf)
    names = ["topic_uri", "partition", "headers", "system_headers", "offset", "timestamp"]
    m = log.select(*[project.metadata(k).alias(n) for k, n in zip(C.METADATA_KEYS, names)])
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return fx.out(m.select(
        "topic_uri", "partition", "offset", F.col("timestamp").alias("ts"),
        H.header(F.col("headers"), "trace").cast("string").alias("trace"),
        size("headers").alias("n_headers"), size("system_headers").alias("n_system")))


_ENVELOPES = """env AS (
  SELECT o_orderkey * 2 AS seq, 1 AS step, * FROM orders
  UNION ALL SELECT o_orderkey * 2 + 1, 2, * FROM orders WHERE o_orderstatus IN ('F', 'P')),
chg AS (
  SELECT seq, 0 AS change_no, CASE WHEN step = 1 THEN '+I' WHEN o_orderstatus = 'F' THEN '-U' ELSE '-D' END AS row_kind,
         o_orderkey AS id, o_orderpriority AS name, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         o_orderdate + to_days(step) AS source_ts FROM env
  UNION ALL
  SELECT seq, 1, '+U', o_orderkey, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) + 100, o_orderdate + to_days(step)
  FROM env WHERE step = 2 AND o_orderstatus = 'F')"""


def order_steps(spark, sf) -> DataFrame:
    """Every order as created; F orders get a price change, P orders are deleted."""
    o = fx.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("day_ms"))
    steps = F.when(F.col("o_orderstatus").isin("F", "P"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    s = o.withColumn("step", F.explode(steps))
    return s.withColumn("seq", F.col("o_orderkey") * 2 + F.col("step") - 1).withColumn(
        "at_ms", F.col("day_ms") + F.col("step") * F.lit(86400000).cast("bigint"))


def _row(cents: Column) -> Column:
    return F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), cents.alias("cents"))


def debezium_messages(spark, sf) -> DataFrame:
    s = order_steps(spark, sf)
    created, updated = F.col("step") == 1, F.col("o_orderstatus") == "F"
    body = F.struct(
        F.when(~created, _row(F.col("cents"))).alias("before"),
        F.when(created, _row(F.col("cents"))).when(updated, _row(F.col("cents") + 100)).alias("after"),
        F.struct(F.col("at_ms").alias("ts_ms"), F.lit("shop").alias("db"), F.lit("orders").alias("table")).alias("source"),
        F.when(created, "c").when(updated, "u").otherwise("d").alias("op"), F.col("at_ms").alias("ts_ms"))
    return s.select("seq", F.to_json(body).alias("value"))


ORDER_ROW = "id BIGINT, name STRING, cents BIGINT"
_CHANGES_SQL = "SELECT seq, change_no, row_kind, id, name, cents FROM chg"


@query("p04_format_metadata", fx.sql(
    "SELECT seq, change_no, source_ts, 'shop' AS source_db, 'orders' AS source_table, id FROM chg", _ENVELOPES))
def p04(spark, sf):
    changes = cdc.debezium(debezium_messages(spark, sf), "value", ORDER_ROW, ["seq"])
    return fx.out(changes.select("seq", "change_no", "source_ts", "source_db", "source_table", "id"))


@query("p05_projection", fx.sql(f"SELECT cents, event_id, topic_uri FROM topic_log WHERE {_WITH_VALUE}"))
def p05(spark, sf):
    t = _table(spark, sf, VALUE_DDL, metadata_columns={"topic_uri": "topic-uri"})
    return t.select("cents", "event_id", "topic_uri")


@query("p06_nested_projection", fx.sql(
    f'SELECT event_id, prop_k AS "props.k" FROM topic_log WHERE {_WITH_VALUE}'))
def p06(spark, sf):
    return project.project(_table(spark, sf, VALUE_DDL), ["event_id", "props.k"])


@query("p07_key_value_rows", fx.sql(
    "SELECT topic_uri, part, off, key_row, value_row FROM topic_log, "
    "(VALUES ('a'), ('b')) k(key_row), (VALUES (0), (1), (2)) n(value_row) "
    f"WHERE {_WITH_VALUE} AND value_row <= event_id % 3"))
def p07(spark, sf):
    """Messages decoded to two key rows and one to three value rows each."""
    m = _table(spark, sf, "event_id BIGINT", metadata_columns={
        "topic_uri": "topic-uri", "partition": "partition", "offset": "offset"})
    decoded = m.withColumn("key_row", F.array(F.lit("a"), F.lit("b"))).withColumn(
        "value_row", F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")))
    return fx.out(project.key_value_rows(decoded, "key_row", "value_row").drop("event_id"))


@query("p08_rows_per_message", fx.sql(
    "SELECT topic_uri, part, off, n, x FROM (SELECT topic_uri, part, off, "
    "unnest(range(event_id % 4)) AS n, cents FROM topic_log WHERE v IS NOT NULL), LATERAL (SELECT cents + n AS x)"))
def p08(spark, sf):
    """JSON arrays of 0 to 3 elements, one row per element."""
    m = _table(spark, sf, "event_id BIGINT, cents BIGINT", metadata_columns={
        "topic_uri": "topic-uri", "partition": "partition", "offset": "offset"})
    elements = F.when(F.col("event_id") % 4 > 0, F.transform(
        F.sequence(F.lit(0), F.greatest((F.col("event_id") % 4 - 1), F.lit(0)).cast("int")),
        lambda n: F.struct(n.cast("bigint").alias("n"), (F.col("cents") + n).alias("x"))))
    payload = m.withColumn("json", F.to_json(F.coalesce(elements, F.array().cast("array<struct<n: bigint, x: bigint>>"))))
    rows = payload.select("topic_uri", "partition", "offset", F.inline(
        F.from_json("json", "ARRAY<STRUCT<n: BIGINT, x: BIGINT>>")))
    return fx.out(rows)


@query("p09_value_only", fx.sql("SELECT v AS value FROM topic_log"))
def p09(spark, sf):
    return project.value_only(fx.topic_log(spark, sf))


@query("p10_json_object", fx.sql(
    "SELECT topic_uri, off, '{' || concat_ws(',', '\"key\":' || k, '\"value\":' || v, "
    "'\"metadata\":{\"offset\":' || off || ',\"topic\":\"' || topic_uri || '\",\"partition\":' || part || '}') || '}' AS obj "
    "FROM topic_log"))
def p10(spark, sf):
    log = fx.topic_log(spark, sf)
    return fx.out(log.select("topic_uri", "offset", project.json_object(log, include_metadata=True).alias("obj")))


@query("p11_typed_tuple", fx.sql(
    "SELECT topic_uri, part, off, user_id AS key, CASE WHEN v IS NOT NULL THEN CAST(cents AS DOUBLE) / 4 END AS value FROM topic_log"))
def p11(spark, sf):
    """(LONG, DOUBLE) tuples encoded to bytes and read back; a missing value stays missing."""
    e = fx.table(spark, sf, "events")
    cents = F.round(F.col("value") * 100)
    rows = e.select(
        F.concat(F.lit(fx.CLUSTER), (F.col("user_id") % 2).cast("string"), F.lit(":"), "event_type").alias("topic_uri"),
        F.floor((F.col("user_id") % 8) / 2.0).cast("int").alias("partition"), "ts", "event_id",
        binary.encode(F.col("user_id"), "long").alias("key"),
        binary.encode(F.when(F.col("event_id") % 10 != 9, cents / 4), "double").alias("value"))
    log = rank(rows, ["topic_uri", "partition"], ["ts", "event_id"], "offset")
    return fx.out(project.typed_tuple(log, "long", "double"))


@query("p12_end_of_stream", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l LEFT JOIN "
    "(SELECT topic_uri, part, min(off) AS s FROM topic_log WHERE v IS NULL GROUP BY 1, 2) e "
    "ON e.topic_uri = l.topic_uri AND e.part = l.part WHERE s IS NULL OR off <= s"))
def p12(spark, sf):
    """Each partition is read up to its first tombstone."""
    return fx.out(ranges.end_of_stream(fx.topic_log(spark, sf), F.col("value").isNull()).select("topic_uri", "partition", "offset"))


@query("p13_null_predicates", fx.sql("SELECT topic_uri, part, off FROM topic_log WHERE k IS NOT NULL AND v IS NULL"))
def p13(spark, sf):
    log = fx.topic_log(spark, sf)
    return fx.out(log.where(F.col("key").isNotNull() & F.col("value").isNull()).select("topic_uri", "partition", "offset"))


@query("p14_header_lookup", fx.sql(
    f"SELECT topic_uri, part, off, event_id AS trace FROM topic_log WHERE {_HAS}"))
def p14(spark, sf):
    log = fx.topic_log(spark, sf).withColumn("trace", H.header(F.col("headers"), "trace").cast("string").cast("bigint"))
    return fx.out(log.where("trace IS NOT NULL").select("topic_uri", "partition", "offset", "trace"))


@query("p15_computed_columns", fx.sql(
    "SELECT event_id, cents + 100 AS raised, upper(event_type) AS kind FROM topic_log WHERE v IS NOT NULL"))
def p15(spark, sf):
    t = _table(spark, sf, VALUE_DDL)
    return t.withColumn("raised", F.col("cents") + 100).withColumn("kind", F.upper("event_type")).select("event_id", "raised", "kind")


# --- typed payloads ----------------------------------------------------------------------------------------
_TYPES = ["integer", "long", "short", "byte", "double", "float", "string", "uuid"]


def typed_payloads(spark, sf, kind: str) -> DataFrame:
    """Events as a topic of one payload type; the value of every 50th row is one byte short."""
    e = fx.table(spark, sf, "events")
    source = {
        "integer": F.col("event_id") * 3 - 1000, "long": F.col("event_id") * F.lit(-10000000000).cast("bigint"),
        "short": F.col("event_id") % 60000 - 30000, "byte": F.col("event_id") % 256 - 128,
        "double": F.col("value") / 8, "float": F.col("event_id") / 4, "string": F.col("props"),
        "uuid": F.concat(F.lpad(F.hex("event_id"), 8, "0"), F.lit("-0000-0000-0000-000000000001")),
    }[kind]
    payload = binary.encode(source, kind)
    short = F.expr("substring(_p, 1, octet_length(_p) - 1)")
    return (
        e.withColumn("_p", payload)
        .select(F.lit(f"typed:{kind}").alias("topic_uri"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
                F.when(F.col("event_id") % 50 == 0, short).otherwise(F.col("_p")).alias("value"))
    )


_TYPED_SQL = {
    "integer": "event_id * 3 - 1000", "long": "event_id * -10000000000", "short": "event_id % 60000 - 30000",
    "byte": "event_id % 256 - 128", "double": "value / 8", "float": "event_id / 4",
}


def _register_typed(kind: str) -> None:
    @query(f"f01_decode_{kind}", (
        "SELECT event_id AS off, CAST(user_id AS VARCHAR) AS decoded_key, "
        f"CASE WHEN event_id % 50 <> 0 THEN {_TYPED_SQL[kind]} END AS decoded_value, "
        "CASE WHEN event_id % 50 = 0 THEN 'VALUE_DESERIALIZATION_FAILED' END AS tag FROM events"))
    def f01(spark, sf):
        decoded = project.decode_log(typed_payloads(spark, sf, kind), "string", kind)
        value = F.col("decoded_value").cast("double" if kind in ("double", "float") else "bigint")
        return fx.out(decoded.select("offset", "decoded_key", value.alias("decoded_value"),
                                     F.get("tags", F.lit(0)).alias("tag")))


for _kind in _TYPED_SQL:
    _register_typed(_kind)


@query("f01_decode_string", (
    "SELECT event_id AS off, CASE WHEN event_id % 50 = 0 THEN props[1:length(props) - 1] ELSE props END AS decoded_value FROM events"))
def f01_string(spark, sf):
    decoded = project.decode_log(typed_payloads(spark, sf, "string"), "string", "string")
    return fx.out(decoded.select("offset", "decoded_value"))


@query("f01_decode_uuid", (
    "SELECT event_id AS off, lower(lpad(to_hex(event_id), 8, '0')) || '-0000-0000-0000-' || "
    "CASE WHEN event_id % 50 = 0 THEN '000000000000' ELSE '000000000001' END AS decoded_value FROM events"))
def f01_uuid(spark, sf):
    """A group that is one digit short is still a UUID; it is padded."""
    decoded = project.decode_log(typed_payloads(spark, sf, "uuid"), "string", "uuid")
    return fx.out(decoded.select("offset", "decoded_value"))


@query("f01_quarantine", (
    "SELECT 'typed:integer' AS topic_uri, count(*) FILTER (event_id % 50 <> 0) AS n_good, "
    "count(*) FILTER (event_id % 50 = 0) AS n_bad FROM events"))
def f01_quarantine(spark, sf):
    good, bad = project.quarantine(project.decode_log(typed_payloads(spark, sf, "integer"), "string", "integer"))
    both = good.withColumn("ok", F.lit(True)).unionByName(bad.withColumn("ok", F.lit(False)))
    return both.groupBy("topic_uri").agg(F.count_if("ok").alias("n_good"), F.count_if(~F.col("ok")).alias("n_bad"))


@query("f02_encode", (
    "SELECT event_id, upper(lpad(to_hex(event_id * 3), 8, '0')) AS as_integer, "
    "upper(lpad(to_hex(event_id * 1000003), 16, '0')) AS as_long, upper(lpad(to_hex(event_id % 30000), 4, '0')) AS as_short, "
    "upper(hex(encode(event_type))) AS as_string FROM events"))
def f02(spark, sf):
    e = fx.table(spark, sf, "events")
    encoded = lambda c, kind: F.hex(binary.encode(c, kind))
    return e.select(
        "event_id", encoded(F.col("event_id") * 3, "integer").alias("as_integer"),
        encoded(F.col("event_id") * 1000003, "long").alias("as_long"),
        encoded(F.col("event_id") % 30000, "short").alias("as_short"), encoded(F.col("event_type"), "string").alias("as_string"))


@query("d03_own_payload_type", (
    "SELECT event_id, hex(encode(reverse(event_type))) AS stored, event_type AS read FROM events"))
def d03(spark, sf):
    """A payload type of one's own, registered and then used by name on both ways."""
    binary.register("mirrored", lambda c: F.reverse(F.decode(c, "UTF-8")), lambda c: F.encode(F.reverse(c), "UTF-8"))
    e = fx.table(spark, sf, "events").withColumn("payload", binary.encode(F.col("event_type"), "mirrored"))
    return e.select("event_id", F.hex("payload").alias("stored"), binary.decode(F.col("payload"), "mirrored").alias("read"))


# --- topic names -------------------------------------------------------------------------------------------
def uri_samples(spark, sf) -> DataFrame:
    """URIs in many shapes, good and bad, derived from users and event types."""
    e = fx.table(spark, sf, "events").select("user_id", "event_type").distinct()
    u = F.col("user_id")
    tail = F.concat(F.lit(":"), F.lit("c"), u.cast("string"), F.lit(":"), "event_type")
    shape = u % 8
    text = (
        F.when(shape == 0, F.concat(F.lit("plaintext:/rn:kafka:env:cloud_region1:"), tail))
        .when(shape == 1, F.concat(F.lit("rn:kafka:prod:aws_us-west-1:pii"), tail))
        .when(shape == 2, F.concat(F.lit("secure:/rn:queue:prod:aws_us-east-1:"), tail))
        .when(shape == 3, F.concat(F.lit("plaintext:/xx:kafka:env:cloud_region1:"), tail))
        .when(shape == 4, F.concat(F.lit("plaintext:/rn:kafka:env:cloudregion:"), tail))
        .when(shape == 5, F.concat(F.lit("/rn:kafka:env:cloud_region1:"), tail))
        .when(shape == 6, F.concat(F.lit("plaintext:/rn:kafka:env:cloud_region1::c"), u.cast("string")))
        .otherwise(F.concat(F.lit("plaintext:/rn:kafka:env:cloud_region1::c"), u.cast("string"), F.lit(":"))))
    return e.select(text.alias("topic_uri"))


_URI_SQL = """shapes AS (
  SELECT DISTINCT CASE user_id % 8
    WHEN 0 THEN 'plaintext:/rn:kafka:env:cloud_region1::c' || user_id || ':' || event_type
    WHEN 1 THEN 'rn:kafka:prod:aws_us-west-1:pii:c' || user_id || ':' || event_type
    WHEN 2 THEN 'secure:/rn:queue:prod:aws_us-east-1::c' || user_id || ':' || event_type
    WHEN 3 THEN 'plaintext:/xx:kafka:env:cloud_region1::c' || user_id || ':' || event_type
    WHEN 4 THEN 'plaintext:/rn:kafka:env:cloudregion::c' || user_id || ':' || event_type
    WHEN 5 THEN '/rn:kafka:env:cloud_region1::c' || user_id || ':' || event_type
    WHEN 6 THEN 'plaintext:/rn:kafka:env:cloud_region1::c' || user_id
    ELSE 'plaintext:/rn:kafka:env:cloud_region1::c' || user_id || ':' END AS topic_uri FROM events),
parts AS (
  SELECT topic_uri, regexp_full_match(topic_uri, '(([a-zA-Z0-9_.-]+):/)?[a-zA-Z0-9_.:-]+') AS uri_ok,
         CASE WHEN topic_uri LIKE '%:/%' THEN split_part(topic_uri, ':/', 1) ELSE 'plaintext' END AS protocol,
         CASE WHEN topic_uri LIKE '%:/%' THEN split_part(topic_uri, ':/', 2) ELSE topic_uri END AS rn FROM shapes),
checked AS (
  SELECT *, CASE WHEN NOT uri_ok THEN 'malformed uri'
      WHEN NOT regexp_full_match(rn, '[a-zA-Z0-9_.-]+:[a-zA-Z0-9_.-]+:[a-zA-Z0-9_.-]+:[a-zA-Z0-9.-]+_[a-zA-Z0-9.-]+:[a-zA-Z0-9_.-]*:[a-zA-Z0-9_.-]+:([a-zA-Z0-9_.-]+)?') THEN 'malformed name'
      WHEN split_part(rn, ':', 1) <> 'rn' THEN 'wrong standard' END AS problem FROM parts)"""


@query("f03_topic_inventory", fx.sql(
    "SELECT topic_uri, problem, CASE WHEN problem IS NULL THEN protocol END AS protocol, "
    "CASE WHEN problem IS NULL THEN split_part(rn, ':', 2) END AS service, "
    "CASE WHEN problem IS NULL THEN split_part(split_part(rn, ':', 4), '_', 1) END AS cloud, "
    "CASE WHEN problem IS NULL THEN split_part(split_part(rn, ':', 4), '_', 2) END AS region, "
    "CASE WHEN problem IS NULL THEN split_part(rn, ':', 5) END AS classifier, "
    "CASE WHEN problem IS NULL THEN split_part(rn, ':', 6) END AS cluster, "
    "CASE WHEN problem IS NULL THEN nullif(split_part(rn, ':', 7), '') END AS topic FROM checked", _URI_SQL))
def f03(spark, sf):
    inv = uri.topic_inventory(uri_samples(spark, sf))
    return inv.select("topic_uri", "problem", "protocol", "service", "cloud", "region", "classifier", "cluster", "topic")


@query("f03_inventory_counts", fx.sql(
    "SELECT coalesce(problem, 'ok') AS status, CASE WHEN problem IS NULL THEN split_part(rn, ':', 2) END AS service, "
    "CASE WHEN problem IS NULL THEN split_part(split_part(rn, ':', 4), '_', 2) END AS region, count(*) AS n_topics "
    "FROM checked GROUP BY 1, 2, 3", _URI_SQL))
def f03_counts(spark, sf):
    inv = uri.topic_inventory(uri_samples(spark, sf))
    return inv.groupBy(F.coalesce("problem", F.lit("ok")).alias("status"), "service", "region").agg(
        F.count(F.lit(1)).alias("n_topics"))


@query("f10_uri_round_trip", fx.sql(
    "SELECT topic_uri, protocol || ':/' || rn AS rebuilt, protocol || ':/' || regexp_replace(rn, '[^:]*$', '') AS prefix "
    "FROM checked WHERE problem IS NULL", _URI_SQL))
def f10(spark, sf):
    u = uri.with_uri_parts(uri_samples(spark, sf).distinct()).where("rn_parts.problem IS NULL")
    return u.select("topic_uri", uri.build_topic_uri(F.col("rn_parts")).alias("rebuilt"),
                    uri.cluster_prefix(F.col("rn_parts")).alias("prefix"))


# --- composite offsets -------------------------------------------------------------------------------------
@query("f04_composite_offsets", fx.sql(
    "SELECT topic_uri, part, off // 7 AS batch, count(*) AS n_messages, max(off % 7) AS last_message FROM topic_log GROUP BY 1, 2, 3"))
def f04(spark, sf):
    """Offsets packed as (batch, message), split again, counted per batch."""
    packed = composite.pack_offset(F.floor(F.col("offset") / 7), F.col("offset") % 7)
    log = fx.topic_log(spark, sf).withColumn("packed", packed)
    return fx.out(log.groupBy("topic_uri", "partition", composite.batch_offset(F.col("packed")).alias("batch")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.max(composite.message_offset(F.col("packed"))).alias("last_message")))


@query("f04_batch_gaps", fx.sql(
    "SELECT topic_uri, part, batch, batch - prev - 1 AS n_missing FROM (SELECT topic_uri, part, batch, "
    "lag(batch) OVER (PARTITION BY topic_uri, part ORDER BY batch) AS prev FROM (SELECT DISTINCT topic_uri, part, off // 7 AS batch "
    "FROM topic_log WHERE (off // 7) % 3 <> 1)) WHERE batch - prev > 1"))
def f04_gaps(spark, sf):
    packed = composite.pack_offset(F.floor(F.col("offset") / 7), F.col("offset") % 7)
    batches = (
        fx.topic_log(spark, sf).withColumn("batch", composite.batch_offset(packed)).where("batch % 3 <> 1")
        .select("topic_uri", "partition", "batch").distinct().withColumn("_slice", offset_slice("batch")))
    seen = previous_row(batches, ["topic_uri", "partition"], ["batch"], "_slice", "_prev", ["batch"])
    missing = F.col("batch") - F.col("_prev.batch") - 1
    return fx.out(seen.where(missing > 0).select("topic_uri", "partition", "batch", missing.alias("n_missing")))


# --- headers and tags --------------------------------------------------------------------------------------
_TAG_SQL = (
    "CASE WHEN event_id % 19 = 0 OR event_id % 101 = 0 THEN 'HEADER_TIMESTAMP_NOT_FOUND' "
    "WHEN event_id % 97 = 0 THEN 'HEADER_TIMESTAMP_CORRUPTED' END")
_STAMP_SQL = (
    "CASE WHEN event_id % 19 <> 0 AND event_id % 101 <> 0 AND event_id % 97 <> 0 THEN "
    "CASE WHEN event_id % 7 = 0 THEN (epoch_us(ts) // 1000) * 1000 ELSE epoch_us(ts) // 1000 END END")


@query("f05_produce_timestamp", fx.sql(
    f"SELECT topic_uri, part, off, {_STAMP_SQL} AS stamp, {_TAG_SQL} AS tag FROM topic_log"))
def f05(spark, sf):
    h = F.col("headers")
    return fx.out(fx.topic_log(spark, sf).select(
        "topic_uri", "partition", "offset", H.produce_timestamp(h).alias("stamp"), H.produce_timestamp_tag(h).alias("tag")))


_KS, _VS = "coalesce(strlen(k), -1)", "coalesce(strlen(v), -1)"
_WRONG = "event_id % 19 <> 0 AND event_id % 3 <> 0 AND event_id % 17 = 0"


@query("f06_size_headers", fx.sql(
    f"SELECT topic_uri, part, off, CASE WHEN {_WRONG} THEN 'VALUE_SIZE_MISMATCH_WITH_VALUE_SIZE_HEADER' END AS tag, "
    f"CASE WHEN event_id % 19 = 0 OR event_id % 3 <> 0 THEN {_KS} END AS key_size, "
    f"CASE WHEN event_id % 19 = 0 OR event_id % 3 <> 0 THEN {_VS} END AS value_size FROM topic_log"))
def f06(spark, sf):
    """Wrong size headers tagged and repaired; a message without headers gets both."""
    h, k, v = F.col("headers"), F.col("key"), F.col("value")
    log = fx.topic_log(spark, sf).withColumn("tags", H.size_tags(h, k, v)).withColumn("fixed", H.repaired_size_headers(h, k, v))
    size = lambda name: binary.decode_integer(H.header(F.col("fixed"), name), 4).cast("bigint")
    return fx.out(log.select(
        "topic_uri", "partition", "offset", F.get("tags", F.lit(0)).alias("tag"),
        size(C.KEY_SIZE_HEADER).alias("key_size"), size(C.VALUE_SIZE_HEADER).alias("value_size")))


@query("f07_tag_summary", fx.sql(
    f"SELECT topic_uri, tag, count(*) AS n_rows FROM (SELECT topic_uri, {_TAG_SQL} AS tag FROM topic_log UNION ALL "
    f"SELECT topic_uri, CASE WHEN {_WRONG} THEN 'VALUE_SIZE_MISMATCH_WITH_VALUE_SIZE_HEADER' END FROM topic_log) "
    "WHERE tag IS NOT NULL GROUP BY 1, 2"))
def f07(spark, sf):
    h = F.col("headers")
    tags = F.concat(
        H.size_tags(h, F.col("key"), F.col("value")), F.array_compact(F.array(H.produce_timestamp_tag(h))))
    return metrics.tag_summary(fx.topic_log(spark, sf).withColumn("tags", tags))


@query("f08_json_decode", fx.sql(
    "SELECT topic_uri, part, off, event_id, user_id, event_type, cents, prop_k FROM topic_log WHERE v IS NOT NULL"))
def f08(spark, sf):
    t = _table(spark, sf, VALUE_DDL, metadata_columns={
        "topic_uri": "topic-uri", "partition": "partition", "offset": "offset"})
    return fx.out(t.select("topic_uri", "partition", "offset", "event_id", "user_id", "event_type", "cents",
                           F.col("props.k").alias("prop_k")))


# --- CDC envelopes -----------------------------------------------------------------------------------------
@query("f09_debezium", fx.sql(_CHANGES_SQL, _ENVELOPES))
def f09_debezium(spark, sf):
    changes = cdc.debezium(debezium_messages(spark, sf), "value", ORDER_ROW, ["seq"])
    return changes.select("seq", "change_no", "row_kind", "id", "name", "cents")


@query("f09_maxwell", fx.sql(_CHANGES_SQL, _ENVELOPES))
def f09_maxwell(spark, sf):
    s = order_steps(spark, sf)
    created, updated = F.col("step") == 1, F.col("o_orderstatus") == "F"
    body = F.struct(
        F.lit("shop").alias("database"), F.lit("orders").alias("table"),
        F.when(created, "insert").when(updated, "update").otherwise("delete").alias("type"),
        F.floor(F.col("at_ms") / 1000).alias("ts"),
        _row(F.when(~created & updated, F.col("cents") + 100).otherwise(F.col("cents"))).alias("data"),
        F.when(~created & updated, F.struct("cents")).alias("old"))
    changes = cdc.maxwell(s.select("seq", F.to_json(body).alias("value")), "value", ORDER_ROW, ["seq"])
    return changes.select("seq", "change_no", "row_kind", "id", "name", "cents")


@query("f09_canal", fx.sql(
    "SELECT seq, row_kind, id, name, cents FROM (SELECT id AS seq, row_kind, id, name, cents FROM chg UNION ALL "
    "SELECT id, row_kind, id + 1000000000, name, cents + 7 FROM chg)", _ENVELOPES))
def f09_canal(spark, sf):
    """Messages that carry two rows each, values as text, old rows holding changed fields only."""
    s = order_steps(spark, sf)
    created, updated = F.col("step") == 1, F.col("o_orderstatus") == "F"
    cents = F.when(~created & updated, F.col("cents") + 100).otherwise(F.col("cents"))

    def row(shift: int, extra: int) -> Column:
        return F.struct((F.col("o_orderkey") + shift).cast("string").alias("id"), F.col("o_orderpriority").alias("name"),
                        (cents + extra).cast("string").alias("cents"))

    old = F.array(F.struct(F.col("cents").cast("string").alias("cents")), F.struct((F.col("cents") + 7).cast("string").alias("cents")))
    body = F.struct(
        F.array(row(0, 0), row(1000000000, 7)).alias("data"), F.when(~created & updated, old).alias("old"),
        F.when(created, "INSERT").when(updated, "UPDATE").otherwise("DELETE").alias("type"),
        F.lit("shop").alias("database"), F.lit("orders").alias("table"), F.col("at_ms").alias("es"),
        F.col("at_ms").alias("ts"), F.lit(False).alias("isDdl"))
    messages = s.select(F.col("o_orderkey").alias("seq"), F.to_json(body).alias("value"))
    return cdc.canal(messages, "value", ORDER_ROW, ["seq"]).select("seq", "row_kind", "id", "name", "cents")


# --- hooks -------------------------------------------------------------------------------------------------
@query("d04_interceptors", fx.sql(
    "SELECT topic_uri, part, off, CAST(k AS BIGINT) + 1 AS k, CASE WHEN v IS NULL THEN 0 ELSE strlen(v) END AS n_bytes "
    "FROM topic_log WHERE k IS NOT NULL"))
def d04(spark, sf):
    """A raw interceptor drops keyless rows, the decoder runs, a typed interceptor changes the key."""
    def keyed(df: DataFrame) -> DataFrame:
        return df.where(F.col("key").isNotNull()).withColumn("n_bytes", F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint"))

    def next_key(df: DataFrame) -> DataFrame:
        return df.withColumn("k", F.col("decoded_key").cast("bigint") + 1)

    log = project.intercept(fx.topic_log(spark, sf), keyed, lambda df: project.decode_log(df, "string", "bytes"), next_key)
    return fx.out(log.select("topic_uri", "partition", "offset", "k", "n_bytes"))


@query("d06_custom_start", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN bounds b ON b.topic_uri = l.topic_uri AND b.part = l.part "
    "WHERE l.off >= greatest(b.earliest, b.latest - 10)"))
def d06(spark, sf):
    """A user's start position: the last ten rows of every partition."""
    def tail(log: DataFrame, b: DataFrame) -> DataFrame:
        at = F.greatest(F.col("earliest"), F.col("latest") - 10)
        return b.select("topic_uri", "partition", at.alias("position"))

    return fx.out(ranges.read_slice(
        fx.topic_log(spark, sf), ranges.custom(tail), known=fx.bounds(spark, sf)).select("topic_uri", "partition", "offset"))
