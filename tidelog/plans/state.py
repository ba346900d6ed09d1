"""Queries over upsert topics, changelogs, aggregates and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import cdc
from tidelog.operators import changelog, produce, project
from tidelog.operators.ordered import rank
from tidelog.plans import fixture as fx
from tidelog.plans.catalog import query
from tidelog.plans.decoding import _ENVELOPES, ORDER_ROW, debezium_messages
from tidelog.sources.topiclog import latest_commits

LATEST = """latest AS (
  SELECT * FROM (SELECT topic_uri, part, k, off, ts, v, event_type, cents, row_number() OVER (PARTITION BY topic_uri, k ORDER BY off DESC) AS rn
                 FROM topic_log WHERE k IS NOT NULL) WHERE rn = 1 AND v IS NOT NULL)"""

CHANGES = """seen AS (
  SELECT *, lag(v) OVER (PARTITION BY topic_uri, part, k ORDER BY off) AS pv FROM topic_log WHERE k IS NOT NULL),
changes AS (
  SELECT topic_uri, part, off, k, 0 AS change_no, '+I' AS row_kind, v FROM seen WHERE pv IS NULL AND v IS NOT NULL
  UNION ALL SELECT topic_uri, part, off, k, 0, '-D', pv FROM seen WHERE pv IS NOT NULL AND v IS NULL
  UNION ALL SELECT topic_uri, part, off, k, 0, '-U', pv FROM seen WHERE pv IS NOT NULL AND v IS NOT NULL AND pv <> v
  UNION ALL SELECT topic_uri, part, off, k, 1, '+U', v FROM seen WHERE pv IS NOT NULL AND v IS NOT NULL AND pv <> v)"""


@query("u02_latest_by_key", fx.sql("SELECT topic_uri, k, part, off, v FROM latest", LATEST))
def u02(spark, sf):
    latest = changelog.latest_by_key(fx.topic_log(spark, sf))
    return fx.out(latest.select("topic_uri", F.col("key").alias("k"), "partition", "offset", F.col("value").alias("v")))


@query("u03_upsert_changelog", fx.sql("SELECT * FROM changes", CHANGES))
def u03(spark, sf):
    changes = changelog.to_changelog(fx.topic_log(spark, sf))
    return fx.out(changes.select("topic_uri", "partition", "offset", F.col("key").alias("k"), "change_no", "row_kind",
                                 F.col("value").alias("v")))


@query("u03_upsert_changelog_sliced", fx.sql("SELECT * FROM changes", CHANGES))
def u03_sliced(spark, sf):
    """The same with slices of seven offsets, so that values are carried across many slices."""
    changes = changelog.to_changelog(fx.topic_log(spark, sf), slice_rows=7)
    return fx.out(changes.select("topic_uri", "partition", "offset", F.col("key").alias("k"), "change_no", "row_kind",
                                 F.col("value").alias("v")))


@query("k02_null_skip", fx.sql("SELECT topic_uri, part, off FROM topic_log WHERE v IS NOT NULL"))
def k02(spark, sf):
    log = fx.topic_log(spark, sf).withColumn("message", F.when(F.col("value").isNotNull(), F.struct("key", "value")))
    return fx.out(produce.drop_unserialised(log).select("topic_uri", "partition", "offset"))


@query("k13_encode_key_value", fx.sql(
    "SELECT event_id, '{\"user_id\":' || user_id || '}' AS k, "
    "'{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\",\"cents\":' || cents || '}' AS v "
    "FROM topic_log WHERE v IS NOT NULL"))
def k13(spark, sf):
    """Key fields lose their prefix and leave the value."""
    t = project.read_table(
        fx.topic_log(spark, sf), "user_id BIGINT, event_id BIGINT, event_type STRING, cents BIGINT", null_values="skip")
    t = t.withColumnRenamed("user_id", "k_user_id").withColumn("id", F.col("event_id"))
    encoded = produce.encode_table(t, ["k_user_id"], prefix="k_", strategy="EXCEPT_KEY", keep=["id"])
    return encoded.select(F.col("id").alias("event_id"), F.col("key").cast("string").alias("k"),
                          F.col("value").cast("string").alias("v"))


@query("k15_upsert_sink", fx.sql(
    "SELECT topic_uri, part, off, change_no, k, CASE WHEN row_kind IN ('+I', '+U') THEN v END AS v FROM changes", CHANGES))
def k15(spark, sf):
    """A changelog written to an upsert topic: retractions become tombstones."""
    c = changelog.to_changelog(fx.topic_log(spark, sf))
    payload = changelog.upsert_payload(F.col("row_kind"), F.col("value"))
    return fx.out(c.select("topic_uri", "partition", "offset", "change_no", F.col("key").alias("k"), payload.alias("v")))


def buffered_sql(max_keys: int) -> str:
    """Row by row: the row that brings the last distinct key closes its writer's buffer."""
    return fx.sql(
        "SELECT topic_uri, part, k, flush_no, off, CASE WHEN v IS NULL THEN '-D' ELSE '+U' END AS row_kind, v FROM ("
        "SELECT r.*, w.flush_no, row_number() OVER (PARTITION BY r.topic_uri, r.part, r.k, w.flush_no ORDER BY r.off DESC) AS rn "
        "FROM keyed r JOIN walk w ON w.topic_uri = r.topic_uri AND w.part = r.part AND w.i = r.i) WHERE rn = 1",
        "keyed AS (SELECT *, row_number() OVER (PARTITION BY topic_uri, part ORDER BY off) AS i FROM topic_log WHERE k IS NOT NULL)",
        "walk AS (SELECT DISTINCT topic_uri, part, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS flush_no, CAST([] AS VARCHAR[]) AS held, "
        "CAST(0 AS BIGINT) AS next_no FROM keyed UNION ALL "
        "SELECT r.topic_uri, r.part, r.i, w.next_no, CASE WHEN filled THEN [] ELSE now END, w.next_no + filled::INT FROM ("
        "SELECT w.*, r.i AS at, CASE WHEN list_contains(held, r.k) THEN held ELSE list_append(held, r.k) END AS now, "
        f"len(now) >= {max_keys} AS filled FROM walk w JOIN keyed r ON r.topic_uri = w.topic_uri AND r.part = w.part AND r.i = w.i + 1) w "
        "JOIN keyed r ON r.topic_uri = w.topic_uri AND r.part = w.part AND r.i = w.at)").replace("WITH b AS", "WITH RECURSIVE b AS", 1)


@query("k16_buffered_upsert", buffered_sql(10))
def k16(spark, sf):
    """Only the last change per key of every buffer, which is emptied when it holds ten keys."""
    log = fx.topic_log(spark, sf).where(F.col("key").isNotNull()).withColumn(
        "row_kind", F.when(F.col("value").isNull(), "-D").otherwise("+I"))
    flushed = changelog.buffered_upsert(log, ["topic_uri", "partition"], ["key"], "offset", 10, ["value"])
    return fx.out(flushed.select("topic_uri", "partition", F.col("key").alias("k"), "flush_no", "offset", "row_kind",
                                 F.col("value").alias("v")))


@query("k17_bad_records", fx.sql(
    "SELECT CASE WHEN v IS NULL THEN 'logged' ELSE 'written' END AS outcome, count(*) AS n_rows FROM topic_log GROUP BY 1"))
def k17(spark, sf):
    """The lenient policy: rows whose value cannot be read are set aside and the rest goes on."""
    good, bad = project.quarantine(_decoded(spark, sf))
    return (
        good.select(F.lit("written").alias("outcome")).unionByName(bad.select(F.lit("logged").alias("outcome")))
        .groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows")))


def _decoded(spark, sf) -> DataFrame:
    # tombstones replaced by one byte, which is no 4-byte integer
    log = fx.topic_log(spark, sf).withColumn(
        "value", F.when(F.col("value").isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit("0000002A"))))
    return project.decode_log(log, "string", "integer")


# --- aggregates over changelogs ----------------------------------------------------------------------------
_WORDS = ("words AS (SELECT item_id, pos, lower(w) AS word FROM (SELECT item_id, unnest(string_split(text, ' ')) AS w, "
          "CAST(generate_subscripts(string_split(text, ' '), 1) - 1 AS INT) AS pos FROM benchmark) WHERE w <> '')")


def _words(spark, sf) -> DataFrame:
    b = fx.table(spark, sf, "benchmark")
    w = b.select("item_id", F.posexplode(F.split("text", " ")).alias("pos", "w"))
    return w.where("w <> ''").select("item_id", "pos", F.lower("w").alias("word"))


@query("a11_word_count", fx.sql("SELECT word, count(*) AS n FROM words GROUP BY 1", _WORDS))
def a11(spark, sf):
    return _words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("a11_word_count_changelog", fx.sql(
    "SELECT word, item_id, pos, '+I' AS row_kind, n FROM c WHERE n = 1 UNION ALL "
    "SELECT word, item_id, pos, '-U', n - 1 FROM c WHERE n > 1 UNION ALL SELECT word, item_id, pos, '+U', n FROM c WHERE n > 1",
    _WORDS, "c AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY item_id, pos) AS n FROM words)"))
def a11_changelog(spark, sf):
    """Every change the running count writes to its upsert topic."""
    return changelog.count_changelog(_words(spark, sf), "word", ["item_id", "pos"])


@query("a12_count_of_counts", fx.sql(
    "SELECT n, count(*) AS n_users FROM (SELECT k, count(*) AS n FROM latest GROUP BY 1) GROUP BY n HAVING count(*) < 1000", LATEST))
def a12(spark, sf):
    """How many users are present in how many topics, rare sizes only."""
    per_user = changelog.latest_by_key(fx.topic_log(spark, sf)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("n").agg(F.count(F.lit(1)).alias("n_users")).where("n_users < 1000")


@query("a13_retracting_sum", fx.sql(
    "SELECT name, CAST(sum(CASE WHEN row_kind IN ('+I', '+U') THEN 1 ELSE -1 END) AS BIGINT) AS n_rows, "
    "CAST(sum(CASE WHEN row_kind IN ('+I', '+U') THEN cents ELSE -cents END) AS BIGINT) AS total, "
    "(SELECT min(id) FROM orders o2 JOIN chg c2 ON c2.id = o2.o_orderkey WHERE c2.name = chg.name AND o2.o_orderstatus <> 'P') AS first_id "
    "FROM chg GROUP BY name HAVING n_rows > 0", _ENVELOPES))
def a13(spark, sf):
    """Sum of prices per priority over a CDC topic, updates and deletes retracted; the first order still there."""
    changes = cdc.debezium(debezium_messages(spark, sf), "value", ORDER_ROW, ["seq"])
    return changelog.retract_sums(
        changes, ["name"], ["id"], {"total": F.col("cents")}, ["seq", "change_no"], {"first_id": "id"}
    ).withColumn("total", F.col("total").cast("bigint"))


@query("a16_max_count", fx.sql(
    "SELECT topic_uri, max(cents) AS max_cents, count(*) AS n_rows FROM topic_log WHERE v IS NOT NULL GROUP BY 1"))
def a16(spark, sf):
    t = project.read_table(fx.topic_log(spark, sf), "cents BIGINT", metadata_columns={"topic_uri": "topic-uri"},
                           null_values="skip")
    return t.groupBy("topic_uri").agg(F.max("cents").alias("max_cents"), F.count(F.lit(1)).alias("n_rows"))


# --- as-of joins -------------------------------------------------------------------------------------------
@query("j01_as_of_upsert", fx.sql(
    "SELECT l.topic_uri, l.off, l.k, l.ts, CASE WHEN m.v IS NOT NULL THEN m.cents END AS version_cents FROM probes l "
    "ASOF LEFT JOIN versions m ON l.cluster = m.cluster AND l.k = m.k AND l.ts >= m.ts",
    "probes AS (SELECT * FROM topic_log WHERE event_type = 'click')",
    "versions AS (SELECT cluster, k, ts, v, cents FROM topic_log WHERE event_type = 'view' AND k IS NOT NULL)"))
def j01(spark, sf):
    """Clicks with the user's `view` row valid at click time, from an upsert topic; deleted and unknown users give nulls."""
    log = fx.topic_log(spark, sf).withColumn("cluster", F.element_at(F.split("topic_uri", ":"), -2))
    kind = F.element_at(F.split("topic_uri", ":"), -1)
    left = log.where(kind == "click").select("topic_uri", "offset", "cluster", F.col("key").alias("k"), F.col("timestamp").alias("ts"))
    versions = log.where(kind == "view").select(
        "cluster", F.col("key").alias("k"), F.col("timestamp").alias("vts"), F.col("offset").alias("voff"), "value",
        F.from_json(F.col("value").cast("string"), "cents BIGINT")["cents"].alias("version_cents"))
    joined = changelog.as_of_join(left, versions, ["cluster", "k"], "ts", "vts", ["voff"], ["version_cents"],
                                  F.col("value").isNull())
    return fx.out(joined.select("topic_uri", "offset", "k", "ts", "version_cents"))


_PRICES = """prices AS (
  SELECT p_partkey AS id, TIMESTAMP '1992-01-01 00:00:00' AS vts, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part
  UNION ALL SELECT p_partkey, TIMESTAMP '1995-01-01 00:00:00', CAST(round(p_retailprice * 100) AS BIGINT) + 100 FROM part
  UNION ALL SELECT p_partkey, TIMESTAMP '1997-01-01 00:00:00', NULL FROM part WHERE p_partkey % 5 = 0)"""


@query("j02_as_of_cdc", fx.sql(
    "SELECT l_orderkey, l_linenumber, l_partkey, p.cents, CAST(l_quantity AS BIGINT) * p.cents AS amount FROM lineitem l "
    "ASOF LEFT JOIN prices p ON l.l_partkey = p.id AND l.l_shipdate >= p.vts", _PRICES))
def j02(spark, sf):
    """Line items priced as of shipping from a CDC topic of parts; a deleted part has no price from that instant on."""
    part = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"))
    row = lambda c: F.struct("id", c.alias("cents"))
    day = lambda d: F.unix_millis(F.lit(d).cast("timestamp"))
    none = F.lit(None).cast("struct<id: bigint, cents: bigint>")

    def message(op, before, after, ts, when=F.lit(True)):
        body = F.struct(before.alias("before"), after.alias("after"), F.struct(ts.alias("ts_ms")).alias("source"), F.lit(op).alias("op"))
        return F.when(when, F.struct(ts.alias("seq"), F.to_json(body).alias("value")))

    old, new = F.col("cents"), F.col("cents") + 100
    messages = part.select(F.inline(F.array_compact(F.array(
        message("c", none, row(old), day("1992-01-01")), message("u", row(old), row(new), day("1995-01-01")),
        message("d", row(new), none, day("1997-01-01"), F.col("id") % 5 == 0)))))
    changes = cdc.debezium(messages, "value", "id BIGINT, cents BIGINT", ["seq"])
    versions = changes.where("row_kind <> '-U'")
    left = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("id"), "l_quantity",
        F.col("l_shipdate").cast("timestamp").alias("shipped"))
    joined = changelog.as_of_join(left, versions, ["id"], "shipped", "source_ts", ["seq", "change_no"], ["cents"],
                                  F.col("row_kind") == "-D")
    return joined.select("l_orderkey", "l_linenumber", F.col("id").alias("l_partkey"), "cents",
                         (F.col("l_quantity").cast("bigint") * F.col("cents")).alias("amount"))


@query("x04_explicit_commits", fx.sql(
    "SELECT CAST(user_id % 3 AS VARCHAR) AS group_id, topic_uri, part, arg_max(off + 1, event_id) AS next_offset "
    "FROM topic_log GROUP BY 1, 2, 3"))
def x04(spark, sf):
    """Commits of message ids by three groups; the last write wins and stores the next offset."""
    e = fx.table(spark, sf, "events")
    rows = e.select(
        (F.col("user_id") % 3).cast("string").alias("group_id"),
        F.concat(F.lit(fx.CLUSTER), (F.col("user_id") % 2).cast("string"), F.lit(":"), "event_type").alias("topic_uri"),
        F.floor((F.col("user_id") % 8) / 2.0).cast("int").alias("partition"), "ts", "event_id")
    log = rank(rows, ["topic_uri", "partition"], ["ts", "event_id"], "offset")
    commits = log.select("group_id", "topic_uri", "partition", (F.col("offset") + 1).alias("next_offset"),
                         F.timestamp_seconds("event_id").alias("committed_at"))
    return fx.out(latest_commits(commits).drop("committed_at"))
