"""Streaming queries: each runs its stream to the end and returns the table it wrote."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import ranges
from tidelog.operators.changelog import latest_by_key
from tidelog.plans import fixture as fx
from tidelog.plans.catalog import query
from tidelog.plans.measures import _SEEN
from tidelog.plans.scans import AT, AT_SQL
from tidelog.plans.state import CHANGES, LATEST, buffered_sql
from tidelog.plans.writing import _rows, new_log
from tidelog.session import scratch_dir
from tidelog.sources import datasource, files
from tidelog.sources.topiclog import TopicLog
from tidelog.streaming import deliver as dv
from tidelog.streaming import shuffle
from tidelog.streaming.reports import BatchReports, observed
from tidelog.streaming.tables import BatchTable
from tidelog.streaming.temporal import LiveAsOfJoin, both_sides
from tidelog.streaming.upsert import CHANGE_DDL, BufferedUpsert, LiveChangelog, UpsertTable
from tidelog.streaming.watermarks import PartitionWatermarks, TumblingCounts

_ROW = "topic_uri, part, off, ts, k, v"


def stream_of(spark: SparkSession, log: TopicLog, **options) -> DataFrame:
    datasource.register(spark)
    reader = spark.readStream.format("topiclog").option("path", log.root)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, checkpoint: str | None = None, at: str | None = None) -> str:
    """Run to the end into a parquet table; returns its folder."""
    target = at or scratch_dir(spark, name)
    (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint or scratch_dir(spark, f"{name}-cp"))
        .option("path", target).trigger(availableNow=True).start().awaitTermination())
    return target


def run_capped(stream: DataFrame, step, checkpoint: str, mode: str = "append") -> list[int]:
    """Run micro-batch after micro-batch until nothing is left; returns rows per micro-batch."""
    writer = stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
    q = writer.trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
        return [p.numInputRows for p in q.recentProgress if p.numInputRows > 0]
    finally:
        q.stop()


def _copy(batch: DataFrame) -> DataFrame:
    """Messages forwarded as they are."""
    return batch


_ORDER = ["timestamp", "offset"]


@query("s01_topiclog_source", fx.sql(f"SELECT {_ROW} FROM topic_log WHERE part IN (1, 2) AND off >= 5"))
def s01_source(spark, sf):
    """The batch side of the source, with filters pushed to its ranges."""
    datasource.register(spark)
    log = spark.read.format("topiclog").option("path", fx.store(spark, sf).root).load()
    return _rows(log.where("partition IN (1, 2) AND offset >= 5"))


@query("s15_stream_scan", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def s15(spark, sf):
    at = run_to_table(spark, stream_of(spark, fx.store(spark, sf)), "scan")
    return _rows(spark.read.parquet(at))


@query("s22_partition_discovery", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def s22(spark, sf):
    """Partitions that appear between two runs are read from their first offset; the run resumes elsewhere."""
    log = new_log(spark, "discovery")
    messages = fx._messages(spark, sf)
    order = ["timestamp", "event_id"]
    at, checkpoint = scratch_dir(spark, "discovered"), scratch_dir(spark, "discovered-cp")
    log.append(messages.where("partition < 2"), "d-0", order)
    run_to_table(spark, stream_of(spark, log), "discovered", checkpoint, at)
    log.append(messages.where("partition >= 2"), "d-1", order)
    run_to_table(spark, stream_of(spark, log), "discovered", checkpoint, at)
    return _rows(spark.read.parquet(at))


def _rate(spark, sf) -> int:
    """A cap that gives about four micro-batches."""
    return max(50, fx.topic_log(spark, sf).count() // 4)


@query("s25_rate_limited_scan", fx.sql("SELECT count(*) AS n_rows, count(DISTINCT (topic_uri, part, off)) AS n_distinct, true AS within_cap, true AS several FROM topic_log"))
def s25(spark, sf):
    """The rows of a capped read, and what the cap did to its micro-batches."""
    checkpoint = scratch_dir(spark, "rate-cp")
    stream = stream_of(spark, fx.store(spark, sf), rowsPerSecond=_rate(spark, sf), tasks=8, checkpoint=checkpoint)
    out = BatchTable(spark, scratch_dir(spark, "rate"), "unused INT")
    root = out.root
    run_capped(stream, lambda batch, i: batch.write.mode("overwrite").parquet(f"{root}/batch={i}"), checkpoint)
    seen = spark.read.parquet(root)
    sizes = seen.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= _rate(spark, sf)).alias("within_cap"), (F.count(F.lit(1)) > 2).alias("several"))
    return sizes.crossJoin(seen.agg(F.countDistinct("topic_uri", "partition", "offset").alias("n_distinct")))  # two single rows


def _registry_line(topics: list[str]) -> str:
    clusters = [{"clusterId": f"cluster{c}", "bootstrapServers": "b:1", "clusterUriString": f"{fx.CLUSTER}{c}:", "topics": topics} for c in (0, 1)]
    return json.dumps({"streamId": "s0", "clusterMetadataList": clusters}) + "\n"


_ONCE = "SELECT topic_uri, part, off, 1::BIGINT AS n_times FROM topic_log WHERE event_type IN ('click', 'view')"


def _times(df: DataFrame) -> DataFrame:
    return fx.out(df.groupBy("topic_uri", "partition", "offset").agg(F.count(F.lit(1)).alias("n_times")))


@query("s24_live_resubscription", fx.sql(_ONCE))
def s24(spark, sf):
    """A topic leaves the registry, the stream restarts, rows arrive, the topic returns over another restart: every
    row comes once."""
    log, messages = new_log(spark, "returning"), fx._messages(spark, sf)
    registry, checkpoint, at = (scratch_dir(spark, n) for n in ("registry", "returning-cp", "returning-out"))
    middle, order = F.lit("2024-01-15").cast("timestamp"), ["timestamp", "event_id"]

    def run(topics: list[str]) -> None:
        files.write_text(spark, f"{registry}/streams.json", _registry_line(topics))
        stream = stream_of(spark, log, streamRegistry=f"{registry}/streams.json", streamIds="s0", checkpoint=checkpoint)
        run_to_table(spark, stream, "returning", checkpoint, at)

    log.append(messages.where(F.col("timestamp") < middle), "r-0", order)
    run(["click", "view"])
    run(["view"])
    log.append(messages.where(F.col("timestamp") >= middle), "r-1", order)
    run(["view"])
    run(["click", "view"])
    return _times(spark.read.parquet(at))


@query("s29_stream_pause", fx.sql(_ONCE))
def s29_stream(spark, sf):
    """Partitions 1 and 2 are read, paused over a restart while rows arrive, and resumed over another."""
    log, messages = new_log(spark, "paused"), fx._messages(spark, sf).where(F.col("topic_uri").rlike(":(click|view)$"))
    folder, checkpoint, at = (scratch_dir(spark, n) for n in ("paused", "paused-cp", "paused-out"))
    middle, order = F.lit("2024-01-15").cast("timestamp"), ["timestamp", "event_id"]

    def run(paused: list[int]) -> None:
        names = [f"{fx.CLUSTER}{c}:{t}|{p}" for c in (0, 1) for t in ("click", "view") for p in paused]
        files.write_text(spark, f"{folder}/paused.json", json.dumps(names))
        run_to_table(spark, stream_of(spark, log, pausedFile=f"{folder}/paused.json", checkpoint=checkpoint), "paused", checkpoint, at)

    log.append(messages.where(F.col("timestamp") < middle), "p-0", order)
    run([])
    log.append(messages.where(F.col("timestamp") >= middle), "p-1", order)
    run([1, 2])
    run([])
    return _times(spark.read.parquet(at))


@query("x03_commit_modes", fx.sql(
    "SELECT mode, topic_uri, part, latest AS next_offset FROM bounds, (VALUES ('on-checkpoints'), ('periodic')) m(mode)"))
def x03(spark, sf):
    """What a group has committed after a read under each mode; the third commits nothing."""
    found = []
    for mode in (dv.ON_CHECKPOINTS, dv.PERIODIC, dv.DISABLED):
        target = new_log(spark, f"mode-{mode}")
        step = dv.commit_progress(target, "g", mode, every=5)
        run_capped(stream_of(spark, fx.store(spark, sf)), step, scratch_dir(spark, f"mode-{mode}-cp"))
        found.append(target.group_offsets().select(F.lit(mode).alias("mode"), "topic_uri", "partition", "next_offset"))
    return fx.out(found[0].unionByName(found[1]).unionByName(found[2]))


class TopicTally:
    """A push listener that counts what its task is given, and leaves a file when the task is done."""

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.name, self.seen = f"{epoch_id}-{partition_id}", {}
        return True

    def process(self, row) -> None:
        self.seen[row.topic_uri] = self.seen.get(row.topic_uri, 0) + 1

    def close(self, error) -> None:
        if error is None and self.seen:
            filesystem, at = datasource._filesystem(self.folder)
            filesystem.create_dir(at, recursive=True)
            with filesystem.open_output_stream(f"{at}/{self.name}.json") as f:
                f.write("".join(json.dumps({"topic_uri": t, "n": n}) + "\n" for t, n in self.seen.items()).encode())


@query("d05_push_listener", fx.sql("SELECT topic_uri, count(*) AS n_messages FROM topic_log GROUP BY 1"))
def d05(spark, sf):
    """Every message is pushed to a listener in the tasks."""
    folder = scratch_dir(spark, "tally")
    dv.listen(stream_of(spark, fx.store(spark, sf)), TopicTally(folder), scratch_dir(spark, "tally-cp")).awaitTermination()
    seen = spark.read.schema("topic_uri STRING, n BIGINT").json(folder)
    return seen.groupBy("topic_uri").agg(F.sum("n").alias("n_messages"))


@query("d07_batch_reports", fx.sql(
    "SELECT count(*) AS n_messages, count(k) AS n_keyed, count(*) - count(v) AS n_null_value, "
    "CAST(sum(coalesce(strlen(k), 0) + coalesce(strlen(v), 0)) AS BIGINT) AS bytes_in, true AS several FROM topic_log"))
def d07(spark, sf):
    """The reports of all micro-batches of a capped read, summed up."""
    checkpoint, reports = scratch_dir(spark, "reports-cp"), BatchReports(spark, scratch_dir(spark, "reports"))
    stream = stream_of(spark, fx.store(spark, sf), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)
    spark.streams.addListener(reports)
    try:
        n = len(run_capped(observed(stream), lambda batch, i: batch.write.format("noop").mode("append").save(), checkpoint))
        for _ in range(300):  # reports come a moment after their batch
            if reports.seen() >= n:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(reports)
    return reports.table().agg(*[F.sum(c).alias(c) for c in ("n_messages", "n_keyed", "n_null_value", "bytes_in")],
                               (F.countDistinct("batch_id") > 2).alias("several"))


@query("k03_at_least_once", fx.sql("SELECT topic_uri, part, ts, k, v, 2::BIGINT AS n_times, count(*) AS n_equal FROM topic_log GROUP BY 1, 2, 3, 4, 5"))
def k03(spark, sf):
    """The weaker guarantee: the micro-batch is replayed by hand, and its rows arrive twice."""
    target, source = new_log(spark, "alo"), fx.store(spark, sf)
    q = dv.deliver(stream_of(spark, source), target, _copy, _ORDER, "alo", scratch_dir(spark, "alo-cp"),
                   guarantee=dv.AT_LEAST_ONCE)
    q.awaitTermination()
    dv.write_step(target, _copy, _ORDER, "alo", dv.AT_LEAST_ONCE)(source.read(), 0)
    equal = target.read().groupBy("topic_uri", "partition", "timestamp", "key", "value").agg(F.count(F.lit(1)).alias("n"))
    one = source.read().groupBy("topic_uri", "partition", "timestamp", "key", "value").agg(F.count(F.lit(1)).alias("n_equal"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("topic_uri", "partition", "timestamp", "key", "value")]
    both = equal.alias("a").join(one.alias("b"), same, "full")
    return fx.out(both.select("a.topic_uri", "a.partition", F.col("a.timestamp").alias("ts"), F.col("a.key").alias("k"),
                              F.col("a.value").alias("v"), F.call_function("div", F.col("n"), F.col("n_equal")).alias("n_times"), "n_equal"))


@query("k04_exactly_once", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def k04(spark, sf):
    """One transaction per micro-batch; the last one is replayed by hand and changes nothing."""
    source, target = fx.store(spark, sf), new_log(spark, "eos")
    dv.deliver(stream_of(spark, source), target, _copy, _ORDER, "eos", scratch_dir(spark, "eos-cp")).awaitTermination()
    dv.write_step(target, _copy, _ORDER, "eos")(source.read(), 0)
    return _rows(target.read())


@query("k06_consume_transform_produce", fx.sql(
    "SELECT 'g2' AS group_id, topic_uri, part, latest AS next_offset FROM bounds"))
def k06(spark, sf):
    """Input offsets become visible with the rows made from them."""
    target = new_log(spark, "ctp")
    dv.deliver(stream_of(spark, fx.store(spark, sf)), target, _copy, _ORDER, "ctp", scratch_dir(spark, "ctp-cp"),
               group_id="g2").awaitTermination()
    return fx.out(target.group_offsets().drop("committed_at"))


@query("x02_commit_after_batches", fx.sql(
    "SELECT 'g3' AS group_id, topic_uri, part, latest AS next_offset FROM bounds"))
def x02(spark, sf):
    """Group offsets committed after every micro-batch of a capped read."""
    commits, checkpoint = new_log(spark, "commits"), scratch_dir(spark, "commits-cp")
    stream = stream_of(spark, fx.store(spark, sf), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)
    run_capped(stream, dv.commit_progress(commits, "g3"), checkpoint)
    return fx.out(commits.group_offsets().drop("committed_at"))


class LostAfterCommit(RuntimeError):
    """A writer that dies between its marker and the checkpoint."""


@query("x12_exactly_once_after_failure", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def x12(spark, sf):
    """The writer dies right after committing its second transaction; the restart replays it without doubling."""
    source, target, checkpoint = fx.store(spark, sf), new_log(spark, "e2e"), scratch_dir(spark, "e2e-cp")
    cap = _rate(spark, sf)

    def die(batch_id: int) -> None:
        if batch_id == 1:
            raise LostAfterCommit("lost after commit")

    def start(on_commit) -> None:
        stream = stream_of(spark, source, maxRowsPerBatch=cap, checkpoint=checkpoint)
        run_capped(stream, dv.write_step(target, _copy, _ORDER, "e2e", on_commit=on_commit), checkpoint)

    try:
        start(die)
    except Exception as e:  # the stream reports the writer's death
        if "lost after commit" not in str(e):
            raise
    start(None)
    return _rows(target.read())


@query("x01_resumable_scan", fx.sql(f"SELECT {_ROW} FROM topic_log"))
def x01(spark, sf):
    """Two runs over a growing log; the second starts where the first ended."""
    log = new_log(spark, "resume")
    messages = fx._messages(spark, sf)
    order, middle = ["timestamp", "event_id"], F.lit("2024-01-15").cast("timestamp")
    at, checkpoint = scratch_dir(spark, "resumed"), scratch_dir(spark, "resumed-cp")
    log.append(messages.where(F.col("timestamp") < middle), "r-0", order)
    run_to_table(spark, stream_of(spark, log), "resumed", checkpoint, at)
    log.append(messages.where(F.col("timestamp") >= middle), "r-1", order)
    run_to_table(spark, stream_of(spark, log), "resumed", checkpoint, at)
    return _rows(spark.read.parquet(at))


@query("x05_live_changelog", fx.sql("SELECT * FROM changes", CHANGES))
def x05(spark, sf):
    """The upsert topic normalised live, in several micro-batches, against the last values of their keys."""
    checkpoint, root = scratch_dir(spark, "live-cp"), scratch_dir(spark, "live")
    stream = stream_of(spark, fx.store(spark, sf), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)
    live = LiveChangelog(spark, scratch_dir(spark, "live-state"), lambda df, i: df.write.mode("overwrite").parquet(f"{root}/batch={i}"), compact_every=2)
    run_capped(stream, live.step, checkpoint)
    changes = spark.read.schema(CHANGE_DDL).parquet(root)
    return fx.out(changes.select("topic_uri", "partition", "offset", F.col("key").alias("k"), "change_no", "row_kind",
                                 F.col("value").alias("v")))


@query("x06_live_buffered_upsert", buffered_sql(7))
def x06(spark, sf):
    """The buffers of every partition carried over several micro-batches, and drained at the end of the input."""
    root, checkpoint = scratch_dir(spark, "buffered"), scratch_dir(spark, "buffered-cp")
    out = f"{root}/out"
    sink = BufferedUpsert(
        spark, f"{root}/state", ["topic_uri", "partition"], ["key"], "offset", 7, ["value"],
        "topic_uri STRING, partition INT, key BINARY, offset BIGINT, row_kind STRING, value BINARY",
        lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}"))
    kind = F.when(F.col("value").isNull(), "-D").otherwise("+I")
    stream = stream_of(spark, fx.store(spark, sf), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)
    run_capped(stream.where(F.col("key").isNotNull()).withColumn("row_kind", kind), sink.step, checkpoint)
    sink.drain()
    return fx.out(spark.read.parquet(out).select(
        "topic_uri", "partition", F.col("key").alias("k"), "flush_no", "offset", "row_kind", F.col("value").alias("v")))


@query("w04_stream_tumble", fx.sql(
    "SELECT topic_uri, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_rows "
    "FROM topic_log GROUP BY 1, 2, 3 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM topic_log)"))
def w04_stream(spark, sf):
    """Spark's own watermark: hourly counts of all windows it has closed."""
    stream = stream_of(spark, fx.store(spark, sf)).withWatermark("timestamp", "10 minutes")
    counts = stream.groupBy("topic_uri", F.window("timestamp", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n_rows"))
    flat = counts.select("topic_uri", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows")
    root = scratch_dir(spark, "tumble")
    run_capped(flat, lambda batch, i: batch.write.mode("overwrite").parquet(f"{root}/batch={i}"), scratch_dir(spark, "tumble-cp"))
    return fx.out(spark.read.parquet(root).drop("batch"))


_CLOSED = ("closing AS (SELECT topic_uri, min(m) AS w FROM (SELECT topic_uri, part, max(ts) AS m FROM topic_log GROUP BY 1, 2) GROUP BY 1)")


@query("w05_stream_partition_watermark", fx.sql(
    "SELECT t.topic_uri, part, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_rows "
    "FROM topic_log t JOIN closing c ON c.topic_uri = t.topic_uri WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= c.w GROUP BY 1, 2, 3, 4", _CLOSED))
def w05_stream(spark, sf):
    """Hourly counts that close on the least of a topic's partition watermarks, in several micro-batches."""
    checkpoint, root = scratch_dir(spark, "pw-cp"), scratch_dir(spark, "pw")
    marks = PartitionWatermarks(spark, root, expected=fx.store(spark, sf).catalog())
    counts = TumblingCounts(spark, root, "1 hour", marks, ["topic_uri", "partition"])
    stream = stream_of(spark, fx.store(spark, sf), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)
    run_capped(stream, counts.step(), checkpoint)
    return fx.out(counts.results())


@query("x11_live_late_rows", fx.sql("SELECT topic_uri, part, off, ts, watermark FROM marks WHERE ts < watermark", _SEEN))
def x11(spark, sf):
    """Late rows found live, against what each partition had reached before."""
    fx.late_log(spark, sf)
    checkpoint, root = scratch_dir(spark, "late-cp"), scratch_dir(spark, "late-rows")
    marks = PartitionWatermarks(spark, root, delay="2 minutes")
    stream = stream_of(spark, fx._store(spark, sf, "late"), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)

    def late(batch: DataFrame, i: int) -> None:
        marks.late(batch, i).write.mode("overwrite").parquet(f"{root}/rows/batch={i}")

    run_capped(stream, dv.in_turn(late, marks.advance), checkpoint)
    late = spark.read.parquet(f"{root}/rows")
    return fx.out(late.select("topic_uri", "partition", "offset", F.col("timestamp").alias("ts"), "watermark"))


@query("u02_live_table", fx.sql("SELECT topic_uri, k, part, off, v FROM latest", LATEST))
def u02_live(spark, sf):
    """The current table kept by a stream in several micro-batches, compacted half way."""
    checkpoint, table = scratch_dir(spark, "table-cp"), UpsertTable(spark, scratch_dir(spark, "table"))
    stream = stream_of(spark, fx.store(spark, sf), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)
    run_capped(stream, table.step, checkpoint)
    table.compact(2)
    return fx.out(table.read().select("topic_uri", F.col("key").alias("k"), "partition", "offset", F.col("value").alias("v")))


@query("a11_live_counts", fx.sql("SELECT topic_uri AS k, CAST(count(*) AS VARCHAR) AS v FROM topic_log GROUP BY 1"))
def a11_live(spark, sf):
    """A streaming count per topic written to an upsert topic after every micro-batch, and the table it amounts to."""
    checkpoint, target = scratch_dir(spark, "counts-cp"), new_log(spark, "counts")
    stream = stream_of(spark, fx.store(spark, sf), maxRowsPerBatch=_rate(spark, sf), checkpoint=checkpoint)
    counts = stream.groupBy("topic_uri").agg(F.count(F.lit(1)).alias("n"))

    def messages(batch: DataFrame) -> DataFrame:
        return batch.select(
            F.lit(fx.CLUSTER + "9:counts").alias("topic_uri"), F.lit(0).alias("partition"), F.current_timestamp().alias("timestamp"),
            F.encode("topic_uri", "UTF-8").alias("key"), F.encode(F.col("n").cast("string"), "UTF-8").alias("value"),
            F.lit(None).cast("map<string,binary>").alias("headers"))

    run_capped(counts, dv.write_step(target, messages, ["key"], "counts"), checkpoint, mode="update")
    latest = latest_by_key(target.read())
    return fx.out(latest.select(F.col("key").alias("k"), F.col("value").alias("v")))


@query("j01_live_as_of", fx.sql(
    "SELECT l.topic_uri, l.part, l.off, l.k, CASE WHEN m.v IS NOT NULL THEN m.cents END AS version_cents FROM probes l "
    "ASOF LEFT JOIN versions m ON l.ck = m.ck AND l.ts >= m.ts "
    "WHERE l.k IS NOT NULL AND l.ts < (SELECT date_trunc('millisecond', max(ts)) FROM both_topics) - INTERVAL 5 MINUTE",
    "both_topics AS (SELECT *, cluster || k AS ck FROM topic_log WHERE event_type IN ('click', 'view') AND k IS NOT NULL)",
    "probes AS (SELECT * FROM both_topics WHERE event_type = 'click')",
    "versions AS (SELECT ck, ts, v, cents FROM both_topics WHERE event_type = 'view')"))
def j01_live(spark, sf):
    """Clicks joined live to the user's `view` row as of click time; every click the watermark has passed. The log grows
    twice between runs. Users are told apart by cluster, so there are two key columns."""
    log, root, checkpoint = new_log(spark, "as-of-log"), scratch_dir(spark, "as-of"), scratch_dir(spark, "as-of-cp")
    messages = fx._messages(spark, sf).where(F.col("topic_uri").rlike(":(click|view)$"))
    cluster = F.element_at(F.split("topic_uri", ":"), -2)

    def run() -> None:
        clicks, views = (stream_of(spark, log, topicPattern=t, checkpoint=checkpoint, sourceName=t).withColumn("cluster", cluster) for t in ("click", "view"))
        views = views.withColumn("version_cents", F.from_json(F.col("value").cast("string"), "cents BIGINT")["cents"])
        place = ["topic_uri", "partition", "offset"]
        both = both_sides(clicks, views, ["cluster", "key"], "timestamp", "timestamp", place, [*place, "timestamp"], ["version_cents"], F.col("value").isNull())
        write = lambda df, i: df.write.mode("overwrite").parquet(f"{root}/out/batch={i}")
        run_capped(both, LiveAsOfJoin(spark, root, ["cluster", "key"], both, "5 MINUTES", write, compact_every=1).step, checkpoint)

    days = [F.lit(d).cast("timestamp") for d in ("2024-01-01", "2024-01-12", "2024-01-22", "2024-03-01")]
    for n, (low, high) in enumerate(zip(days, days[1:])):
        log.append(messages.where((F.col("timestamp") >= low) & (F.col("timestamp") < high)), f"j-{n}", ["timestamp", "event_id"])
        run()
    return fx.out(spark.read.parquet(f"{root}/out").select("topic_uri", "partition", "offset", F.col("key").alias("k"), "version_cents"))


@query("s13_stream_from_timestamp", fx.sql(
    "SELECT l.topic_uri, l.part, l.off FROM topic_log l JOIN "
    f"(SELECT topic_uri, part, min(off) AS f FROM topic_log WHERE ts >= {AT_SQL} GROUP BY 1, 2) s "
    "ON s.topic_uri = l.topic_uri AND s.part = l.part WHERE l.off >= s.f"))
def s13_stream(spark, sf):
    """A stream that starts at a time, through resolved offsets."""
    log = fx.store(spark, sf)
    start = ranges.resolve(log.read(), ranges.at_timestamp(AT, log), known=log.bounds())
    positions = datasource.write_positions(start, scratch_dir(spark, "positions"))
    at = run_to_table(spark, stream_of(spark, log, startingOffsets=positions), "from-time")
    return fx.out(spark.read.parquet(at).select("topic_uri", "partition", "offset"))


@query("x08_bucketed_shuffle", "SELECT conv_id % 10 AS k, count(*) AS n_rows, max(length(text)) AS longest FROM conversations GROUP BY 1")
def x08(spark, sf):
    """The batch form of the keyed shuffle: grouping the bucketed table needs no second one."""
    c = fx.table(spark, sf, "conversations").select((F.col("conv_id") % 10).alias("k"), "text")
    name = "tidelog_" + scratch_dir(spark, "b").rsplit("-", 1)[-1]
    t = shuffle.write_bucketed(c, name, scratch_dir(spark, "bucketed"), "k", 8)
    return t.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.length("text")).cast("bigint").alias("longest"))


_HOT_ORDERS = "CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN 5 ELSE l_orderkey END"


def _skewed_lines(spark, sf) -> shuffle.SkewedBuckets:
    """Lines by order; a third of them have no order, and a seventh the same one."""
    lines = fx.table(spark, sf, "lineitem").select(F.expr(_HOT_ORDERS).alias("k"), F.col("l_quantity").cast("bigint").alias("qty"))
    name = "tidelog_" + scratch_dir(spark, "s").rsplit("-", 1)[-1]
    return shuffle.write_skewed(lines, name, scratch_dir(spark, "skewed"), "k", 8)


@query("x08_skewed_groups", f"""SELECT {_HOT_ORDERS} AS k, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
FROM lineitem GROUP BY 1""")
def x08_groups(spark, sf):
    """Grouping buckets whose hot keys lie apart: no shuffle for the others, and no task with a whole hot key."""
    return _skewed_lines(spark, sf).aggregate(F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("qty"))


@query("x08_skewed_join", f"""SELECT o.o_orderstatus AS status, count(*) AS n_rows, CAST(sum(l.qty) AS BIGINT) AS qty
FROM (SELECT {_HOT_ORDERS} AS k, CAST(l_quantity AS BIGINT) AS qty FROM lineitem) l LEFT JOIN orders o ON l.k = o.o_orderkey GROUP BY 1""")
def x08_join(spark, sf):
    """Lines with their orders, hot ones met where they lie."""
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    met = _skewed_lines(spark, sf).join(orders, "left")
    return met.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("qty"))
