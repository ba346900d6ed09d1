"""Streams: failures, subscriptions that change, listeners, reports, shuffles."""

import json
import os
from datetime import datetime as dt
from datetime import timedelta
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidelog.constants import LOG_DDL
from tidelog.operators import metrics, ordered, ranges
from tidelog.plans import streams
from tidelog.sources import datasource, registry, topiclog
from tidelog.sources.topiclog import TopicLog
from tidelog.streaming import deliver as dv
from tidelog.streaming import shuffle
from tidelog.streaming.reports import BatchReports, observed
from tidelog.streaming.upsert import UpsertTable
from tidelog.streaming.watermarks import PartitionWatermarks

C0 = "plaintext:/rn:kafka:env:cloud_region1::cluster0:"
ORDER = ["timestamp", "n"]


def messages(spark, topic, n, start=0, hot=False):
    """`n` messages; with `hot` two thirds go to partition 0."""
    part = F.when(F.col("id") % 3 < 2, 0).otherwise(1) if hot else F.col("id") % 2
    return spark.range(start, start + n).select(
        F.lit(C0 + topic).alias("topic_uri"), part.cast("int").alias("partition"), F.timestamp_seconds("id").alias("timestamp"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("key"), F.encode(F.col("id").cast("string"), "UTF-8").alias("value"),
        F.lit(None).cast("map<string,binary>").alias("headers"), F.col("id").alias("n"))


@pytest.fixture
def log(spark, tmp_path):
    return TopicLog(spark, str(tmp_path / "log"))


def ids(df):
    return sorted(int(bytes(r.value)) for r in df.collect())


def test_uncommitted_rows_are_hidden(spark, log):
    log.append(messages(spark, "t", 10), "a-0", ORDER)
    log.stage(messages(spark, "t", 5, 10), "a-1", ORDER)
    assert ids(log.read()) == list(range(10))
    assert ids(log.read("uncommitted")) == list(range(15))
    assert log.abort_lingering(["b"]) == []
    assert log.abort_lingering(["a"]) == ["a-1"]
    assert ids(log.read("uncommitted")) == list(range(10))


def test_replayed_stage_replaces_what_was_there(spark, log):
    log.stage(messages(spark, "t", 9), "a-0", ORDER)
    log.append(messages(spark, "t", 4), "a-0", ORDER)
    assert ids(log.read()) == [0, 1, 2, 3]
    assert not log.append(messages(spark, "t", 7), "a-0", ORDER)
    assert ids(log.read()) == [0, 1, 2, 3]


def test_an_empty_transaction_commits(spark, log):
    assert log.append(messages(spark, "t", 0), "a-0", ORDER)
    log.append(messages(spark, "t", 3), "a-1", ORDER)
    assert ids(log.read()) == [0, 1, 2]


def test_a_hot_partition_is_written_by_many_tasks(spark, log):
    log.append(messages(spark, "t", 4000, hot=True), "a-0", ORDER)
    hot = log.read().where("partition = 0")
    assert hot.select(F.input_file_name()).distinct().count() > 2
    assert hot.agg(F.max("offset")).first()[0] == hot.count() - 1
    assert metrics.gaps(hot, ["topic_uri", "partition"], "offset").count() == 0


def test_writers_take_many_rows_in_turns(spark, log, monkeypatch):
    """A fixed number of writers, but no task of one sorts more than some SLICE_ROWS rows, and no two files of a partition
    overlap, so the source finds every row."""
    monkeypatch.setattr(topiclog, "SLICE_ROWS", 100)
    monkeypatch.setattr(ordered, "SLICE_ROWS", 10)
    log.append(messages(spark, "t", 150), "a-0", ORDER, tasks=2)
    log.append(messages(spark, "t", 2000, 150), "a-1", ORDER, tasks=2)

    def rows_of(txn):
        written = log.read(with_txn=True).where(F.col("txn") == txn).select(F.col("_metadata.file_name").substr(1, 10).alias("task"))
        return [r[0] for r in written.groupBy("task").count().select("count").collect()]

    assert len(rows_of("a-0")) <= 2
    assert max(rows_of("a-1")) <= 300
    spans = sorted((r.partition, r.first_offset, r.next_offset) for r in log.ranges().collect())
    assert all(a[0] != b[0] or a[2] == b[1] for a, b in zip(spans, spans[1:]))
    datasource.register(spark)
    source = spark.read.format("topiclog").option("path", log.root).option("rowsPerTask", 10).load()
    assert ids(source) == ids(log.read()) == list(range(2150))


def test_death_between_write_and_marker(spark, tmp_path, log):
    log.append(messages(spark, "t", 60), "load-0", ORDER)
    target, checkpoint = TopicLog(spark, str(tmp_path / "out")), str(tmp_path / "cp")
    armed = [True]
    commit = target.commit

    def dying_commit(txn):
        if armed[0] and txn.endswith("1"):
            armed[0] = False
            raise RuntimeError("lost before the marker")
        return commit(txn)

    target.commit = dying_commit
    step = dv.write_step(target, lambda b: b, ["timestamp", "offset"], "w")
    start = lambda: streams.run_capped(
        streams.stream_of(spark, log, maxRowsPerBatch=25, checkpoint=checkpoint), step, checkpoint)
    with pytest.raises(Exception, match="lost before the marker"):
        start()
    assert len(target.read().collect()) == 25 and target.staged()
    sizes = start()
    assert max(sizes) <= 25
    assert ids(target.read()) == list(range(60))
    assert metrics.duplicates(target.read(), ["value"]).count() == 0


def test_exactly_once_needs_a_checkpoint(spark, log):
    with pytest.raises(ValueError):
        dv.deliver(spark.readStream.format("rate").load(), log, lambda b: b, [], "p", None)


def write_registry(path, topics):
    line = {"streamId": "s0", "clusterMetadataList": [
        {"clusterId": "cluster0", "bootstrapServers": "b:1", "clusterUriString": C0, "topics": topics}]}
    replace(path, json.dumps(line) + "\n")


def replace(path, text):
    new = path.with_suffix(".new")
    new.write_text(text)
    new.replace(path)


def test_registry_file(spark, tmp_path):
    write_registry(tmp_path / "r.json", ["a", "b"])
    r = registry.read_registry(spark, str(tmp_path / "r.json"))
    assert sorted(x.topic_uri for x in r.collect()) == [C0 + "a", C0 + "b"]


def test_live_resubscription(spark, tmp_path, log):
    """A topic leaves the stream and comes back: it resumes where it was. A broken registry is tolerated for a while."""
    reg, checkpoint, out = tmp_path / "r.json", str(tmp_path / "cp"), str(tmp_path / "out")
    write_registry(reg, ["a", "b"])
    log.append(messages(spark, "a", 4).unionByName(messages(spark, "b", 4, 100)), "l-0", ORDER)
    stream = streams.stream_of(spark, log, streamRegistry=str(reg), streamIds="s0", registryFailures=1000, checkpoint=checkpoint)
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
        processingTime="0 seconds").start()
    read = lambda: ids(spark.read.schema(LOG_DDL).parquet(out))
    try:
        q.processAllAvailable()
        assert read() == [0, 1, 2, 3, 100, 101, 102, 103]
        write_registry(reg, ["a"])
        q.processAllAvailable()
        log.append(messages(spark, "a", 2, 4).unionByName(messages(spark, "b", 2, 104)), "l-1", ORDER)
        q.processAllAvailable()
        assert read() == [0, 1, 2, 3, 4, 5, 100, 101, 102, 103]
        replace(reg, "not json")
        log.append(messages(spark, "a", 1, 6), "l-2", ORDER)
        q.processAllAvailable()
        assert 6 in read()
        write_registry(reg, ["a", "b"])
        q.processAllAvailable()
        assert read() == [0, 1, 2, 3, 4, 5, 6, 100, 101, 102, 103, 104, 105]
    finally:
        q.stop()


def test_listener_and_reports(spark, tmp_path, log):
    log.append(messages(spark, "t", 20), "l-0", ORDER)
    seen, reports = tmp_path / "seen", BatchReports(spark, str(tmp_path / "reports"))
    seen.mkdir()
    folder = str(seen)

    def handle(row):
        with open(f"{folder}/{row.partition}-{row.offset}", "w") as f:
            f.write(str(row.offset))

    spark.streams.addListener(reports)
    try:
        dv.listen(observed(streams.stream_of(spark, log)), handle, str(tmp_path / "cp")).awaitTermination()
        assert len(list(seen.iterdir())) == 20
        for _ in range(100):
            if reports.seen():
                break
            __import__("time").sleep(0.1)
        row = reports.table().first()
        assert (row.n_messages, row.n_keyed, row.n_null_value) == (20, 20, 0) and row.bytes_in == 60
    finally:
        spark.streams.removeListener(reports)


def test_idle_partition_in_a_stream(spark, tmp_path):
    marks = PartitionWatermarks(spark, str(tmp_path / "m"), idle_after="1 hour")
    at = lambda h: F.lit(dt(2020, 1, 1, h)).cast("timestamp")
    row = lambda p, h: spark.createDataFrame([("t", p, h)], "topic_uri STRING, partition INT, h INT").select(
        "topic_uri", "partition", F.lit(dt(2020, 1, 1, h)).cast("timestamp").alias("timestamp"))
    marks.advance(row(0, 1).unionByName(row(1, 2)), 0, arrival=at(3))
    assert marks.current(now=at(3)).first().watermark == dt(2020, 1, 1, 1)
    marks.advance(row(1, 5), 1, arrival=at(5))
    marks.advance(row(1, 5), 1, arrival=at(5))  # a replay starts from the state before the batch
    assert marks.current(now=at(5)).first().watermark == dt(2020, 1, 1, 5)


def test_keyed_shuffle_with_a_hot_key(spark, tmp_path):
    log = TopicLog(spark, str(tmp_path / "s"))
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    key, value = F.encode(F.col("k").cast("string"), "UTF-8"), F.encode(F.col("id").cast("string"), "UTF-8")
    rows = shuffle.persistent_key_by(df, log, C0 + "s", key, value, 4, "w-0", ["id"], record_time=F.timestamp_seconds("id"))
    assert ids(rows) == list(range(3000))
    assert shuffle.keys_in_several_partitions(rows).count() == 0
    assert rows.where(F.col("record_time") != F.timestamp_seconds(F.col("value").cast("string").cast("bigint"))).count() == 0
    assert not shuffle.write_key_by(df, log, C0 + "s", key, value, 4, "w-0", ["id"])


def test_bucketed_table_needs_no_shuffle(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    t = shuffle.write_bucketed(df, "tidelog_bucketed", str(tmp_path / "b"), "k", 4)
    text = t.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    spark.sql("DROP TABLE tidelog_bucketed")


def _partition_sizes(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_skewed_buckets(spark, tmp_path):
    """Two hot keys, one of them null: buckets stay even, cold keys need no shuffle, results are those of the input."""
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.col("id") % 400)
    df = spark.range(0, 12000, numPartitions=8).select(key.cast("bigint").alias("k"), "id")
    at = str(tmp_path / "s")
    t = shuffle.write_skewed(df, "tidelog_skewed", at, "k", 8)
    assert {r.k: r.n_rows for r in t.keys.collect()} == {None: 4000, -1: 4000}
    assert sorted(tuple(r) for r in t.rows().select("id").collect()) == [(i,) for i in range(12000)]
    for side in (t.cold, t.hot):
        sizes = sorted(_partition_sizes(side))
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert "Exchange" not in t.cold.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    want = {r.k: (r.n, r.s) for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")).collect()}
    got = t.aggregate(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")).collect()
    assert len(got) == len(want) and {r.k: (r.n, r.s) for r in got} == want
    other = spark.createDataFrame([(-1, "a"), (-1, "b"), (2, "c"), (None, "d"), (9999, "e")], "k BIGINT, name STRING")
    again = shuffle.read_skewed(spark, "tidelog_skewed", at, "k")
    for how in ("inner", "left", "left_semi", "left_anti"):
        rows = lambda j: sorted((str(tuple(r)) for r in j.select(sorted(j.columns)).collect()))
        assert rows(again.join(other, how)) == rows(df.join(other, "k", how))
    with pytest.raises(ValueError):
        t.join(other, "full")
    spark.sql("DROP TABLE tidelog_skewed")


def test_skewed_buckets_without_hot_keys_or_rows(spark, tmp_path):
    even = spark.range(4000).select((F.col("id") % 500).alias("k"), "id")
    for name, df in (("even", even), ("none", even.limit(0))):
        t = shuffle.write_skewed(df, f"tidelog_{name}", str(tmp_path / name), "k", 4)
        assert t.keys.count() == t.hot.count() == 0 and t.cold.count() == df.count()
        assert t.aggregate(F.count(F.lit(1)).alias("n")).count() == df.select("k").distinct().count()
        spark.sql(f"DROP TABLE tidelog_{name}")


def test_offset_commits_can_be_switched_off(spark, tmp_path, log):
    log.append(messages(spark, "t", 10), "l-0", ORDER)
    for mode, want in [(dv.DISABLED, 0), (dv.ON_CHECKPOINTS, 2), (dv.PERIODIC, 2)]:
        target, cp = TopicLog(spark, str(tmp_path / mode)), str(tmp_path / f"cp-{mode}")
        streams.run_capped(streams.stream_of(spark, log), dv.commit_progress(target, "g", mode, every=5), cp)
        assert target.group_offsets().count() == want


def test_committed_offsets_last_write_wins(spark, log):
    row = lambda n, at: spark.createDataFrame(
        [("g", C0 + "t", 0, n, dt(2020, 1, at))], "group_id STRING, topic_uri STRING, partition INT, next_offset BIGINT, committed_at TIMESTAMP")
    log.commit_offsets(row(9, 1), "c-0")
    log.commit_offsets(row(4, 2), "c-1")
    assert log.group_offsets().first().next_offset == 4


def test_paused_partitions_keep_their_position(spark, tmp_path, log):
    """Paused before it was ever read, and again after, with a restart before each change."""
    paused, checkpoint, out = tmp_path / "paused.json", str(tmp_path / "cp"), str(tmp_path / "out")
    log.append(messages(spark, "t", 6).unionByName(messages(spark, "u", 2, 50)), "l-0", ORDER)
    read = lambda: ids(spark.read.schema(LOG_DDL).parquet(out))

    def run(names):
        replace(paused, json.dumps(names))
        stream = streams.stream_of(spark, log, pausedFile=str(paused), topicPattern="t", cluster="cluster0", checkpoint=checkpoint)
        streams.run_to_table(spark, stream, "paused", checkpoint, out)

    run([f"{C0}t|1"])
    assert read() == [0, 2, 4]
    log.append(messages(spark, "t", 2, 6), "l-1", ORDER)
    run([])
    assert read() == list(range(8))
    log.append(messages(spark, "t", 4, 8), "l-2", ORDER)
    run([f"{C0}t|1"])
    assert read() == [*range(8), 8, 10]
    log.append(messages(spark, "t", 2, 12), "l-3", ORDER)
    run([])
    assert read() == list(range(14))


def test_a_topic_leaves_and_returns_over_restarts(spark, tmp_path, log):
    reg, checkpoint, out = tmp_path / "r.json", str(tmp_path / "cp"), str(tmp_path / "out")
    read = lambda: ids(spark.read.schema(LOG_DDL).parquet(out))

    def run(topics):
        write_registry(reg, topics)
        stream = streams.stream_of(spark, log, streamRegistry=str(reg), streamIds="s0", checkpoint=checkpoint)
        streams.run_to_table(spark, stream, "returning", checkpoint, out)

    log.append(messages(spark, "a", 4).unionByName(messages(spark, "b", 4, 100)), "l-0", ORDER)
    run(["a", "b"])
    log.append(messages(spark, "a", 2, 4).unionByName(messages(spark, "b", 2, 104)), "l-1", ORDER)
    run(["a"])
    run(["a"])
    assert read() == [0, 1, 2, 3, 4, 5, 100, 101, 102, 103]
    run(["a", "b"])
    assert read() == [0, 1, 2, 3, 4, 5, 100, 101, 102, 103, 104, 105]


def test_two_capped_sources_resume_apart(spark, tmp_path, log):
    checkpoint, root = str(tmp_path / "cp"), str(tmp_path / "out")
    log.append(messages(spark, "a", 40).unionByName(messages(spark, "b", 60, 100)), "l-0", ORDER)
    armed = [True]

    def step(batch, i):
        if armed[0] and i == 2:
            armed[0] = False
            raise RuntimeError("lost in the third micro-batch")
        batch.write.mode("overwrite").parquet(f"{root}/batch={i}")

    def run():
        one, two = (streams.stream_of(spark, log, topicPattern=t, maxRowsPerBatch=n, checkpoint=checkpoint, sourceName=t) for t, n in (("a", 7), ("b", 11)))
        return streams.run_capped(one.union(two), step, checkpoint)

    with pytest.raises(Exception, match="lost in the third"):
        run()
    assert max(run()) <= 18
    log.append(messages(spark, "a", 5, 40), "l-1", ORDER)
    run()
    assert ids(spark.read.schema(LOG_DDL).parquet(root)) == [*range(45), *range(100, 160)]


def test_moving_subscriptions_need_a_checkpoint(spark, tmp_path, log):
    log.append(messages(spark, "t", 2), "l-0", ORDER)
    with pytest.raises(Exception, match="needs the option checkpoint"):
        stream = streams.stream_of(spark, log, pausedFile=str(tmp_path / "p"))
        streams.run_to_table(spark, stream, "refused", str(tmp_path / "cp"), str(tmp_path / "out"))


def test_start_from_a_positions_table(spark, tmp_path, log):
    log.append(messages(spark, "t", 10), "l-0", ORDER)
    start = spark.createDataFrame([(C0 + "t", 0, 3), (C0 + "t", 1, 4)], "topic_uri STRING, partition INT, start BIGINT")
    at = datasource.write_positions(start, str(tmp_path / "positions"))
    out = streams.run_to_table(spark, streams.stream_of(spark, log, startingOffsets=at), "from-table", str(tmp_path / "cp"), str(tmp_path / "out"))
    assert ids(spark.read.schema(LOG_DDL).parquet(out)) == [6, 8, 9]


def test_a_stream_goes_on_after_compaction(spark, tmp_path, log):
    checkpoint, out = str(tmp_path / "cp"), str(tmp_path / "out")

    def run():
        streams.run_to_table(spark, streams.stream_of(spark, log, checkpoint=checkpoint), "compacted", checkpoint, out)
        return ids(spark.read.schema(LOG_DDL).parquet(out))

    for n in range(12):
        log.append(messages(spark, "t", 3, 3 * n), f"b-{n}", ORDER)
    assert run() == list(range(36))
    assert log.compact() == "compact-00000001" and log.compact() is None
    log.append(messages(spark, "t", 4, 36), "b-12", ORDER)
    assert len(log.live()) == 2 and len(log.committed()) == 13
    index = datasource.LogIndex(log.root)
    index.refresh()
    assert len(index.opened) == 2  # two tables of ranges, not thirteen
    assert len(log.drop_replaced()) == 12
    assert run() == list(range(40))
    assert ids(log.read()) == list(range(40)) and not log.append(messages(spark, "t", 3), "b-0", ORDER)
    assert log.compact() is None and log.compact(everything=True) == "compact-00000002"
    assert log.drop_replaced() == ["b-12", "compact-00000001"] and log.staged() == []
    assert ids(log.read()) == list(range(40)) and run() == list(range(40))
    assert log.bounds().agg(F.sum("latest")).first()[0] == 40


def test_states_of_transactions(spark, log):
    """Uncommitted readings over two compactions, a crash inside one, and a staged transaction all the while."""
    for n in range(3):
        log.append(messages(spark, "t", 10, 10 * n), f"a-{n}", ORDER)
        if n == 0:
            log.stage(messages(spark, "t", 5, 100), "s-0", ORDER)
        else:
            log.compact(at_least=1)
        assert ids(log.read()) == list(range(10 * n + 10))
        assert ids(log.read("uncommitted")) == [*range(10 * n + 10), *range(100, 105)]
    publish, log._publish = log._publish, lambda *_: (_ for _ in ()).throw(RuntimeError("lost inside compact"))
    with pytest.raises(RuntimeError):
        log.compact(everything=True)
    log._publish = publish
    assert ids(log.read("uncommitted")) == [*range(30), *range(100, 105)] and log.staged() == ["s-0"]
    assert [log.state(t) for t in ("a-0", "a-2", "s-0", "x-0")] == ["replaced", "replaced", "staged", None]
    settle, log._settle = log._settle, lambda known: None  # lost before any marker is moved
    log.append(messages(spark, "t", 2, 30), "a-3", ORDER)
    log.fold(at_least=1)
    log._settle = settle
    assert log.state("a-3") == "committed" and ids(log.read()) == list(range(32))
    index = datasource.LogIndex(log.root)
    index.refresh()
    assert sum(b[1] for b in index.bounds().values()) == 32
    assert set(log.drop_replaced()) >= {"a-0", "a-1", "a-2"} and log.abort_lingering(["s"]) == ["s-0"]
    assert log.state("s-0") == "aborted" and ids(log.read("uncommitted")) == list(range(32))
    log.append(messages(spark, "t", 5, 100), "s-0", ORDER)
    assert log.state("s-0") == "committed" and ids(log.read()) == [*range(32), *range(100, 105)]
    with pytest.raises(ValueError):
        log.append(messages(spark, "t", 1), "compact-9", ORDER)


def small_transactions(root, n):
    """`n` committed transactions of two rows each, as the log writes them, without a Spark job for each."""
    topic, folder = C0 + "t", "topic_uri=" + quote(C0 + "t", safe="")
    for i in range(n):
        for part in range(2):
            at = f"{root}/data/txn=m-{i:05d}/{folder}/partition={part}"
            os.makedirs(at)
            stamp = pa.array([dt(2020, 1, 1) + timedelta(seconds=i)], pa.timestamp("us", "UTC"))
            value = pa.array([str(2 * i + part).encode()])
            pq.write_table(pa.table({"offset": pa.array([i]), "timestamp": stamp, "key": value, "value": value, "headers": pa.array([None], pa.map_(pa.string(), pa.binary()))}), f"{at}/part-0.parquet")
        os.makedirs(f"{root}/ranges/txn=m-{i:05d}")
        two = lambda x: [x, x]
        pq.write_table(pa.table({
            "topic_uri": two(topic), "partition": pa.array([0, 1], pa.int32()), "first_offset": two(i), "next_offset": two(i + 1), "n_rows": two(1),
            "min_timestamp": pa.array(two(stamp[0].as_py()), pa.timestamp("us", "UTC")), "max_timestamp": pa.array(two(stamp[0].as_py()), pa.timestamp("us", "UTC")),
            "file": [f"{folder}/partition={p}/part-0.parquet" for p in range(2)]}), f"{root}/ranges/txn=m-{i:05d}/part-0.parquet")
        os.makedirs(f"{root}/commits", exist_ok=True)
        open(f"{root}/commits/m-{i:05d}", "w").close()


def test_two_thousand_transactions(spark, tmp_path, log):
    """Planning opens a bounded number of files, times and polls read a few, rows are rewritten a few times."""
    small_transactions(log.root, 2000)
    commits, held = f"{log.root}/commits", f"{log.root}/held"
    os.rename(commits, held)
    os.makedirs(commits)
    names = sorted(os.listdir(held))
    for at in range(0, 2000, 64):  # folded as `commit` does, every 64
        for name in names[at : at + 64]:
            os.rename(f"{held}/{name}", f"{commits}/{name}")
        log.fold()
    index = datasource.LogIndex(log.root)
    index.refresh()
    assert len(index.opened) < 8 + 64  # parts of a few tiers, and transactions that are not in one yet
    assert index.bounds() == {f"{C0}t|{p}": (0, 2000) for p in range(2)}
    assert len(index.slices(f"{C0}t|0", 0, 2000, 500)) == 4
    at = dt(2020, 1, 1, 0, 20)
    found = ranges.resolve(log.read(), ranges.at_timestamp(at, log), known=log.bounds())
    assert {r.start for r in found.collect()} == {1200}
    reached = log.read_files(ranges._first_reaching(log, log.catalog(), F.lit(at)))
    assert len(reached.inputFiles()) == 2
    assert ids(ranges.poll(log.read(), 3, store=log)) == list(range(6))
    start = log.catalog().withColumn("start", F.lit(1990).cast("bigint"))
    assert ids(ranges.poll(log.read(), 4, start, store=log)) == list(range(3980, 3988))
    assert log.compact() is not None
    zones = log.ranges()
    assert zones.count() <= 16 and len(log.live()) == 1
    assert {r.start for r in ranges.resolve(log.read(), ranges.at_timestamp(at, log), known=log.bounds()).collect()} == {1200}
    assert ids(log.read()) == list(range(4000))


def test_products_of_a_level_become_one(spark, log):
    for n in range(8):
        log.append(messages(spark, "t", 2, 2 * n), f"a-{n}", ORDER)
        log.compact(at_least=1)
    assert len(log.live()) == 1 and log.manifest()[1]["levels"] == {log.live()[0]: 2}
    assert ids(log.read()) == list(range(16))


def test_settings_change_between_runs(spark, tmp_path, log):
    """Rates, registry patience, tasks and a wider, then narrower pattern: every row comes once."""
    checkpoint, root, runs = str(tmp_path / "cp"), str(tmp_path / "out"), [0]

    def run(**options):
        runs[0] += 1
        step = lambda batch, i: batch.write.mode("overwrite").parquet(f"{root}/batch={i}")
        streams.run_capped(streams.stream_of(spark, log, checkpoint=checkpoint, **options), step, checkpoint)
        return ids(spark.read.schema(LOG_DDL).parquet(root))

    log.append(messages(spark, "a", 40).unionByName(messages(spark, "b", 20, 100)), "l-0", ORDER)
    assert run(topicPattern="a", maxRowsPerBatch=10) == list(range(40))
    assert run(topicPattern="a", maxRowsPerBatch=10, registryFailures=5) == list(range(40))
    assert run(topicPattern="a|b", rowsPerSecond=1000, tasks=4, triggerSeconds=1) == [*range(40), *range(100, 120)]
    log.append(messages(spark, "a", 4, 40).unionByName(messages(spark, "b", 2, 120)), "l-1", ORDER)
    assert run(topicPattern="b", maxRowsPerBatch=7, rowsPerTask=5) == [*range(40), *range(100, 122)]
    assert run(topics=f"{C0}a,{C0}b", maxRowsPerBatch=9) == [*range(44), *range(100, 122)]


def test_positions_are_taken_over_from_the_record(spark, tmp_path, log):
    """A query that had no option `checkpoint` so far."""
    checkpoint, out = str(tmp_path / "cp"), str(tmp_path / "out")
    log.append(messages(spark, "a", 20), "l-0", ORDER)
    streams.run_to_table(spark, streams.stream_of(spark, log), "taken", checkpoint, out)
    log.append(messages(spark, "a", 5, 20), "l-1", ORDER)
    streams.run_to_table(spark, streams.stream_of(spark, log, checkpoint=checkpoint, maxRowsPerBatch=100), "taken", checkpoint, out)
    assert ids(spark.read.schema(LOG_DDL).parquet(out)) == list(range(25))


def test_sources_without_names_are_refused(spark, tmp_path, log):
    checkpoint = str(tmp_path / "cp")
    log.append(messages(spark, "a", 4).unionByName(messages(spark, "b", 4, 100)), "l-0", ORDER)
    one, two = (streams.stream_of(spark, log, topicPattern=t, checkpoint=checkpoint) for t in ("a", "b"))
    with pytest.raises(Exception, match="sourceName"):
        streams.run_to_table(spark, one.union(two), "refused", checkpoint, str(tmp_path / "out"))


def test_a_task_holds_a_few_pages_of_a_file(tmp_path):
    """One row group of 60 MB, of which a task never holds more than a fraction, nor of a file with few large rows."""
    def held(n, size):
        file = str(tmp_path / f"{n}.parquet")
        rows = [{"offset": i, "timestamp": dt(2024, 1, 1), "key": None, "value": b"%09d" % i + os.urandom(size), "headers": [("a", b"b")]} for i in range(n)]
        pq.write_table(pa.Table.from_pylist(rows, pa.schema([datasource._ARROW.field(c) for c in datasource._STORED])), file, row_group_size=n, use_dictionary=False, write_batch_size=16)
        del rows
        before, most, got = pa.total_allocated_bytes(), 0, []
        for batch in datasource._read(str(tmp_path), datasource.LogTask([datasource.LogSlice("t", 0, 3, n - 1, [file])])):
            most = max(most, pa.total_allocated_bytes() - before)
            got += batch.column("offset").to_pylist()
        assert got == list(range(3, n - 1))
        return most

    assert held(100_000, 600) < 30 << 20
    assert held(60, 1 << 20) < 50 << 20


def test_hadoop_paths_for_arrow():
    assert datasource.arrow_uri("s3a://bucket/log") == "s3://bucket/log"
    assert datasource.arrow_uri("hdfs://name/log") == "hdfs://name/log"
    assert datasource.arrow_uri("/log") == "/log"


def test_upsert_table_survives_compaction(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "table"))
    row = lambda key, offset, value: (C0 + "t", 0, offset, dt(2020, 1, 1), key, value, None)
    batch = lambda *rows: spark.createDataFrame(list(rows), LOG_DDL)
    table.step(batch(row(b"a", 0, b"1"), row(b"b", 1, b"2"), row(b"a", 2, b"3")), 0)
    table.step(batch(row(b"b", 3, None)), 1)
    table.compact(1)
    table.step(batch(row(b"c", 4, b"4")), 2)
    table.step(batch(row(b"c", 4, b"4")), 2)
    state = lambda: sorted((bytes(r.key), bytes(r.value)) for r in table.read().collect())
    assert state() == [(b"a", b"3"), (b"c", b"4")]
    table.compact(2)
    assert state() == [(b"a", b"3"), (b"c", b"4")]
