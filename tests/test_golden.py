"""Small cases with results known beforehand."""

from datetime import datetime as dt
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelog import constants as C
from tidelog.constants import LOG_DDL
from tidelog.functions import cdc
from tidelog.operators import changelog, eventtime, produce, project, ranges

T = "plaintext:/rn:kafka:env:cloud_region1::cluster0:t"


def log_of(spark, rows):
    """rows: (partition, offset, timestamp, key, value, headers)."""
    as_bytes = lambda x: x.encode() if isinstance(x, str) else x
    return spark.createDataFrame(
        [(T, p, o, ts, as_bytes(k), as_bytes(v), h) for p, o, ts, k, v, h in rows], LOG_DDL)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_tumbling_window(spark):
    rows = [("7.25", 11.5), ("0.40", 12.0), ("19", 14.999), ("3", 15.0), ("8.5", 19.25)]
    df = spark.createDataFrame([(Decimal(p), dt(2021, 6, 1, 8) + timedelta(seconds=t)) for p, t in rows], "price DECIMAL(38,18), ts TIMESTAMP")
    w = eventtime.tumble(df, "ts", "5 seconds", [F.count(F.lit(1)).alias("n"), F.max("price").cast("decimal(10,2)").alias("top")])
    assert got(w.select("window_end", "n", "top")) == [
        (dt(2021, 6, 1, 8, 0, 15), 3, Decimal("19.00")), (dt(2021, 6, 1, 8, 0, 20), 2, Decimal("8.50"))]


def three(spark):
    ms = lambda n: dt(2020, 1, 1, 0, 0, 0, n * 1000)
    return log_of(spark, [(0, i, ms(t), None, f'{{"user_id":{i},"item_id":{i + 10},"behavior":"b{i}"}}', None)
                          for i, t in enumerate([0, 3, 7])])


def test_bounded_offsets(spark):
    stop = ranges.specific(ranges.offsets_from_text(spark, [T], "partition:0,offset:2"))
    assert [r.offset for r in ranges.read_slice(three(spark), ranges.earliest(), stop).collect()] == [0, 1]


def test_bounded_timestamp(spark):
    stop = ranges.at_timestamp(dt(2020, 1, 1, 0, 0, 0, 5000))
    assert [r.offset for r in ranges.read_slice(three(spark), ranges.earliest(), stop).collect()] == [0, 1]


def test_stop_before_first_record_gives_nothing(spark):
    stop = ranges.at_timestamp(dt(2019, 1, 1))
    assert ranges.read_slice(three(spark), ranges.earliest(), stop).count() == 0


def test_stop_by_time_is_by_position(spark):
    times = [dt(2020, 1, 1), dt(2020, 1, 5), dt(2020, 1, 2)]
    log = log_of(spark, [(0, i, t, None, "{}", None) for i, t in enumerate(times)])
    assert [r.offset for r in ranges.read_slice(log, ranges.earliest(), ranges.at_timestamp(dt(2020, 1, 3))).collect()] == [0]


def test_key_with_prefix_and_value_without_key(spark):
    key, value = '{"user_id":1,"event_id":100}', '{"name":"name 1","user_id":41,"payload":"payload 1"}'
    log = log_of(spark, [(0, 0, dt(2020, 3, 8, 13, 12, 11, 123000), key, value, None)])
    t = project.read_table(
        log, "k_user_id BIGINT, name STRING, k_event_id BIGINT, user_id INT, payload STRING", ["k_event_id", "k_user_id"],
        prefix="k_", strategy="EXCEPT_KEY", metadata_columns={"timestamp": "timestamp"})
    assert got(t) == [(1, "name 1", 100, 41, "payload 1", dt(2020, 3, 8, 13, 12, 11, 123000))]


def test_key_and_full_value(spark):
    key, value = '{"user_id":1,"event_id":100}', '{"user_id":1,"name":"name 1","event_id":100,"payload":"p"}'
    log = log_of(spark, [(0, 0, dt(2020, 3, 8), key, value, None)])
    t = project.read_table(log, "user_id BIGINT, name STRING, event_id BIGINT, payload STRING", ["event_id", "user_id"])
    assert got(t) == [(1, "name 1", 100, "p")]


def test_metadata_columns(spark):
    h = {"k1": b"\xc0\xff\xee", C.PRODUCE_TIMESTAMP_HEADER: b"\x00" * 8}
    log = log_of(spark, [(0, 5, dt(2020, 1, 1), None, '{"physical_1":"a","physical_2":1,"physical_3":true}', h)])
    t = project.read_table(log, "physical_1 STRING, physical_2 INT, physical_3 BOOLEAN", metadata_columns={
        "h": "headers", "s": C.SYSTEM_HEADERS_KEY, "o": "offset"})
    r = t.first()
    assert (r.physical_1, r.physical_2, r.physical_3, list(r.h), list(r.s), r.o) == ("a", 1, True, ["k1"], [C.PRODUCE_TIMESTAMP_HEADER], 5)
    with pytest.raises(ValueError):
        project.metadata("leader-epoch")


def test_projection_errors(spark):
    with pytest.raises(ValueError):
        project.key_fields("a INT", ["b"])
    with pytest.raises(ValueError):
        project.key_fields("a INT", ["a"], "k_")
    with pytest.raises(ValueError):
        project.value_fields("a INT", ["a"], "ALL", "k_")


def test_null_value_outside_upsert_mode_is_an_error(spark):
    log = log_of(spark, [(0, 0, dt(2020, 1, 1), "k", None, None)])
    with pytest.raises(Exception, match="null value outside upsert mode"):
        project.read_table(log, "a INT").collect()
    kinds = project.read_table(log, "k STRING, a INT", ["k"], key_format="raw", strategy="EXCEPT_KEY", upsert=True).collect()
    assert [(r.k, r.a, r.row_kind) for r in kinds] == [("k", None, "-D")]


def test_nested_projection(spark):
    df = spark.createDataFrame([(1, ("x", (2, "q")))], "a INT, b STRUCT<x: STRING, y: STRUCT<p: INT, q: STRING>>")
    assert project.project(df, ["b.y.q", "a", "b.x"]).columns == ["b.y.q", "a", "b.x"]


def test_upsert_changelog(spark):
    at = dt(2020, 1, 1)
    log = log_of(spark, [(0, 0, at, "k", "p1", None), (0, 1, at, "k", "p1-new", None), (0, 2, at, "k", None, None),
                         (0, 3, at, "k", None, None), (0, 4, at, "z", None, None), (0, 5, at, "k", "p2", None),
                         (0, 6, at, "k", "p2", None)])
    want = [(0, 0, "+I", b"p1"), (1, 0, "-U", b"p1"), (1, 1, "+U", b"p1-new"), (2, 0, "-D", b"p1-new"), (5, 0, "+I", b"p2")]
    for rows in (None, 1, 2, 3):  # however the key is sliced
        c = changelog.to_changelog(log, slice_rows=rows).select("offset", "change_no", "row_kind", "value")
        assert [(o, n, k, bytes(v)) for o, n, k, v in got(c)] == want
    every = changelog.to_changelog(log, skip_unchanged=False).where("offset = 6")
    assert [r.row_kind for r in every.orderBy("change_no").collect()] == ["-U", "+U"]


def test_buffered_upsert(spark):
    rows = [(0, i, k, v, "+I") for i, (k, v) in enumerate([(1, "a"), (2, "b"), (3, "c"), (3, "d")])]
    df = spark.createDataFrame(rows, "w INT, pos BIGINT, k INT, v STRING, row_kind STRING")
    out = changelog.buffered_upsert(df, ["w"], ["k"], "pos", 2, ["v"])
    assert got(out.select("k", "v", "row_kind")) == [(1, "a", "+U"), (2, "b", "+U"), (3, "d", "+U")]
    assert changelog.validate_buffer_options(2, 100) and not changelog.validate_buffer_options(0, 0)
    with pytest.raises(ValueError):
        changelog.validate_buffer_options(2, 0)


def test_word_count_into_an_upsert_topic(spark):
    words = "red blue red green red blue white".split()
    df = spark.createDataFrame(list(enumerate(words)), "pos INT, word STRING")
    c = changelog.count_changelog(df, "word", ["pos"])
    assert c.count() == 10  # four first counts and three changes of two rows each
    assert c.where("row_kind <> '-U'").count() == 7
    final = got(df.groupBy("word").count())
    assert final == [("blue", 2), ("green", 1), ("red", 3), ("white", 1)]
    last = c.where("row_kind <> '-U'").groupBy("word").agg(F.max("n").alias("n"))
    assert got(last.select("word", "n")) == final


# fixed values: products as (op, before, after) with (id, name, weight)
DEBEZIUM = [
    ("c", None, (101, "scooter", 3.14)), ("c", None, (102, "car battery", 8.1)), ("c", None, (103, "12-pack drill bits", 0.8)),
    ("c", None, (104, "hammer", 0.75)), ("c", None, (105, "hammer", 0.875)), ("c", None, (106, "hammer", 1.0)),
    ("c", None, (107, "rocks", 5.3)), ("c", None, (108, "jacket", 0.1)), ("c", None, (109, "spare tire", 22.2)),
    ("u", (106, "hammer", 1.0), (106, "hammer", 1.0)), ("u", (107, "rocks", 5.3), (107, "rocks", 5.1)),
    ("c", None, (110, "jacket", 0.2)), ("c", None, (111, "scooter", 5.18)), ("u", (110, "jacket", 0.2), (110, "jacket", 0.5)),
    ("u", (111, "scooter", 5.18), (111, "scooter", 5.17)), ("d", (111, "scooter", 5.17), None),
]


def test_debezium_retracting_sums(spark):
    row = "struct<id: int, name: string, weight: double>"
    df = spark.createDataFrame(
        [(i, op, b, a) for i, (op, b, a) in enumerate(DEBEZIUM)], f"off INT, op STRING, before {row}, after {row}")
    messages = df.select("off", F.to_json(F.struct("before", "after", "op"), {"ignoreNullFields": "false"}).alias("value"))
    changes = cdc.debezium(messages, "value", "id INT, name STRING, weight DOUBLE", ["off"])
    sums = changelog.retract_sums(changes, ["name"], ["id"], {"total": F.col("weight")}, ["off", "change_no"], {"first_id": "id"})
    totals = {r.name: round(r.total, 3) for r in sums.collect()}
    assert totals == {"scooter": 3.14, "car battery": 8.1, "12-pack drill bits": 0.8, "hammer": 2.625, "rocks": 5.1,
                      "jacket": 0.6, "spare tire": 22.2}


def test_canal_and_maxwell(spark):
    canal = [
        '{"data":[{"id":"1","name":"a"},{"id":"2","name":"b"}],"old":null,"type":"INSERT","es":1000}',
        '{"data":[{"id":"1","name":"c"}],"old":[{"name":"a"}],"type":"UPDATE","es":2000}',
        '{"data":[{"id":"1","name":null}],"old":[{"name":"c"}],"type":"UPDATE","es":2000}',
        '{"data":[{"id":"2","name":"b"}],"old":null,"type":"DELETE","es":3000}', '{"isDdl":true,"type":"CREATE"}']
    df = spark.createDataFrame(list(enumerate(canal)), "off INT, value STRING")
    c = cdc.canal(df, "value", "id INT, name STRING", ["off"])
    rows = [tuple(r) for r in c.orderBy("off", "change_no").select("row_kind", "id", "name").collect()]
    assert rows == [("+I", 1, "a"), ("+I", 2, "b"), ("-U", 1, "a"), ("+U", 1, "c"), ("-U", 1, "c"), ("+U", 1, None), ("-D", 2, "b")]
    maxwell = [
        '{"type":"insert","ts":1,"data":{"id":1,"w":3.14}}', '{"type":"update","ts":2,"data":{"id":1,"w":2.5},"old":{"w":3.14}}',
        '{"type":"delete","ts":3,"data":{"id":1,"w":2.5}}']
    df = spark.createDataFrame(list(enumerate(maxwell)), "off INT, value STRING")
    m = cdc.maxwell(df, "value", "id INT, w DOUBLE", ["off"])
    rows = [tuple(r) for r in m.orderBy("off", "change_no").select("row_kind", "id", "w").collect()]
    assert rows == [("+I", 1, 3.14), ("-U", 1, 3.14), ("+U", 1, 2.5), ("-D", 1, 2.5)]


def test_as_of_join_against_a_cdc_topic(spark):
    at = lambda minute: dt(2022, 3, 4, 9) + timedelta(minutes=minute)
    versions = spark.createDataFrame([
        ("door", at(0), 0, "oak", "+I"), ("lamp", at(0), 1, "brass", "+I"), ("door", at(20), 2, "pine", "+U"),
        ("lamp", at(30), 3, "brass", "-D"), ("door", at(20), 4, "ash", "+U"), ("door", at(45), 5, "ash", "-D"), ("door", at(50), 6, "elm", "+I"),
    ], "id STRING, vt TIMESTAMP, off INT, wood STRING, row_kind STRING")
    asked = [("door", -1, None), ("door", 0, "oak"), ("door", 19, "oak"), ("door", 20, "ash"), ("door", 44, "ash"), ("door", 45, None), ("door", 60, "elm"),
             ("lamp", 29, "brass"), ("lamp", 31, None), ("rug", 5, None), (None, 5, None)]
    probes = spark.createDataFrame([(i, k, at(m)) for i, (k, m, _) in enumerate(asked)], "o INT, id STRING, at TIMESTAMP")
    j = changelog.as_of_join(probes, versions, ["id"], "at", "vt", ["off"], ["wood"], F.col("row_kind") == "-D")
    assert {r.o: r.wood for r in j.collect()} == {i: w for i, (_, _, w) in enumerate(asked)}


def test_as_of_join_against_an_upsert_topic(spark):
    at = lambda hour: dt(2022, 3, 4, hour)
    versions = spark.createDataFrame([(7, at(2), 0, "north", "x"), (7, at(5), 1, "south", "x"), (7, at(9), 2, None, None)],
                                     "u INT, vt TIMESTAMP, off INT, hall STRING, value STRING")
    visits = spark.createDataFrame([(h, 7, at(h)) for h in (1, 2, 4, 5, 8, 9, 11)], "i INT, u INT, at TIMESTAMP")
    j = changelog.as_of_join(visits, versions, ["u"], "at", "vt", ["off"], ["hall"], F.col("value").isNull())
    assert {r.i: r.hall for r in j.collect()} == {1: None, 2: "north", 4: "north", 5: "south", 8: "south", 9: None, 11: None}



def test_partition_disorder_makes_nothing_late(spark):
    rows = [(p, o, dt(2020, 1, 4 - p, 0, o), None, "x", None) for p in range(4) for o in range(4)]
    assert eventtime.late_rows(log_of(spark, rows)).count() == 0


def test_idle_partitions_do_not_hold_the_watermark(spark):
    at = lambda h, m: dt(2020, 3, 8, h, m)
    rows = [(0, 0, at(13, 12), None, "x", None), (0, 1, at(13, 15), None, "x", None), (0, 2, at(16, 12), None, "x", None),
            (1, 0, at(13, 13), None, "x", None), (1, 1, at(13, 19), None, "x", None), (1, 2, at(16, 13), None, "x", None),
            (2, 0, at(1, 0), None, "x", None)]
    log = log_of(spark, rows)
    progress = eventtime.partition_progress(log)
    now = F.lit("2020-03-08 16:30:00").cast("timestamp")
    assert eventtime.overall_watermark(progress, ["topic_uri"]).first().watermark == at(1, 0)
    mark = eventtime.overall_watermark(progress, ["topic_uri"], "1 hour", now).first().watermark
    assert mark == at(16, 12)
    windows = eventtime.tumble(log.where("partition < 2"), "timestamp", "1 hour", [F.count(F.lit(1)).alias("n")], ["partition"])
    closed = windows.where(F.col("window_end") <= F.lit(mark))
    assert got(closed.select("partition", "n")) == [(0, 2), (1, 2)]


def test_interleave_skips_drained_sources(spark):
    rows = [(p, o, dt(2020, 1, 1), None, f"{p}{o}", None) for p, n in enumerate([3, 1, 2]) for o in range(n)]
    merged = produce.interleave(log_of(spark, rows), ["topic_uri", "partition"], ["offset"])
    order = [(r.partition, r.offset) for r in merged.orderBy("position").collect()]
    assert order == [(0, 0), (1, 0), (2, 0), (0, 1), (2, 1), (0, 2)]


def test_poll_more_than_a_window_limit(spark):
    log = log_of(spark, [(0, i, dt(2020, 1, 1), None, "x", None) for i in range(1200)])
    assert ranges.poll(log, 1100).count() == 1100
    assert ranges.poll(log, 7).count() == 7


def test_offset_text():
    assert ranges.parse_offset_text("partition:0,offset:42;partition:1,offset:300") == {0: 42, 1: 300}
    for bad in ["", "partition:0", "partition:a,offset:1", "offset:1,partition:0", "partition:0,offset:1,x:2"]:
        with pytest.raises(ValueError):
            ranges.parse_offset_text(bad)


def test_offset_text_needs_one_topic(spark):
    with pytest.raises(ValueError):
        ranges.offsets_from_text(spark, ["a", "b"], "partition:0,offset:1")


def test_missing_commit_is_an_error(spark):
    log = three(spark)
    none = spark.createDataFrame([], "group_id STRING, topic_uri STRING, partition INT, next_offset BIGINT")
    with pytest.raises(Exception, match="no committed offset"):
        ranges.read_slice(log, ranges.committed(none, "g")).collect()
    with pytest.raises(Exception, match="no committed offset"):
        ranges.read_slice(log, ranges.earliest(), ranges.committed_only(none, "g")).collect()
    with pytest.raises(ValueError):
        ranges.committed(none, "")
    assert ranges.read_slice(log, ranges.committed(none, "g", "latest")).count() == 0


def test_rescale_only_above_the_partition_count(spark):
    cat = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "topic_uri STRING, partition INT")
    df = spark.range(10).coalesce(1)
    assert ranges.rescale(df, 1, cat).rdd.getNumPartitions() == 1
    assert ranges.rescale(df, 2, cat).rdd.getNumPartitions() == 2
    assert ranges.rescale(df, 4, cat, enabled=False).rdd.getNumPartitions() == 1


def test_as_of_join_with_a_hot_key(spark):
    """One key holds a third of all rows and many versions at equal times; compared with a scan per row."""
    import random

    r = random.Random(5)
    key = lambda i: "hot" if i % 3 == 0 else f"k{r.randrange(30)}"
    at = lambda: dt(2020, 1, 1, 0, r.randrange(60), r.randrange(3))
    versions = [(key(i), at(), i, None if r.random() < 0.2 else f"v{i}") for i in range(600)]
    left = [(i, key(i), at()) for i in range(900)]
    j = changelog.as_of_join(
        spark.createDataFrame(left, "i INT, k STRING, at TIMESTAMP"),
        spark.createDataFrame(versions, "k STRING, vt TIMESTAMP, off INT, v STRING"),
        ["k"], "at", "vt", ["off"], ["v"], F.col("v").isNull())
    want = {}
    for i, k, t in left:
        seen = [(vt, off, v) for vk, vt, off, v in versions if vk == k and vt <= t]
        want[i] = max(seen, key=lambda x: x[:2])[2] if seen else None
    assert {r.i: r.v for r in j.collect()} == want
