"""Functions and skew-safe operators against brute force."""

import random
import struct
import uuid
from datetime import datetime as dt
from datetime import timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog import constants as C
from tidelog.functions import binary, headers, offsets, partitioners, uri
from tidelog.operators import eventtime, metrics, ordered, percentiles, project, subscribe
from tidelog.operators.small import checked_broadcast
from tidelog.sources import datasource, kafka
from tidelog.streaming import deliver


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# --- payloads ----------------------------------------------------------------------------------------------
@pytest.mark.parametrize("kind,fmt,values", [
    ("byte", ">b", [0, 1, -1, 127, -128]), ("short", ">h", [0, 1, -1, 32767, -32768]),
    ("integer", ">i", [0, 1, -1, 2**31 - 1, -2**31]), ("long", ">q", [0, 1, -1, 2**63 - 1, -2**63]),
    ("float", ">f", [0.0, 1.5, -2.25, 2.0**-149, 2.0**-126, 3.4028234663852886e38, float("inf"), -float("inf")]),
    ("double", ">d", [0.0, 1.5, -2.25, 1e300, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -float("inf"), 0.1, -1 / 3]),
])
def test_fixed_width_payloads(spark, kind, fmt, values):
    rows = [(v, struct.pack(fmt, v)) for v in values] + [(None, None)]
    df = spark.createDataFrame(rows, f"v {'double' if kind in ('float', 'double') else 'bigint'}, b binary")
    out = df.select("v", "b", binary.decode(F.col("b"), kind).alias("d"), binary.encode(F.col("v"), kind).alias("e")).collect()
    for r in out:
        assert r.d == r.v and (r.e is None if r.b is None else bytes(r.e) == bytes(r.b))


def test_floating_bits(spark):
    """Random bits, negative zero and NaN, without a Python worker."""
    rnd = random.Random(8)
    for kind, fmt, width in (("float", ">f", 4), ("double", ">d", 8)):
        raw = [rnd.randbytes(width) for _ in range(3000)] + [struct.pack(fmt, -0.0), b"\x00" * (width - 1), b""]
        df = spark.createDataFrame([(b,) for b in raw], "b binary")
        out = df.select("b", binary.decode(F.col("b"), kind).alias("d"), binary.encode(binary.decode(F.col("b"), kind), kind).alias("e"))
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
        for r in out.collect():
            b = bytes(r.b)
            if len(b) != width:
                assert r.d is None and r.e is None
            elif (want := struct.unpack(fmt, b)[0]) != want:
                assert r.d != r.d
            else:
                assert struct.pack(fmt, r.d) == b and bytes(r.e) == b


def test_merged_watermark_of_many_producers(spark):
    """The plan does not grow with the producers; slices may be silent for some."""
    rnd = random.Random(2)
    plans = []
    for n in (2, 40):
        rows = [(w, i, rnd.randrange(n), dt(2024, 1, 1) + timedelta(seconds=i // 3 + rnd.randint(0, 50)), i // 37) for w in "ab" for i in range(900)]
        df = spark.createDataFrame(rows, "w STRING, i INT, p INT, mark TIMESTAMP, slice BIGINT")
        merged = eventtime.merged_producer_watermark(df, ["w"], ["i"], "slice", "p", "mark", n)
        want, tops, least = [], {}, {}
        for w, i, p, mark, _ in rows:
            mine = tops.setdefault(w, {})
            mine[p] = max(mark, mine.get(p, mark))
            if len(mine) == n and (w not in least or min(mine.values()) > least[w]):
                least[w] = min(mine.values())
                want.append((w, i, least[w]))
        assert len(want) > 4
        assert sorted((r.w, r.i, r.merged) for r in merged.collect()) == sorted(want)
        plans.append(merged._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert plans[0] == plans[1]


def test_repeated_kafka_headers(spark):
    df = spark.createDataFrame([([("a", b"1"), ("b", b"2"), ("a", b"3")],), ([],), (None,)], "headers ARRAY<STRUCT<key: STRING, value: BINARY>>")
    got = [r.h for r in df.select(kafka.header_map(F.col("headers")).alias("h")).collect()]
    assert [h and {k: bytes(v) for k, v in h.items()} for h in got] == [{"a": b"3", "b": b"2"}, {}, None]


def test_wrong_length_is_null_and_tagged(spark):
    log = spark.createDataFrame([("t", 0, 0, b"k", b"\x00\x01"), ("t", 0, 1, b"k", None), ("t", 0, 2, b"\xff", b"\x00\x00\x00\x07")],
                                "topic_uri STRING, partition INT, offset BIGINT, key BINARY, value BINARY")
    d = project.decode_log(log, "string", "integer")
    rows = [(r.decoded_value, r.tags) for r in d.orderBy("offset").collect()]
    assert rows == [(None, [C.VALUE_DESERIALIZATION_FAILED]), (None, []), (7, [])]
    good, bad = project.quarantine(d)
    assert (good.count(), bad.count()) == (2, 1)
    with pytest.raises(Exception, match="cannot decode t#0@0"):
        project.fail_on_bad_rows(d).collect()


def test_uuid_and_text(spark):
    u = str(uuid.UUID(int=123456789))
    rows = [(u.encode(), u), (u.upper().encode(), u), (b"1-1-1-1-1", "00000001-0001-0001-0001-000000000001"),
            (b"nonsense", None), (u.encode() + b"0", None), (None, None)]
    df = spark.createDataFrame(rows, "b BINARY, want STRING").select("want", binary.decode(F.col("b"), "uuid").alias("got"))
    assert all(r.got == r.want for r in df.collect())
    assert one(spark, binary.decode(F.unhex(F.lit("61FF62")), "string")) == "a�b"


def test_own_payload_type(spark):
    binary.register("flag", lambda c: F.octet_length(c) > 0, lambda c: F.when(c, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit(""))))
    assert one(spark, binary.decode(binary.encode(F.lit(True), "flag"), "flag")) is True


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 2**44 - 1), st.integers(0, 2**19 - 1))
def test_composite_offsets(spark, batch, message):
    packed = offsets.pack_offset(F.lit(batch).cast("bigint"), F.lit(message))
    r = spark.range(1).select(packed.alias("p")).select(
        "p", offsets.batch_offset(F.col("p")).alias("b"), offsets.message_offset(F.col("p")).alias("m")).first()
    assert (r.p, r.b, r.m) == (batch << 19 | message, batch, message)


# --- topic names -------------------------------------------------------------------------------------------
@pytest.mark.parametrize("text,problem,protocol,topic", [
    ("plaintext:/rn:kafka:env:cloud_region1::cluster0:t", None, "plaintext", "t"),
    ("rn:kafka:env:cloud_region1::cluster0:t", None, "plaintext", "t"),
    ("plaintext:/rn:kafka:env:cloud_region1::cluster0:", None, "plaintext", None),
    ("secure:/rn:kafka:prod:aws_us-west-1:pii:cluster01:my_topic", None, "secure", "my_topic"),
    ("plaintext:/rn:kafka:env:cloud_region1::cluster0", "malformed name", None, None),
    ("/rn:kafka:env:cloud_region1::c:t", "malformed uri", None, None),
    ("xx:kafka:env:cloud_region1::c:t", "wrong standard", None, None),
    ("rn:kafka:env:cloudregion::c:t", "malformed name", None, None),
    ("rn:kafka:env:a_b_c::c:t", "malformed name", None, None), (None, "malformed uri", None, None),
])
def test_topic_uri(spark, text, problem, protocol, topic):
    p = one(spark, uri.parse_topic_uri(F.lit(text).cast("string")))
    assert (p.problem, p.protocol, p.topic) == (problem, protocol, topic)


# --- headers -----------------------------------------------------------------------------------------------
def test_lag_units(spark):
    now = int(dt(2024, 1, 1).timestamp() * 1000)
    lag = lambda stamp: one(spark, headers.lag_ms(F.lit(stamp).cast("bigint"), F.lit(now).cast("bigint")))
    assert lag(now - 5) == 5
    assert lag((now - 5) * 1000) == 5
    assert lag((now - 5) * 1000000) == 5
    assert lag((now + 1000) * 1000000) == -1000


def test_headers_set_and_repair(spark):
    stamped = headers.stamp_produce_headers(
        F.create_map(F.lit("a"), F.unhex(F.lit("01")), F.lit(C.KEY_SIZE_HEADER), F.unhex(F.lit("FF"))),
        F.lit(None).cast("binary"), F.unhex(F.lit("0102")), F.lit(7).cast("bigint"))
    got = {k: bytes(v) for k, v in one(spark, stamped).items()}
    assert got == {"a": b"\x01", C.KEY_SIZE_HEADER: b"\xff" * 4, C.VALUE_SIZE_HEADER: b"\x00\x00\x00\x02",
                   C.PRODUCE_TIMESTAMP_HEADER: b"\x00" * 7 + b"\x07"}


# --- skew-safe order ---------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def skewed():
    """A third of all rows in one group, ties in the order column broken by id."""
    r = random.Random(7)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else f"g{r.randrange(200)}"
        rows.append((group, r.randrange(40), i, r.randrange(1000) if r.random() < 0.6 else None))
    return rows


def test_rank_spreads_a_hot_group(spark, skewed):
    df = spark.createDataFrame(skewed, "g STRING, t INT, i INT, v INT")
    got = {(r.g, r.i): r.n for r in ordered.rank(df, ["g"], ["t", "i"], "n").collect()}
    want, seen = {}, {}
    for g, _t, i, _v in sorted(skewed, key=lambda x: (x[0], x[1], x[2])):
        want[(g, i)] = seen.get(g, 0)
        seen[g] = want[(g, i)] + 1
    assert got == want
    chunks = ordered.range_chunks(df, ["g", "t", "i"], 12)
    biggest = chunks.groupBy("_chunk").count().agg(F.max("count")).first()[0]
    assert biggest < len(skewed) / 4  # the hot group alone is a third


def test_folds_over_slices(spark, skewed):
    dense = [(g, n, v) for n, (g, _t, _i, v) in enumerate(skewed)]
    df = spark.createDataFrame(dense, "g STRING, offset BIGINT, v INT").withColumn("_slice", ordered.offset_slice(rows=17))
    last = ordered.last_known(df, ["g"], ["offset"], "_slice", "x", F.col("v"))
    top = ordered.running_max(df, ["g"], ["offset"], "_slice", "x", F.col("v"), include_current=False)
    total = ordered.running_sum(df, ["g"], ["offset"], "_slice", "x", F.col("v"))
    after = ordered.next_row(df, ["g"], ["offset"], "_slice", "x", ["offset"])
    by_group = {}
    for g, n, v in dense:
        by_group.setdefault(g, []).append((n, v))
    want_last, want_top, want_sum, want_next = {}, {}, {}, {}
    for rows in by_group.values():
        known = best = None
        s = 0
        for j, (n, v) in enumerate(rows):
            want_top[n] = best
            known = v if v is not None else known
            best = v if best is None else best if v is None else max(best, v)
            s += v or 0
            want_last[n], want_sum[n] = known, s
            want_next[n] = rows[j + 1][0] if j + 1 < len(rows) else None
    as_dict = lambda d: {r.offset: r.x for r in d.collect()}
    assert as_dict(last) == want_last
    assert as_dict(top) == want_top
    assert as_dict(total) == want_sum
    assert {k: (v.offset if v else None) for k, v in as_dict(after).items()} == want_next


@pytest.mark.parametrize("rows", [None, 20, 1])
def test_only_hot_groups_are_cut(spark, skewed, rows):
    dense = [(g, n, v) for n, (g, _t, _i, v) in enumerate(skewed)]
    df = spark.createDataFrame(dense, "g STRING, offset BIGINT, v INT")
    cut = ordered.slice_hot_groups(df, ["g"], rows=rows)
    assert (cut.carriers is None) == (rows is None)
    got = {r.offset: (r.p.v if r.p else "first") for r in ordered.previous_row(cut, ["g"], ["offset"], "_slice", "p", ["v"]).collect()}
    want, last = {}, {}
    for g, n, v in dense:
        want[n] = last.get(g, "first")
        last[g] = v
    assert got == want


def test_more_hot_groups_than_may_be_broadcast(spark, skewed, monkeypatch):
    monkeypatch.setattr(ordered, "checked_broadcast", lambda d: checked_broadcast(d, max_rows=1))
    test_only_hot_groups_are_cut(spark, skewed, 2)


def test_checked_broadcast_refuses_large_sides(spark):
    assert checked_broadcast(spark.range(10), max_rows=9).rows is None
    small = checked_broadcast(spark.range(10), max_rows=10)
    assert len(small.rows) == 10
    assert "BroadcastHashJoin" in plan(spark.range(100).join(small.df, "id"))


def test_exact_percentiles(spark):
    """Near values, values all over 64 bits, both, and a single one."""
    r = random.Random(3)
    near, far = lambda: r.randrange(-50, 200), lambda: r.randrange(-(1 << 52), 1 << 52)
    rows = [("a", near()) for _ in range(400)] + [("b", far()) for _ in range(90)] + [("c", r.choice([near, far])()) for _ in range(50)] + [("d", -7)]
    got = percentiles.exact_percentiles(spark.createDataFrame(rows, "k STRING, v BIGINT"), ["k"], "v", metrics.HISTOGRAM_POINTS)
    for row in got.collect():
        values = [v for k, v in rows if k == row.k]
        for name, p in metrics.HISTOGRAM_POINTS.items():
            want = np.percentile(values, p * 100)
            assert abs(row[name] - want) <= 1e-9 * max(1, abs(want))


def test_gaps(spark):
    df = spark.createDataFrame([("a", n) for n in [0, 1, 5, 6, 20, 21]], "k STRING, offset BIGINT")
    assert sorted(tuple(x) for x in metrics.gaps(df, ["k"], "offset", slice_rows=4).collect()) == [("a", 1, 3), ("a", 6, 13)]


# --- partitioners ------------------------------------------------------------------------------------------
def test_round_robin_is_refused_for_keyed_tables(spark):
    with pytest.raises(ValueError):
        partitioners.round_robin(spark.range(3), ["id"], 2, ["id"])


def test_missing_partition_is_an_error(spark):
    cat = spark.createDataFrame([("t", 0)], "topic_uri STRING, partition INT")
    with pytest.raises(ValueError, match="no such partition"):
        subscribe.explicit_partitions(cat, spark.createDataFrame([("t", 1)], "topic_uri STRING, partition INT"))


# --- rates, commit modes, kafka ----------------------------------------------------------------------------
def test_rate_limits():
    assert datasource.batch_cap({}) is None
    assert datasource.batch_cap({"rowspersecond": "100", "triggerseconds": "2"}) == 200
    with pytest.raises(ValueError):
        datasource.batch_cap({"rowspersecond": "1", "tasks": "10"})
    assert datasource.share(10, {"a": 100, "b": 1, "c": 0}) == {"a": 9, "b": 1, "c": 0}
    assert datasource.share(100, {"a": 3, "b": 4}) == {"a": 3, "b": 4}
    assert sum(datasource.share(7, dict.fromkeys("abcde", 50)).values()) == 7


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 200), st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 60), max_size=6))
def test_share_uses_the_whole_cap(cap, available):
    taken = datasource.share(cap, available)
    assert sum(taken.values()) == min(cap, sum(available.values()))
    assert all(0 <= taken[n] <= available[n] for n in available)


def test_commit_modes():
    got = [deliver.commit_mode(a, c, k) for k in (True, False) for a in (True, False) for c in (True, False)]
    assert got == ["on-checkpoints", "disabled"] * 2 + ["periodic"] * 2 + ["disabled"] * 2


def test_kafka_options():
    o = kafka.read_options("s:9092", topics=["a", "b"], start={"a": {"0": 5}}, stop="latest", rate=10, trigger_seconds=3, min_partitions=8)
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == '{"a": {"0": 5}}' and o["endingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "30" and o["minPartitions"] == "8"
    assert kafka.read_options("s", pattern="c.*", start_timestamp_ms=5)["startingTimestamp"] == "5"
    assert kafka.read_options("s", partitions={"a": [0]}, isolation="read_committed")["kafka.isolation.level"] == "read_committed"
    with pytest.raises(ValueError):
        kafka.read_options("s", topics=["a"], pattern="b")


def plan(df):
    return df._jdf.queryExecution().toString()
