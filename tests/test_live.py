"""Live changelog and live as-of join over several micro-batches, with replays, folds and hot keys."""

import random
from collections import Counter
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidelog.constants import LOG_DDL
from tidelog.operators import changelog
from tidelog.streaming.temporal import LiveAsOfJoin, both_sides
from tidelog.streaming.upsert import LiveChangelog

START = dt(2024, 1, 1)


def bag(df):
    return Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect())


def upserts(n, seed=1):
    """Two thirds of the rows are of one key; tombstones, repeats and rows without a key."""
    rnd = random.Random(seed)
    key = lambda: b"hot" if rnd.random() < 0.66 else rnd.choice([None, b"a", b"b", b"c", b"d"])
    return [("t", 0, i, START, key(), rnd.choice([None, b"1", b"2", b"3"]), None) for i in range(n)]


def python_nodes(df):
    return [x for x in ("Python", "Pandas", "Arrow") if x in df._jdf.queryExecution().executedPlan().toString()]


def test_live_changelog(spark, tmp_path):
    rows = upserts(400)
    out, planned = {}, []

    def write(df, i):
        planned.extend(python_nodes(df))
        out[i] = bag(df)

    live = LiveChangelog(spark, str(tmp_path / "s"), write, slice_rows=20, compact_every=2)
    cuts = [0, 50, 51, 51, 200, 330, 400]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(2 if i in (3, 5) else 1):
            live.step(spark.createDataFrame(rows[a:b], LOG_DDL), i)
    want = bag(changelog.to_changelog(spark.createDataFrame(rows, LOG_DDL)))
    assert sum(out.values(), Counter()) == want and not planned


def slow_as_of(left, versions, bound):
    out = []
    for region, k, t, i in left:
        if region is None or k is None or t is None or t >= bound:
            continue
        found = [v for v in versions if v[0] == region and v[1] == k and v[2] is not None and v[2] <= t]
        out.append((region, k, i, max(found, key=lambda v: (v[2], v[3]))[4] if found else None))
    return Counter(out)


@pytest.mark.parametrize("every", [1, 3])
def test_live_as_of(spark, tmp_path, every):
    rnd = random.Random(every)
    at = lambda i: START + timedelta(seconds=i + rnd.uniform(-20, 20))
    key = lambda: ("x", 7) if rnd.random() < 0.5 else (rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]))
    left = [(*key(), at(i), i) for i in range(300)]
    versions = [(*key(), at(i), i, rnd.choice([None, i])) for i in range(0, 300, 2)]
    versions += [(r, k, t, n + 1000, v) for r, k, t, n, v in versions[:5]]  # the same instant again
    lddl, vddl = "region STRING, id INT, at TIMESTAMP, n INT", "region STRING, id INT, valid TIMESTAMP, n INT, price INT"

    def part(low, high):
        mine = lambda rows: [r for r in rows if low <= r[3] % 1000 < high]
        return both_sides(
            spark.createDataFrame(mine(left), lddl), spark.createDataFrame(mine(versions), vddl), ["region", "id"], "at", "valid", ["n"], ["n"], ["price"],
            F.col("price").isNull())

    out = {}
    live = LiveAsOfJoin(spark, str(tmp_path / "s"), ["region", "id"], part(0, 1), "60 SECONDS", lambda df, i: out.__setitem__(i, bag(df)), compact_every=every)
    cuts = [0, 100, 101, 180, 180, 300]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(2 if i in (2, 4) else 1):
            live.step(part(a, b), i)
    high = max([r[2] for r in left if None not in r[:2]] + [r[2] for r in versions if None not in r[:2]])
    bound = high.replace(microsecond=high.microsecond // 1000 * 1000) - timedelta(seconds=60)
    assert sum(out.values(), Counter()) == slow_as_of(left, versions, bound)


def test_late_rows_are_told(spark, tmp_path):
    late = []
    schema = spark.createDataFrame([], "k STRING, at TIMESTAMP")
    none = spark.createDataFrame([], "k STRING, at TIMESTAMP, n INT")
    rows = lambda *seconds: both_sides(
        schema.unionByName(spark.createDataFrame([("a", START + timedelta(seconds=s)) for s in seconds], schema.schema)), none, ["k"], "at", "at", ["n"], ["at"], ["n"], F.lit(False))
    out = []
    live = LiveAsOfJoin(spark, str(tmp_path / "t"), ["k"], rows(0), "1 SECOND", lambda df, i: out.extend(df.collect()), lambda df, i: late.extend(df.collect()))
    live.step(rows(0, 10), 0)
    live.step(rows(2, 9, 20), 1)
    assert [r.l["at"].second for r in late] == [2]
    assert sorted(r["at"].second for r in out) == [0, 9, 10]
