"""Buffers by distinct keys, against one row after the other."""

import random
from collections import Counter

import pytest

from tidelog.operators import buffering, changelog
from tidelog.streaming.upsert import BufferedUpsert

DDL = "w STRING, pos BIGINT, k STRING, row_kind STRING, v BIGINT"


def slow(rows, n):
    """(w, pos) -> number of the buffer."""
    out, held, number = {}, {}, {}
    for w, pos, k, *_ in sorted(rows, key=lambda r: (r[0], r[1])):
        out[w, pos] = number.setdefault(w, 0)
        seen = held.setdefault(w, set())
        seen.add(k)
        if len(seen) == n:
            seen.clear()
            number[w] += 1
    return out


def flushes(rows, n):
    numbers, last = slow(rows, n), {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        last[r[0], numbers[r[0], r[1]], r[2]] = r
    return Counter((w, f, k, r[1], r[4]) for (w, f, k), r in last.items())


@pytest.fixture(scope="module")
def rows():
    """One writer with two thirds of the rows, long runs of one key, gaps between positions, rare and frequent keys."""
    rnd = random.Random(4)
    out = []
    for w, size in (("hot", 900), ("b", 300), ("c", 7), ("d", 1)):
        pos = 0
        for i in range(size):
            pos += rnd.choice([1, 1, 1, 5])
            k = "same" if 300 < i < 420 else str(int(rnd.expovariate(0.25)))
            out.append((w, pos, k, rnd.choice(["+I", "+U", "-U", "-D"]), i))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 12, 60, 1000])
@pytest.mark.parametrize("slice_rows", [40, 1_000_000])
def test_buffers(spark, rows, n, slice_rows):
    got = buffering.buffers(spark.createDataFrame(rows, DDL).repartition(3), ["w"], ["k"], "pos", n, slice_rows)
    assert {(r.w, r.pos): r.flush_no for r in got.collect()} == slow(rows, n)


def test_nothing_to_buffer(spark):
    assert buffering.buffers(spark.createDataFrame([], DDL), ["w"], ["k"], "pos", 3).collect() == []
    with pytest.raises(ValueError):
        buffering.buffers(spark.createDataFrame([], DDL), ["w"], ["k"], "pos", 0)


def test_last_changes(spark, rows):
    out = changelog.buffered_upsert(spark.createDataFrame(rows, DDL), ["w"], ["k"], "pos", 6, ["v"], 100)
    assert Counter((r.w, r.flush_no, r.k, r.pos, r.v) for r in out.collect()) == flushes(rows, 6)
    assert {r.row_kind for r in out.select("row_kind").distinct().collect()} == {"+U", "-D"}


def live(spark, root, batches, n, clock, interval=None, replay=()):
    out = {}

    def write(df, i):
        out[i] = [(r.w, r.flush_no, r.k, r.pos, r.v) for r in df.collect()]

    sink = BufferedUpsert(spark, root, ["w"], ["k"], "pos", n, ["v"], DDL, write, interval, clock)
    for i, batch in enumerate(batches):
        for _ in range(2 if i in replay else 1):
            sink.step(spark.createDataFrame(batch, DDL), i)
    sizes = {i: len(x) for i, x in out.items()}
    sink.drain()
    return Counter(x for rows in out.values() for x in rows), sizes


def test_buffers_are_carried_over(spark, rows, tmp_path):
    """Cut anywhere, and with a micro-batch replayed, a stream flushes what one pass over all rows does."""
    line = sorted(rows, key=lambda r: r[1])
    batches = [line[:10], line[10:400], [], line[400:]]
    got, _ = live(spark, str(tmp_path / "s"), batches, 6, lambda: 0.0, replay=(1,))
    assert got == flushes(rows, 6)


def test_buffers_are_emptied_by_the_clock(spark, tmp_path):
    now = iter([0.0, 5.0, 11.0, 12.0])
    batches = [[("w", i, k, "+I", i)] for i, k in enumerate("abab")]
    got, sizes = live(spark, str(tmp_path / "s"), batches, 100, lambda: next(now), interval=10)
    # begun at 0, emptied at 11, drained at the end
    assert sizes == {0: 0, 1: 0, 2: 2, 3: 0}
    assert got == Counter([("w", 0, "a", 2, 2), ("w", 0, "b", 1, 1), ("w", 1, "b", 3, 3)])
