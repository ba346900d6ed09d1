"""Buffers that are emptied when they hold a number of distinct keys.

A writer puts its rows into a buffer by key; the row that brings the Nth distinct key closes it, and the next row begins
another one. Where a buffer closes depends on where it began, all the way back to the writer's first row, yet a hot
writer must not be one task. So hot writers are cut into slices by position, and three facts make the cut cheap:

* where a buffer that is open at the end of a slice closes depends only on the first N distinct keys behind it;
* with those, one backward walk over a slice tells for every row, as a beginning, where the chain of buffers leaves;
* a buffer that reaches into a slice can close there at the first rows of its first N distinct keys only, so a slice has
  N + 1 ways to be entered, however many rows it holds.

Summaries of N keys a slice are folded from the last slice of a writer to the first, the ways through the slices are
followed from the first to the last, and then every slice is walked by itself, from the way it is really entered.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import SLICE_ROWS, slice_hot_groups
from tidelog.session import ship_package

NEVER = (1 << 63) - 1
BEFORE = -NEVER


def _some_distinct(entries: list[tuple[int, str]], n: int) -> list[tuple[int, str]]:
    """The first `n` entries (position, key) of different keys."""
    out, seen = [], set()
    for pos, key in entries:
        if key not in seen:
            seen.add(key)
            out.append((pos, key))
            if len(out) == n:
                break
    return out


def ways_through(rows: list[tuple[int, str]], ahead: list[tuple[int, str]], closes: list[int], n: int) -> tuple[list[int], list[int]]:
    """For each way to enter a slice, by where the buffer before closes: where the last buffer that begins in the slice
    closes, and how many begin in it. The first way is a buffer that closed before the slice."""
    line = rows + ahead
    size = len(rows)
    # the row that closes a buffer begun at each row, by two marks that only go forward
    closing, held, distinct, j = [len(line)] * size, {}, 0, 0
    for i in range(size):
        while distinct < n and j < len(line):
            key = line[j][1]
            held[key] = held.get(key, 0) + 1
            distinct += held[key] == 1
            j += 1
        if distinct < n:
            break
        closing[i] = j - 1
        key = line[i][1]
        held[key] -= 1
        distinct -= held[key] == 0
    leaves, begun = [NEVER] * size, [1] * size
    for i in range(size - 1, -1, -1):
        c = closing[i]
        if c < size - 1:
            leaves[i], begun[i] = leaves[c + 1], begun[c + 1] + 1
        elif c < len(line):
            leaves[i] = line[c][0]
    places = [p for p, _ in rows]
    out_leaves, out_begun = [], []
    for close in [BEFORE, *closes]:
        i = bisect_right(places, close)
        out_leaves.append(leaves[i] if i < size else close)
        out_begun.append(begun[i] if i < size else 0)
    return out_leaves, out_begun


def numbers_of(rows: list[tuple[int, str]], entered: int, begun: int, n: int) -> list[int]:
    """The buffer of each row of a slice; rows up to `entered` are in one that began before it."""
    out, seen, number = [], set(), begun
    for pos, key in rows:
        if pos <= entered:
            out.append(begun - 1)
            continue
        out.append(number)
        seen.add(key)
        if len(seen) == n:
            seen, number = set(), number + 1
    return out


def _pairs(table: pa.Table) -> list[tuple[int, str]]:
    return list(zip(table["_pos"].to_pylist(), table["_key"].to_pylist(), strict=True))


def _entries(column) -> list[list[tuple[int, str]]]:
    return [[(e["pos"], e["key"]) for e in x] for x in column.to_pylist()]


def _numbered(width: int, n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def one(rows: pa.Table, way: pa.Table) -> pa.Table:
        rows = rows.sort_by("_pos")
        entered, begun = (way["entered"][0].as_py(), way["begun"][0].as_py()) if len(way) else (BEFORE, 0)
        numbers = numbers_of(_pairs(rows), entered, begun, n)
        return rows.select(list(range(width))).append_column("flush_no", pa.array(numbers, pa.int64()))

    return one


def _key_text(key: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*key)), 256)


def _ways(carriers: DataFrame, writer: list[str], n: int) -> DataFrame:
    """`writer, _slice, entered, begun` for the slices of hot writers."""
    names = ", ".join(f"`{c}` {carriers.schema[c].dataType.simpleString()}" for c in writer)
    firsts = carriers.groupBy(*writer, "_slice", "_key").agg(F.min("_pos").alias("_pos"))
    place = F.row_number().over(Window.partitionBy(*writer, "_slice").orderBy("_pos"))
    some = firsts.withColumn("_n", place).where(F.col("_n") <= n)
    heads = some.groupBy(*writer, "_slice").agg(F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("pos"), F.col("_key").alias("key")))).alias("head"))
    entry = "array<struct<pos:bigint,key:string>>"

    def look_ahead(table: pa.Table) -> pa.Table:
        table = table.sort_by("_slice")
        ahead, all_ahead, all_closes = [], [], []
        for head in reversed(_entries(table["head"])):
            all_ahead.append([{"pos": p, "key": k} for p, k in ahead])
            ahead = _some_distinct(head + ahead, n)
            all_closes.append([p for p, _ in ahead])
        kind = pa.list_(pa.struct([("pos", pa.int64()), ("key", pa.string())]))
        return table.drop_columns(["head"]).append_column("ahead", pa.array(all_ahead[::-1], kind)).append_column("closes", pa.array(all_closes[::-1], pa.list_(pa.int64())))

    seen = heads.groupBy(*writer).applyInArrow(look_ahead, f"{names}, _slice bigint, ahead {entry}, closes array<bigint>")

    def through(rows: pa.Table, known: pa.Table) -> pa.Table:
        leaves, begun = ways_through(_pairs(rows.sort_by("_pos")), _entries(known["ahead"])[0], known["closes"][0].as_py(), n)
        lists = pa.list_(pa.int64())
        return known.drop_columns(["ahead"]).append_column("leaves", pa.array([leaves], lists)).append_column("begun", pa.array([begun], lists)).append_column(
            "first", pa.array([min(rows["_pos"].to_pylist())], pa.int64()))

    slices = carriers.select(*writer, "_slice", "_pos", "_key").groupBy(*writer, "_slice").cogroup(seen.groupBy(*writer, "_slice"))
    ways = slices.applyInArrow(through, f"{names}, _slice bigint, closes array<bigint>, leaves array<bigint>, begun array<bigint>, first bigint")

    def follow(table: pa.Table) -> pa.Table:
        table = table.sort_by("_slice")
        at, total, entered, before = BEFORE, 0, [], []
        for closes, leaves, begun, first in zip(*(table[c].to_pylist() for c in ("closes", "leaves", "begun", "first")), strict=True):
            entered.append(at)
            before.append(total)
            if at == NEVER:
                continue
            way = 0 if at < first else bisect_left(closes, at) + 1
            at, total = leaves[way], total + begun[way]
        return table.drop_columns(["closes", "leaves", "begun", "first"]).append_column("entered", pa.array(entered, pa.int64())).append_column("begun", pa.array(before, pa.int64()))

    return ways.groupBy(*writer).applyInArrow(follow, f"{names}, _slice bigint, entered bigint, begun bigint")


def buffers(changes: DataFrame, writer: list[str], key: list[str], position: str, max_keys: int, slice_rows: int | None = None) -> DataFrame:
    """`changes` with `flush_no`, the number of the writer's buffer that a row is in, from 0.

    `position` orders the rows of a writer and may have gaps. The last buffer of a writer may hold fewer keys.
    """
    if max_keys <= 0:
        raise ValueError("buffering needs a positive number of keys")
    ship_package(changes.sparkSession)
    columns = changes.columns
    marked = changes.withColumn("_pos", F.col(position).cast("bigint")).withColumn("_key", _key_text(key))
    cut = slice_hot_groups(marked, writer, "_pos", slice_rows or SLICE_ROWS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changes.schema.fields)
    names = ", ".join(f"`{c}` {changes.schema[c].dataType.simpleString()}" for c in writer)
    nothing = changes.sparkSession.createDataFrame([], f"{names}, _slice bigint, entered bigint, begun bigint")
    ways = nothing if cut.carriers is None else _ways(cut.carriers, writer, max_keys)
    rows = cut.rows.select(*columns, "_pos", "_key", F.col("_slice").cast("bigint").alias("_slice")).groupBy(*writer, "_slice")
    return rows.cogroup(ways.groupBy(*writer, "_slice")).applyInArrow(_numbered(len(columns), max_keys), f"{schema}, flush_no bigint")
