"""Event-time windows and per-partition watermarks."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import offset_slice, running_max
from tidelog.session import ship_package

PARTITION = ["topic_uri", "partition"]


def event_time(extracted: Column, published: Column) -> Column:
    """The extracted time, else the publish time."""
    return F.coalesce(extracted, published)


def tumble(df: DataFrame, time: str, size: str, aggregates: list[Column], by: list[str] | None = None) -> DataFrame:
    """Tumbling windows with `window_start` and `window_end`."""
    grouped = df.groupBy(*(by or []), F.window(time, size)).agg(*aggregates)
    return grouped.select(
        *(by or []), F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c not in (by or []) and c != "window"])


def row_watermark(log: DataFrame, delay: str = "0 seconds", time: str = "timestamp",
                  slice_rows: int | None = None) -> DataFrame:
    """Add `watermark`: the highest time seen before the row in its partition, less the delay."""
    sliced = log.withColumn("_slice", offset_slice(rows=slice_rows))
    seen = running_max(sliced, PARTITION, ["offset"], "_slice", "_seen", F.col(time), include_current=False)
    return seen.withColumn("watermark", F.col("_seen") - F.expr(f"INTERVAL {delay}")).drop("_seen", "_slice")


def late_rows(log: DataFrame, delay: str = "0 seconds", time: str = "timestamp") -> DataFrame:
    """Rows older than their partition's watermark on arrival."""
    return row_watermark(log, delay, time).where(F.col(time) < F.col("watermark"))


def partition_progress(log: DataFrame, time: str = "timestamp", arrival: str = "timestamp") -> DataFrame:
    return log.groupBy(*PARTITION).agg(F.max(time).alias("max_time"), F.max(arrival).alias("last_arrival"))


def overall_watermark(progress: DataFrame, by: list[str], idle_after: str | None = None,
                      now: Column | None = None) -> DataFrame:
    """Min over partitions of their max time; with `idle_after`, partitions silent for that long are left out."""
    if idle_after is not None:
        progress = progress.where(F.col("last_arrival") >= now - F.expr(f"INTERVAL {idle_after}"))
    return progress.groupBy(*by).agg(
        F.min("max_time").alias("watermark"), F.count(F.lit(1)).alias("n_partitions"))


def _merge_slice(n: int, producer: str, watermark: str, order: list[str], width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def merge(rows: pa.Table, known: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in order])
        tops = dict(zip(known["_producer"].to_pylist(), known["_top"].to_pylist(), strict=True)) if len(known) else {}
        least = min(tops.values()) if len(tops) == n else None
        places, merged = [], []
        marks = rows[watermark].cast(pa.int64()).to_pylist()
        for i, (p, mark) in enumerate(zip(rows[producer].to_pylist(), marks, strict=True)):
            if p is None or mark is None or mark <= (top := tops.get(p, mark - 1)):
                continue
            tops[p] = mark
            # only the producer that was behind all others can raise the merged one
            if len(tops) == n and (least is None or top == least):
                now = min(tops.values())
                if least is None or now > least:
                    least = now
                    places.append(i)
                    merged.append(now)
        out = rows.select(list(range(width))).take(pa.array(places, pa.int64()))
        return out.append_column("merged", pa.array(merged, pa.int64()).cast(rows.schema.field(watermark).type))

    return merge


def merged_producer_watermark(
    marks: DataFrame, keys: list[str], order: list[str], slice_col: str, producer: str, watermark: str, n: int,
) -> DataFrame:
    """Watermarks a reader may emit: min over all `n` producers once each has reported, whenever it rises.

    `n` is the writers' parallelism. What a slice begins with is a row for each producer, its highest watermark in the
    slices before; the plan is the same for any number of producers, and a slice holds one number for each.
    """
    ship_package(marks.sparkSession)
    columns = marks.columns
    place = [*keys, slice_col, "_producer"]
    micros = F.unix_micros(F.max(watermark).cast("timestamp"))
    tops = marks.where(F.col(producer).isNotNull()).groupBy(*keys, slice_col, F.col(producer).alias("_producer")).agg(micros.alias("_own"))
    # a producer may be silent in a slice, so there is a row for each slice and producer of a group
    grid = marks.select(*keys, slice_col).distinct().join(tops.select(*keys, "_producer").distinct(), keys)
    before = Window.partitionBy(*keys, "_producer").orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(tops, place, "left").select(*place, F.max("_own").over(before).alias("_top")).where("_top IS NOT NULL")
    names = [f"_k{i}" for i in range(len(keys) + 1)]  # the two sides come from the same rows
    carried = carried.select(*[F.col(c).alias(x) for c, x in zip([*keys, slice_col], names)], "_producer", "_top")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marks.schema.fields)
    merge = _merge_slice(n, producer, watermark, order, len(columns))
    kind = marks.schema[watermark].dataType.simpleString()
    return marks.groupBy(*keys, slice_col).cogroup(carried.groupBy(*names)).applyInArrow(merge, f"{schema}, merged {kind}")
