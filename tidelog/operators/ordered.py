"""Order-dependent work (rank, previous value, running folds) that survives hot groups.

A plain window puts a whole group into one task. Here a group is cut into slices, a window runs inside each
slice, one summary row per (group, slice) is folded over the earlier slices, and what is carried into a slice is
added back.

Ways to cut:
* `offset_slice`: a log's offsets are dense per partition, so `offset div SLICE_ROWS` bounds a slice to
  SLICE_ROWS rows with no extra pass. Meant for groups that are large anyway, such as whole partitions;
* `slice_hot_groups`: the same, but only for groups counted to be large, so the many small ones cost one shuffle;
* `range_chunks`: any other order is range-partitioned by Spark and written down, so that both readers of the cut
  (summary and rows) see the same one, also after an executor is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidelog.operators.small import checked_broadcast
from tidelog.session import durable_table

SLICE_ROWS = 1_000_000
_CHUNK_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def offset_slice(offset: str | Column = "offset", rows: int | None = None) -> Column:
    column = F.col(offset) if isinstance(offset, str) else offset
    return F.call_function("div", column, F.lit(rows or SLICE_ROWS).cast("bigint"))


def _before(keys: list[str], slice_col: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)


@dataclass
class Sliced:
    """Rows with a `_slice`; `carriers` are the rows of groups that have more than one slice (None: no such group)."""

    rows: DataFrame
    carriers: DataFrame | None


def slice_hot_groups(df: DataFrame, keys: list[str], offset: str = "offset", rows: int | None = None) -> Sliced:
    """Cut only the groups that hold more than `rows` rows; the others keep one slice.

    Groups are counted on their key columns alone. There are at most total / `rows` hot ones; should even these be
    too many to broadcast, every group is cut.
    """
    rows = rows or SLICE_ROWS
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(*keys)
    side = checked_broadcast(hot)
    if side.rows is None:
        cut = df.withColumn("_slice", offset_slice(offset, rows))
        return Sliced(cut, cut)
    if not side.rows:
        return Sliced(df.withColumn("_slice", F.lit(0).cast("bigint")), None)
    carriers = df.join(side.df, keys).withColumn("_slice", offset_slice(offset, rows))
    marked = df.join(side.df.withColumn("_hot", F.lit(True)), keys, "left")
    cut = F.when(F.col("_hot"), offset_slice(offset, rows)).otherwise(F.lit(-1).cast("bigint"))
    return Sliced(marked.withColumn("_slice", cut).drop("_hot"), carriers)


def fold_over_slices(
    df: DataFrame | Sliced,
    keys: list[str],
    order: list[str],
    slice_col: str,
    name: str,
    local: Callable[[WindowSpec], Column],
    summary: Column,
    fold: Callable[[Column, WindowSpec], Column],
    combine: Callable[[Column, Column], Column],
) -> DataFrame:
    """Add `name`: `local` over the slice, combined with `fold` of the `summary` of all earlier slices.

    `fold` gets the summary column and the window of earlier slices of the group (one row per slice, so it is
    far smaller than the data). Only slices into which something is carried take part in the join back.
    """
    cut = df if isinstance(df, Sliced) else Sliced(df, df)
    inside = Window.partitionBy(*keys, slice_col).orderBy(*order)
    rows = cut.rows.withColumn("_local", local(inside))
    if cut.carriers is None:
        nothing = F.lit(None).cast(rows.schema["_local"].dataType)
        return rows.withColumn(name, combine(F.col("_local"), nothing)).drop("_local")
    carried = (
        cut.carriers.groupBy(*keys, slice_col).agg(summary.alias("_sum"))
        .withColumn("_carried", fold(F.col("_sum"), _before(keys, slice_col)))
        .drop("_sum").where(F.col("_carried").isNotNull())
    )
    return (
        rows.join(checked_broadcast(carried).df, [*keys, slice_col], "left")
        .withColumn(name, combine(F.col("_local"), F.col("_carried")))
        .drop("_local", "_carried")
    )


def rank_in_slices(df: DataFrame, keys: list[str], order: list[str], slice_col: str, name: str) -> DataFrame:
    """Zero-based position inside the group."""
    return fold_over_slices(
        df, keys, order, slice_col, name,
        local=lambda w: F.row_number().over(w) - 1,
        summary=F.count(F.lit(1)),
        fold=lambda s, w: F.sum(s).over(w),
        combine=lambda here, before: (here + F.coalesce(before, F.lit(0))).cast("bigint"),
    )


def previous_row(
    df: DataFrame | Sliced, keys: list[str], order: list[str], slice_col: str, name: str, columns: list[str],
) -> DataFrame:
    """Struct of `columns` of the group's previous row, null on its first."""
    row = F.struct(*columns)
    return fold_over_slices(
        df, keys, order, slice_col, name,
        local=lambda w: F.lag(row).over(w),
        summary=F.max_by(row, F.struct(*order)),
        fold=lambda s, w: F.last(s).over(w),
        combine=lambda here, before: F.coalesce(here, before),
    )


def next_row(
    df: DataFrame | Sliced, keys: list[str], order: list[str], slice_col: str, name: str, columns: list[str],
) -> DataFrame:
    """Struct of `columns` of the group's next row, null on its last."""
    row = F.struct(*columns)

    def after(s: Column, _w: WindowSpec) -> Column:
        return F.lead(s).over(Window.partitionBy(*keys).orderBy(slice_col))

    return fold_over_slices(
        df, keys, order, slice_col, name,
        local=lambda w: F.lead(row).over(w),
        summary=F.min_by(row, F.struct(*order)),
        fold=after,
        combine=lambda here, later: F.coalesce(here, later),
    )


def running_max(
    df: DataFrame, keys: list[str], order: list[str], slice_col: str, name: str, value: Column,
    include_current: bool = True,
) -> DataFrame:
    last = Window.currentRow if include_current else -1
    return fold_over_slices(
        df, keys, order, slice_col, name,
        local=lambda w: F.max(value).over(w.rowsBetween(Window.unboundedPreceding, last)),
        summary=F.max(value),
        fold=lambda s, w: F.max(s).over(w),
        combine=lambda here, before: F.greatest(here, before),
    )


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], slice_col: str, name: str, value: Column,
) -> DataFrame:
    return fold_over_slices(
        df, keys, order, slice_col, name,
        local=lambda w: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        summary=F.sum(value),
        fold=lambda s, w: F.sum(s).over(w),
        combine=lambda here, before: F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0)),
    )


def last_known(
    df: DataFrame, keys: list[str], order: list[str], slice_col: str, name: str, value: Column,
) -> DataFrame:
    """The latest non-null `value` of the group up to and including the row."""
    return fold_over_slices(
        df, keys, order, slice_col, name,
        local=lambda w: F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        summary=F.max_by(value, F.when(value.isNotNull(), F.struct(*order))),
        fold=lambda s, w: F.last(s, True).over(w),
        combine=lambda here, before: F.coalesce(here, before),
    )


def range_chunks(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Cut `df` along `order` into even chunks; adds `_chunk` and `_index` (position inside the chunk).

    Only `order` decides the cut, so one hot group or one hot instant is spread as well. The result is written
    down: range bounds come from a sample and must not be drawn twice.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    numbered = placed.withColumn("_id", F.monotonically_increasing_id())
    low = F.lit((1 << _CHUNK_BITS) - 1).cast("bigint")
    return durable_table(
        numbered.withColumn("_chunk", F.shiftright("_id", _CHUNK_BITS))
        .withColumn("_index", F.col("_id").bitwiseAND(low))
        .drop("_id"),
        "chunks",
    )


def rank(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Zero-based position of a row in its group, for any order.

    One range shuffle of the data. A group's share of a chunk is a count and a first index; with those the position
    is arithmetic, so no window runs over rows. `order` must be total within a group.
    """
    chunks = range_chunks(df, [*keys, *order])
    shares = chunks.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"), F.min("_index").alias("_from"))
    base = shares.select(
        *keys, "_chunk",
        (F.coalesce(F.sum("_n").over(_before(keys, "_chunk")), F.lit(0)) - F.col("_from")).alias("_base"),
    )
    return (
        chunks.join(checked_broadcast(base).df, [*keys, "_chunk"])
        .withColumn(name, (F.col("_base") + F.col("_index")).cast("bigint"))
        .drop("_chunk", "_index", "_base")
    )


def global_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Zero-based position of every row in the whole input."""
    return rank(df.withColumn("_all", F.lit(0)), ["_all"], order, name).drop("_all")
