"""Exact percentiles of whole numbers without holding a group's values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import durable_table

STEP_BITS = 16  # a range of values is looked into by 65,536 parts at a time, four times for 64 bits


def _rank_of(p: float, total: Column) -> Column:
    return F.lit(p) * (total - 1)


def _value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("bigint").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    )


def exact_percentiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Linear-interpolated percentiles of the BIGINT column `value`, one row per group.

    Values are counted once, and the counts written down. Then the wanted ranks are followed from the widest ranges
    of values to single ones, only ranges that hold a wanted rank being parted. A window is over at most 2^STEP_BITS
    parts of one range, wherever the values lie.
    """
    return _percentiles(durable_table(_value_counts(df, keys, value), "value-counts"), keys, points)


def _percentiles(counts: DataFrame, keys: list[str], points: dict[str, float]) -> DataFrame:
    ranks = [f(_rank_of(p, F.col("_total"))) for p in points.values() for f in (F.floor, F.ceil)]
    wanted = counts.groupBy(*keys).agg(F.sum("_c").alias("_total")).select(
        *keys, F.lit(0).cast("bigint").alias("_up"), "_total", F.lit(0).cast("bigint").alias("_base"))
    for level in range(64 - STEP_BITS, -1, -STEP_BITS):
        above = F.shiftright("_v", level + STEP_BITS) if level + STEP_BITS < 64 else F.lit(0).cast("bigint")
        parts = counts.groupBy(*keys, above.alias("_up"), F.shiftright("_v", level).alias("_part")).agg(F.sum("_c").alias("_c"))
        to_here = Window.partitionBy(*keys, "_up").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
        placed = parts.join(wanted, [*keys, "_up"]).withColumn("_end", F.col("_base") + F.sum("_c").over(to_here))
        begin = F.col("_end") - F.col("_c")
        placed = placed.where(F.exists(F.array(*ranks), lambda r: (r >= begin) & (r < F.col("_end"))))  # noqa: B023
        wanted = placed.select(*keys, F.col("_part").alias("_up"), "_total", begin.alias("_base"))
    placed = placed.withColumnRenamed("_part", "_v")

    def value_at(rank: Column) -> Column:
        return F.min(F.when((rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_c")), F.col("_v")))

    found = []
    for i, p in enumerate(points.values()):
        at = _rank_of(p, F.col("_total"))
        found += [value_at(F.floor(at)).alias(f"_lo{i}"), value_at(F.ceil(at)).alias(f"_hi{i}")]
    result = placed.groupBy(*keys).agg(F.first("_total").alias("_total"), *found)
    columns = []
    for i, (name, p) in enumerate(points.items()):
        at = _rank_of(p, F.col("_total"))
        low, high = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        columns.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return result.select(*keys, *columns)


def histogram(df: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """count, min, max, mean and percentiles of `value` per group, all from one count per value."""
    counts = durable_table(_value_counts(df, keys, value), "value-counts")
    basics = counts.groupBy(*keys).agg(
        F.sum("_c").alias("n"), F.min("_v").alias("min_value"), F.max("_v").alias("max_value"),
        (F.sum(F.col("_v").cast("double") * F.col("_c")) / F.sum("_c")).alias("mean_value"),
    )
    return basics.join(_percentiles(counts, keys, points), keys, "left")
