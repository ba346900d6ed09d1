"""Which partition a produced row goes to (K07-K10). Each is a Column, or a DataFrame step where order matters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import global_rank


def by_key(key: Column, n: Column | int) -> Column:
    """Hash of the key; rows without a key are spread."""
    count = F.lit(n) if isinstance(n, int) else n
    spread = F.pmod(F.monotonically_increasing_id(), count)
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key), count)).otherwise(spread).cast("int")


def by_task(n: Column | int) -> Column:
    """Every task writes to one partition: task number modulo the partition count."""
    return F.pmod(F.spark_partition_id(), F.lit(n) if isinstance(n, int) else n).cast("int")


def round_robin(df: DataFrame, order: list[str], n: int, key_fields: list[str] | None = None) -> DataFrame:
    """Rows dealt out in `order`; refused for keyed tables, whose keys must stay together."""
    if key_fields:
        raise ValueError("round-robin partitioning cannot be combined with key fields")
    ranked = global_rank(df, order, "_position")
    return ranked.withColumn("partition", F.pmod(F.col("_position"), F.lit(n)).cast("int")).drop("_position")


def custom(f: Callable[..., Column], row: Column, key: Column, value: Column, topic: Column, n: Column | int) -> Column:
    """A user function (row, key, value, topic, partition count) -> partition."""
    return f(row, key, value, topic, F.lit(n) if isinstance(n, int) else n).cast("int")
