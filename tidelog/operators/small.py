"""Sides of a join that may be broadcast, because their size has been looked at."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 100_000
MAX_BYTES = 32 * 1024 * 1024
#: Types whose values may be large; their bytes are summed up where they are before any is fetched.
_PAYLOADS = (T.BinaryType, T.ArrayType, T.MapType, T.StructType)


@dataclass
class Side:
    """`df` is hinted when it fits; `rows` then holds it, so scans can be narrowed by its values."""

    df: DataFrame
    rows: list[dict] | None

    def narrow(self, big: DataFrame, column: str) -> DataFrame:
        """Filter `big` by the side's distinct values of `column`, which prunes folders and row groups."""
        if self.rows is None or not self.rows or column not in self.rows[0]:
            return big
        values = {r[column] for r in self.rows} - {None}
        return big.where(F.col(column).isin(sorted(values)))


def _bytes(df: DataFrame) -> int:
    """Bytes of the payload columns, summed up on the executors; JSON stands for nested values."""
    sizes = [
        F.octet_length(f.name) if isinstance(f.dataType, T.BinaryType) else F.octet_length(F.to_json(F.struct(f.name)))
        for f in df.schema.fields if isinstance(f.dataType, _PAYLOADS)
    ]
    each = sum((F.coalesce(s, F.lit(0)).cast("bigint") for s in sizes), F.lit(0))
    return df.agg(F.sum(each)).first()[0] or 0


def checked_broadcast(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Side:
    """Fetch at most `max_rows` + 1 rows, and none if payloads among them are too large together. Within the limits
    the side is frozen and broadcast; beyond them it stays a plain DataFrame, joined by shuffle, where AQE splits
    skewed partitions."""
    spark = df.sparkSession
    some = df.limit(max_rows + 1)
    if any(isinstance(f.dataType, _PAYLOADS) for f in df.schema.fields) and _bytes(some) > max_bytes:
        return Side(df, None)
    table = some.toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return Side(df, None)
    return Side(F.broadcast(spark.createDataFrame(table, schema=df.schema)), table.to_pylist())
