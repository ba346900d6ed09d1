"""Rows to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.changelog import upsert_payload
from tidelog.operators.ordered import global_rank, offset_slice, rank, rank_in_slices

PARTITION = ["topic_uri", "partition"]


def encode_columns(names: list[str], prefix: str = "") -> Column:
    """JSON bytes of the named columns, `prefix` stripped from their names."""
    fields = []
    for n in names:
        if not n.startswith(prefix):
            raise ValueError(f"field {n!r} does not start with the prefix {prefix!r}")
        fields.append(F.col(n).alias(n[len(prefix):]))
    return F.encode(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), "UTF-8")


def encode_table(
    df: DataFrame, key_names: list[str], prefix: str = "", strategy: str = "ALL", upsert: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """Key and value bytes of each row. With `upsert`, -U and -D become tombstones (`row_kind` column needed)."""
    if upsert and not key_names:
        raise ValueError("an upsert sink needs key fields")
    if strategy == "ALL" and prefix:
        raise ValueError("a key prefix cannot be combined with the value strategy ALL")
    keep = keep or []
    physical = [c for c in df.columns if c not in keep and c != "row_kind"]
    value_names = physical if strategy == "ALL" else [c for c in physical if c not in key_names]
    key = encode_columns(key_names, prefix) if key_names else F.lit(None).cast("binary")
    value = encode_columns(value_names)
    if upsert:
        value = upsert_payload(F.col("row_kind"), value)
    return df.select(*keep, key.alias("key"), value.alias("value"))


def drop_unserialised(outbox: DataFrame, message: str = "message") -> DataFrame:
    """A serializer that returns nothing drops the row; a tombstone (message without value) stays."""
    return outbox.where(F.col(message).isNotNull())


def write_timestamp(event_time: Column, engine_time: bool) -> Column:
    """The row's own event time, or the time of writing."""
    return event_time if engine_time else F.current_timestamp()


def route(df: DataFrame, topic: Column) -> DataFrame:
    """Topic per row from an expression."""
    return df.withColumn("topic_uri", topic)


def sink_parallelism(outbox: DataFrame, tasks: int) -> DataFrame:
    """Use `tasks` writers; rows of one partition are split by offset slice when they have offsets."""
    extra = [offset_slice("offset")] if "offset" in outbox.columns else []
    return outbox.repartition(tasks, *PARTITION, *extra)


def interleave(log: DataFrame, sources: list[str], order: list[str]) -> DataFrame:
    """Round robin over the sources, one row each, drained ones skipped.

    Adds `turn` (the row's place in its source) and `position` (its place in the merged read).
    """
    if order == ["offset"]:
        sliced = log.withColumn("_slice", offset_slice())
        turned = rank_in_slices(sliced, sources, order, "_slice", "turn").drop("_slice")
    else:
        turned = rank(log, sources, order, "turn")
    return global_rank(turned, ["turn", *sources], "position")


def in_partition_order(log: DataFrame) -> DataFrame:
    """Rows of a partition's slices contiguous and by offset inside every task."""
    return log.repartition(*PARTITION, offset_slice()).sortWithinPartitions(*PARTITION, "offset")
