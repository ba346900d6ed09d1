"""Upsert topics and changelogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.constants import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE
from tidelog.operators.buffering import buffers
from tidelog.operators.ordered import last_known, previous_row, range_chunks, rank, slice_hot_groups

TOPIC_KEY = ["topic_uri", "key"]


def latest_by_key(
    log: DataFrame, keys: list[str] | None = None, order: list[str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Current table of an upsert topic: the last row per key, gone when that row is a tombstone.

    Offsets order rows when a key stays in one partition; give `order` otherwise (e.g. timestamp, partition,
    offset). `max_by` combines before the shuffle, so a hot key costs one row per task.
    """
    keys = keys or TOPIC_KEY
    columns = columns or ["partition", "offset", "timestamp", "value"]
    row = F.struct(*columns)
    by = F.struct(*(order or ["offset"]))
    latest = log.where(F.col("key").isNotNull()).groupBy(*keys).agg(F.max_by(row, by).alias("_row"))
    return latest.select(*keys, "_row.*").where(F.col("value").isNotNull())


CHANGE_KEY = ["topic_uri", "partition", "key"]


def to_changelog(
    log: DataFrame, skip_unchanged: bool = True, slice_rows: int | None = None, known: DataFrame | None = None,
) -> DataFrame:
    """An upsert topic as +I, -U/+U, -D rows. A tombstone for an unknown key gives nothing, and neither does an
    update that changes nothing (switch off with `skip_unchanged=False`). `known` are earlier rows, one of a key, that
    the changes are against; they give none themselves."""
    keys = CHANGE_KEY
    rows = log.where(F.col("key").isNotNull()).withColumn("_old", F.lit(False))
    if known is not None:
        rows = rows.unionByName(known.withColumn("_old", F.lit(True)))
    keyed = slice_hot_groups(rows, keys, rows=slice_rows)
    seen = previous_row(keyed, keys, ["offset"], "_slice", "_prev", ["value"]).where("NOT _old")
    before, after = F.col("_prev.value"), F.col("value")

    def change(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("row_kind"), value.alias("value"))

    changes = (
        F.when(before.isNull() & after.isNotNull(), F.array(change(INSERT, after)))
        .when(before.isNotNull() & after.isNull(), F.array(change(DELETE, before)))
        .when(
            before.isNotNull() & after.isNotNull() & (F.lit(not skip_unchanged) | (before != after)),
            F.array(change(UPDATE_BEFORE, before), change(UPDATE_AFTER, after)))
    )
    return seen.select(
        "topic_uri", "partition", "offset", "timestamp", "key",
        F.posexplode(changes).alias("change_no", "_c"),
    ).select("topic_uri", "partition", "offset", "timestamp", "key", "change_no", "_c.row_kind", "_c.value")


def sign(row_kind: str = "row_kind") -> Column:
    return F.when(F.col(row_kind).isin(INSERT, UPDATE_AFTER), 1).otherwise(-1)


def retract_sums(
    changes: DataFrame, group: list[str], row_id: list[str], sums: dict[str, Column], order: list[str],
    first: dict[str, str] | None = None,
) -> DataFrame:
    """SUM and FIRST_VALUE over a changelog, retractions undone.

    Additions and retractions cancel per (group, row_id) first, so a large group is reduced before it meets in
    one place. `first` maps result names to columns (part of `row_id`) taken from the earliest surviving row.
    Groups without surviving rows are dropped.
    """
    added = F.when(sign() > 0, F.struct(*order))
    per_row = changes.groupBy(*group, *[c for c in row_id if c not in group]).agg(
        F.sum(sign()).alias("_net"), F.max(added).alias("_at"),
        *[F.sum(sign() * c).alias(f"_s_{n}") for n, c in sums.items()],
    )
    picks = [F.min_by(F.col(c), F.when(F.col("_net") > 0, F.col("_at"))).alias(n) for n, c in (first or {}).items()]
    return (
        per_row.groupBy(*group).agg(
            F.sum("_net").alias("n_rows"), *[F.sum(f"_s_{n}").alias(n) for n in sums], *picks)
        .where("n_rows > 0")
    )


def count_changelog(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The changelog a running COUNT(*) per key writes: +I 1, then -U n-1 / +U n."""
    counted = rank(rows, [key], order, "_n").withColumn("_n", F.col("_n") + 1)
    n = F.col("_n")

    def change(kind: str, count: Column) -> Column:
        return F.struct(F.lit(kind).alias("row_kind"), count.alias("n"))

    changes = F.when(n == 1, F.array(change(INSERT, n))).otherwise(
        F.array(change(UPDATE_BEFORE, n - 1), change(UPDATE_AFTER, n)))
    return counted.select(key, *order, F.explode(changes).alias("_c")).select(key, *order, "_c.*")


def as_of_join(
    left: DataFrame, versions: DataFrame, key: list[str], left_time: str, version_time: str,
    version_order: list[str], version_columns: list[str], deleted: Column,
) -> DataFrame:
    """Each left row with the version of its key valid at its time; null columns when there is none or it is deleted.

    Both sides are laid along (key, time) and the last version is carried forward, so no pairs are formed and a
    hot key is spread over many chunks.
    """
    value = F.struct(F.when(~deleted, F.struct(*version_columns)).alias("v"))
    row = F.struct(*left.columns)
    is_version, is_left = F.lit(0), F.lit(1)  # a version at the very instant of a left row counts
    no_order = [F.lit(None).cast(versions.schema[c].dataType).alias(f"_o{i}") for i, c in enumerate(version_order)]
    events = versions.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col(version_time).alias("_t"),
        is_version.alias("_side"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(version_order)],
        value.alias("_version"),
        F.lit(None).cast(_struct_type(left)).alias("_left"),
    )
    has_key = F.lit(True)
    for k in key:
        has_key = has_key & F.col(k).isNotNull()
    probes = left.where(has_key & F.col(left_time).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col(left_time).alias("_t"),
        is_left.alias("_side"), *no_order,
        F.lit(None).cast(events.schema["_version"].dataType).alias("_version"), row.alias("_left"),
    )
    keys = [f"_k{i}" for i in range(len(key))]
    order = ["_t", "_side", *[f"_o{i}" for i in range(len(version_order))]]
    known = events
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    laid = range_chunks(known.unionByName(probes), [*keys, *order])
    filled = last_known(laid, keys, order, "_chunk", "_match", F.col("_version"))
    matched = filled.where(F.col("_side") == 1).select("_left.*", *[
        F.col(f"_match.v.{c}").alias(c) for c in version_columns])
    unkeyed = left.where(~(has_key & F.col(left_time).isNotNull())).select("*", *[
        F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in version_columns])
    return matched.unionByName(unkeyed)


def _struct_type(df: DataFrame):
    return df.schema


def upsert_payload(row_kind: Column, encoded: Column) -> Column:
    """What an upsert sink writes: the row, or a tombstone for -U and -D."""
    return F.when(row_kind.isin(DELETE, UPDATE_BEFORE), None).otherwise(encoded)


def flush_kind(row_kind: Column) -> Column:
    return F.when(row_kind.isin(INSERT, UPDATE_AFTER), UPDATE_AFTER).otherwise(DELETE)


def last_changes(buffered: DataFrame, writer: list[str], key: list[str], position: str, columns: list[str]) -> DataFrame:
    """Of every buffer (`flush_no`) the last change of each key, as an update or a delete."""
    last = buffered.groupBy(*writer, "flush_no", *key).agg(
        F.max_by(F.struct(position, "row_kind", *columns), F.col(position)).alias("_row"))
    out = last.select(*writer, "flush_no", *key, "_row.*")
    return out.withColumn("row_kind", flush_kind(F.col("row_kind")))


def buffered_upsert(
    changes: DataFrame, writer: list[str], key: list[str], position: str, max_keys: int, columns: list[str],
    slice_rows: int | None = None,
) -> DataFrame:
    """What an upsert sink writes that keeps the last change per key in a buffer and empties it when it holds
    `max_keys` keys, and at the end. `position` orders a writer's rows. See `buffering`."""
    return last_changes(buffers(changes, writer, key, position, max_keys, slice_rows), writer, key, position, columns)


def validate_buffer_options(max_rows: int, interval_ms: int) -> bool:
    """Buffering is on only when both options are set, off when neither is; one alone is an error."""
    if (max_rows > 0) != (interval_ms > 0):
        raise ValueError("set both the maximum row count and the flush interval, or neither")
    return max_rows > 0
