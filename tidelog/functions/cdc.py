"""CDC envelopes to changelog rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.constants import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE


def _change(kind: str, row: Column) -> Column:
    return F.struct(F.lit(kind).alias("row_kind"), row.alias("row"))


def _emit(df: DataFrame, changes: Column, keep: list[str], meta: list[Column], fields: list[str]) -> DataFrame:
    exploded = df.select(*keep, *meta, F.posexplode(changes).alias("change_no", "_c"))
    names = [m for m in exploded.columns if m not in ("_c",)]
    return exploded.select(*names, "_c.row_kind", *[F.col(f"_c.row.{f}").alias(f) for f in fields])


def debezium(df: DataFrame, value: str, fields: str, keep: list[str]) -> DataFrame:
    """before/after/op envelopes. Adds source_ts, source_db, source_table and the row's columns."""
    row = T.StructType.fromDDL(fields)
    envelope = T.StructType([
        T.StructField("before", row), T.StructField("after", row),
        T.StructField("source", T.StructType.fromDDL("ts_ms BIGINT, db STRING, `table` STRING")),
        T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
    ])
    e = df.withColumn("_e", F.from_json(F.col(value).cast("string"), envelope))
    before, after, op = F.col("_e.before"), F.col("_e.after"), F.col("_e.op")
    changes = (
        F.when(op.isin("c", "r"), F.array(_change(INSERT, after)))
        .when(op == "u", F.array(_change(UPDATE_BEFORE, before), _change(UPDATE_AFTER, after)))
        .when(op == "d", F.array(_change(DELETE, before)))
    )
    meta = [
        F.timestamp_millis("_e.source.ts_ms").alias("source_ts"), F.col("_e.source.db").alias("source_db"),
        F.col("_e.source.table").alias("source_table"),
    ]
    return _emit(e, changes, keep, meta, row.names)


_TEXT_ROW = "MAP<STRING, STRING>"


def _text_struct(row: T.StructType) -> str:
    """The row with every field as text, the way envelopes without types carry it."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in row]).simpleString()


def _typed(texts: Column, row: T.StructType, over: Column | None = None) -> Column:
    """A typed struct from a struct of texts; a name present in the map `over` (even as null) wins."""
    columns = []
    for f in row:
        own = texts[f.name]
        if over is not None:
            own = F.when(F.map_contains_key(over, f.name), F.try_element_at(over, F.lit(f.name))).otherwise(own)
        columns.append(own.cast(f.dataType).alias(f.name))
    return F.struct(*columns)


def canal(df: DataFrame, value: str, fields: str, keep: list[str]) -> DataFrame:
    """data[]/old[]/type envelopes: one message holds many rows; an update's old row is the new one with the
    changed fields put back."""
    row = T.StructType.fromDDL(fields)
    envelope = (
        f"data ARRAY<{_text_struct(row)}>, old ARRAY<{_TEXT_ROW}>, type STRING, database STRING, `table` STRING, "
        "es BIGINT, ts BIGINT, isDdl BOOLEAN"
    )
    e = df.withColumn("_e", F.from_json(F.col(value).cast("string"), envelope))
    data, old, kind = F.col("_e.data"), F.col("_e.old"), F.col("_e.type")
    pairs = F.arrays_zip(data.alias("data"), old.alias("old"))
    updates = F.flatten(F.transform(pairs, lambda p: F.array(
        _change(UPDATE_BEFORE, _typed(p["data"], row, F.coalesce(p["old"], F.create_map().cast(_TEXT_ROW)))),
        _change(UPDATE_AFTER, _typed(p["data"], row)))))
    changes = (
        F.when(kind == "INSERT", F.transform(data, lambda d: _change(INSERT, _typed(d, row))))
        .when(kind == "UPDATE", updates)
        .when(kind == "DELETE", F.transform(data, lambda d: _change(DELETE, _typed(d, row))))
    )
    meta = [
        F.timestamp_millis("_e.es").alias("source_ts"), F.col("_e.database").alias("source_db"),
        F.col("_e.table").alias("source_table"),
    ]
    return _emit(e, changes, keep, meta, row.names)


def maxwell(df: DataFrame, value: str, fields: str, keep: list[str]) -> DataFrame:
    """data/old/type envelopes, one row each, time in seconds."""
    row = T.StructType.fromDDL(fields)
    envelope = f"data {_text_struct(row)}, old {_TEXT_ROW}, type STRING, database STRING, `table` STRING, ts BIGINT"
    e = df.withColumn("_e", F.from_json(F.col(value).cast("string"), envelope))
    data, old, kind = F.col("_e.data"), F.col("_e.old"), F.col("_e.type")
    nothing = F.create_map().cast(_TEXT_ROW)
    changes = (
        F.when(kind == "insert", F.array(_change(INSERT, _typed(data, row))))
        .when(kind == "update", F.array(
            _change(UPDATE_BEFORE, _typed(data, row, F.coalesce(old, nothing))),
            _change(UPDATE_AFTER, _typed(data, row))))
        .when(kind == "delete", F.array(_change(DELETE, _typed(data, row))))
    )
    meta = [
        F.timestamp_seconds("_e.ts").alias("source_ts"), F.col("_e.database").alias("source_db"),
        F.col("_e.table").alias("source_table"),
    ]
    return _emit(e, changes, keep, meta, row.names)
