"""Messages to typed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import constants as C
from tidelog.functions import headers as H
from tidelog.functions.binary import decode, decode_failed

_METADATA: dict[str, Callable[[], Column]] = {
    "topic-uri": lambda: F.col("topic_uri"),
    "partition": lambda: F.col("partition"),
    "headers": lambda: H.user_headers(F.col("headers")),
    C.SYSTEM_HEADERS_KEY: lambda: H.system_headers(F.col("headers")),
    "offset": lambda: F.col("offset"),
    "timestamp": lambda: F.col("timestamp"),
}


def text(payload: str | Column) -> Column:
    return (F.col(payload) if isinstance(payload, str) else payload).cast("string")


def metadata(key: str) -> Column:
    """One of the readable metadata columns."""
    if key not in _METADATA:
        raise ValueError(f"unknown metadata key {key!r}, expected one of {C.METADATA_KEYS}")
    return _METADATA[key]()


def _schema(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)


def _parsed(payload: str, schema: T.StructType, fmt: str) -> Column:
    if fmt == "json":
        return F.from_json(text(payload), schema)
    if fmt == "raw":  # the whole payload is one field
        if len(schema) != 1:
            raise ValueError("the raw format holds exactly one field")
        return F.struct(text(payload).cast(schema[0].dataType).alias(schema[0].name))
    raise ValueError(f"unknown format {fmt!r}")


def key_fields(table: str | T.StructType, names: list[str], prefix: str = "") -> T.StructType:
    """Schema of the key format: the named columns with `prefix` stripped."""
    columns = {f.name: f for f in _schema(table)}
    fields = []
    for name in names:
        if name not in columns:
            raise ValueError(f"key field {name!r} is not a column of the table")
        if not name.startswith(prefix):
            raise ValueError(f"key field {name!r} does not start with the prefix {prefix!r}")
        fields.append(T.StructField(name[len(prefix):], columns[name].dataType))
    return T.StructType(fields)


def value_fields(
    table: str | T.StructType, key_names: list[str], strategy: str = "ALL", prefix: str = "",
) -> T.StructType:
    """Schema of the value format: all columns, or all that are not key fields."""
    if strategy == "ALL":
        if prefix:
            raise ValueError("a key prefix cannot be combined with the value strategy ALL")
        return _schema(table)
    if strategy == "EXCEPT_KEY":
        return T.StructType([f for f in _schema(table) if f.name not in key_names])
    raise ValueError(f"unknown value strategy {strategy!r}")


def read_table(
    log: DataFrame, table: str | T.StructType, key_names: list[str] | None = None, prefix: str = "",
    strategy: str = "ALL", key_format: str = "json", value_format: str = "json",
    metadata_columns: dict[str, str] | None = None, upsert: bool = False, null_values: str = "error",
) -> DataFrame:
    """Declare a table over a log: key columns, value columns, metadata columns.

    A null value is an error unless `upsert`, where it is kept as a row with row_kind -D and null value columns.
    `null_values="skip"` leaves such messages out instead; prefer it to a filter before the call, since Spark may
    evaluate the error check and a filter in either order.
    """
    key_names = key_names or []
    k_schema = key_fields(table, key_names, prefix) if key_names else None
    v_schema = value_fields(table, key_names, strategy, prefix)
    parsed = log.where(F.col("value").isNotNull()) if null_values == "skip" and not upsert else log
    if k_schema is not None:
        parsed = parsed.withColumn("_k", _parsed("key", k_schema, key_format))
    checked = F.col("value") if upsert or null_values == "skip" else F.coalesce(
        "value", F.raise_error(F.lit("null value outside upsert mode")).cast("binary"))
    parsed = parsed.withColumn("_value", checked).withColumn("_v", _parsed("_value", v_schema, value_format))
    columns = []
    in_value = set(v_schema.names)
    for field in _schema(table):
        if field.name in key_names and field.name not in in_value:
            columns.append(F.col("_k")[field.name[len(prefix):]].alias(field.name))
        elif field.name in key_names and upsert:  # a tombstone has its key only
            own = F.col("_k")[field.name[len(prefix):]]
            columns.append(F.coalesce(F.col("_v")[field.name], own).alias(field.name))
        else:
            columns.append(F.col("_v")[field.name].alias(field.name))
    for name, key in (metadata_columns or {}).items():
        columns.append(metadata(key).alias(name))
    if upsert:
        kind = F.when(F.col("value").isNull(), C.DELETE).otherwise(C.UPDATE_AFTER)
        columns.append(kind.alias("row_kind"))
    return parsed.select(*columns)


def project(df: DataFrame, paths: list[str]) -> DataFrame:
    """Columns and nested leaves by dotted name, kept under that name."""
    return df.select(*[F.col(p).alias(p) for p in paths])


def key_value_rows(df: DataFrame, keys: str, values: str) -> DataFrame:
    """Every decoded key row with every decoded value row of the same message."""
    return df.withColumn(keys, F.explode(keys)).withColumn(values, F.explode(values))


def value_only(log: DataFrame, kind: str = "string") -> DataFrame:
    return log.select(decode(F.col("value"), kind).alias("value"))


def json_object(log: DataFrame, include_metadata: bool = False) -> Column:
    """{key, value, metadata} as JSON text; parts that are absent are left out. Payloads must be JSON text."""
    def member(name: str, body: Column) -> Column:
        return F.when(body.isNotNull(), F.concat(F.lit(f'"{name}":'), body))

    meta = F.to_json(F.struct("offset", F.col("topic_uri").alias("topic"), "partition"))
    parts = [member("key", text("key")), member("value", text("value"))]
    if include_metadata:
        parts.append(member("metadata", meta))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def typed_tuple(log: DataFrame, key_kind: str, value_kind: str) -> DataFrame:
    return log.select(
        "topic_uri", "partition", "offset",
        decode(F.col("key"), key_kind).alias("key"), decode(F.col("value"), value_kind).alias("value"))


def decode_log(log: DataFrame, key_kind: str, value_kind: str) -> DataFrame:
    """Key and value decoded; a payload that fails becomes null and tags the row. No row is dropped."""
    key, value = decode(F.col("key"), key_kind), decode(F.col("value"), value_kind)
    decoded = log.withColumn("decoded_key", key).withColumn("decoded_value", value)
    tags = F.array_compact(F.array(
        F.when(decode_failed(F.col("key"), F.col("decoded_key")), C.KEY_DESERIALIZATION_FAILED),
        F.when(decode_failed(F.col("value"), F.col("decoded_value")), C.VALUE_DESERIALIZATION_FAILED),
    ))
    return decoded.withColumn("tags", tags)


def quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows that failed to decode)."""
    failed = F.arrays_overlap(
        "tags", F.array(F.lit(C.KEY_DESERIALIZATION_FAILED), F.lit(C.VALUE_DESERIALIZATION_FAILED)))
    return decoded.where(~failed), decoded.where(failed)


def fail_on_bad_rows(decoded: DataFrame) -> DataFrame:
    """The strict policy: the first row that failed to decode ends the job."""
    message = F.concat(F.lit("cannot decode "), F.col("topic_uri"), F.lit("#"), F.col("partition").cast("string"),
                       F.lit("@"), F.col("offset").cast("string"))
    bad = F.when(F.size("tags") > 0, F.raise_error(message).cast("array<string>")).otherwise(F.col("tags"))
    return decoded.withColumn("tags", bad)


def intercept(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run interceptors in order: those on raw bytes come before decoding, typed ones after."""
    for step in steps:
        df = df.transform(step)
    return df
