"""Message headers and the tags derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog import constants as C
from tidelog.functions.binary import decode_integer, encode_integer


def header(headers: Column, name: str) -> Column:
    return F.try_element_at(headers, F.lit(name))


def system_headers(headers: Column) -> Column:
    return F.map_filter(headers, lambda k, _: k.startswith(C.SYSTEM_HEADER_PREFIX))


def user_headers(headers: Column) -> Column:
    return F.map_filter(headers, lambda k, _: ~k.startswith(C.SYSTEM_HEADER_PREFIX))


def set_headers(headers: Column, entries: dict[str, Column]) -> Column:
    """Headers with `entries` set; an entry already there is replaced."""
    names = list(entries)
    kept = F.map_filter(headers, lambda k, _: ~k.isin(names))
    added = F.create_map(*[c for n, v in entries.items() for c in (F.lit(n), v)])
    return F.when(headers.isNull(), added).otherwise(F.map_concat(kept, added))


def writable_headers(headers: Column) -> Column:
    """What may be written: entries without a value are dropped."""
    return F.map_filter(headers, lambda k, v: k.isNotNull() & v.isNotNull())


def writable_timestamp(timestamp_ms: Column) -> Column:
    """A negative time means `not given`."""
    return F.when(timestamp_ms >= 0, timestamp_ms)


def payload_size(payload: Column) -> Column:
    """Length in bytes, -1 for null."""
    return F.coalesce(F.octet_length(payload), F.lit(-1))


def stamp_produce_headers(headers: Column, key: Column, value: Column, now_ms: Column) -> Column:
    return set_headers(headers, {
        C.PRODUCE_TIMESTAMP_HEADER: encode_integer(now_ms, 8),
        C.KEY_SIZE_HEADER: encode_integer(payload_size(key), 4),
        C.VALUE_SIZE_HEADER: encode_integer(payload_size(value), 4),
    })


def produce_timestamp(headers: Column) -> Column:
    """The produce time as written (its unit is up to the writer); null when absent or not 8 bytes."""
    return decode_integer(header(headers, C.PRODUCE_TIMESTAMP_HEADER), 8)


def produce_timestamp_tag(headers: Column) -> Column:
    stamp = header(headers, C.PRODUCE_TIMESTAMP_HEADER)
    return (
        F.when(stamp.isNull(), C.HEADER_TIMESTAMP_NOT_FOUND)
        .when(F.octet_length(stamp) != 8, C.HEADER_TIMESTAMP_CORRUPTED)
    )


def lag_ms(stamp: Column, as_of_ms: Column) -> Column:
    """Milliseconds between a stamp and `as_of`; a stamp ahead of it is read as micro-, then nanoseconds."""
    def toward_zero(number: Column, unit: int) -> Column:
        whole = F.floor(F.abs(number) / F.lit(unit)).cast("bigint")
        return F.when(number < 0, -whole).otherwise(whole)

    micros = as_of_ms * F.lit(1000).cast("bigint") - stamp
    nanos = as_of_ms * F.lit(1000000).cast("bigint") - stamp
    return (
        F.when(as_of_ms - stamp >= 0, as_of_ms - stamp)
        .when(micros >= 0, toward_zero(micros, 1000))
        .otherwise(toward_zero(nanos, 1000000))
    )


def message_lag_ms(headers: Column, timestamp_ms: Column, as_of_ms: Column) -> Column:
    """Lag from the produce header, else from the publish time; none for a corrupt header."""
    return (
        F.when(header(headers, C.PRODUCE_TIMESTAMP_HEADER).isNull(), lag_ms(timestamp_ms, as_of_ms))
        .otherwise(lag_ms(produce_timestamp(headers), as_of_ms))
    )


def _size_mismatch(headers: Column, name: str, payload: Column) -> Column:
    stated = header(headers, name)
    # the first four bytes hold the number
    return stated.isNotNull() & (decode_integer(F.substring(stated, 1, 4), 4) != payload_size(payload))


def size_tags(headers: Column, key: Column, value: Column) -> Column:
    """Tags of size headers that disagree with the payload, as an array."""
    return F.array_compact(F.array(
        F.when(_size_mismatch(headers, C.KEY_SIZE_HEADER, key), C.KEY_SIZE_MISMATCH),
        F.when(_size_mismatch(headers, C.VALUE_SIZE_HEADER, value), C.VALUE_SIZE_MISMATCH),
    ))


def repaired_size_headers(headers: Column, key: Column, value: Column) -> Column:
    """Wrong size headers corrected; a message without any headers gets both."""
    key_size = encode_integer(payload_size(key), 4)
    value_size = encode_integer(payload_size(value), 4)
    fix_key = _size_mismatch(headers, C.KEY_SIZE_HEADER, key)
    fix_value = _size_mismatch(headers, C.VALUE_SIZE_HEADER, value)
    repaired = F.transform_values(
        headers,
        lambda k, v: F.when((k == C.KEY_SIZE_HEADER) & fix_key, key_size)
        .when((k == C.VALUE_SIZE_HEADER) & fix_value, value_size)
        .otherwise(v),
    )
    both = F.create_map(F.lit(C.KEY_SIZE_HEADER), key_size, F.lit(C.VALUE_SIZE_HEADER), value_size)
    return F.coalesce(repaired, both)
