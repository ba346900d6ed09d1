"""Big-endian payload encodings as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDTH = {"byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8}


def decode_integer(payload: Column, width: int) -> Column:
    """Signed big-endian integer of exactly `width` bytes, null for any other length."""
    if width == 8:
        number = F.conv(F.hex(payload), 16, -10).cast("bigint")
    else:
        unsigned = F.conv(F.hex(payload), 16, 10).cast("bigint")
        number = F.when(unsigned >= 1 << (8 * width - 1), unsigned - (1 << (8 * width))).otherwise(unsigned)
    return F.when(F.octet_length(payload) == width, number)


def encode_integer(number: Column, width: int) -> Column:
    """The low `width` bytes of a whole number, big-endian."""
    digits = F.lpad(F.hex(number.cast("bigint")), 16, "0")
    return F.unhex(F.right(digits, F.lit(2 * width)))


#: Bytes of a floating number: bits of its exponent and of its fraction.
_FLOATING = {4: (8, 23), 8: (11, 52)}


def decode_floating(payload: Column, width: int) -> Column:
    """IEEE 754 number of exactly `width` bytes as a double, which holds either width exactly; null for other lengths.

    Sign, exponent and fraction are taken from the bits, and powers of two are exact, so nothing is rounded.
    """
    exponent_bits, fraction_bits = _FLOATING[width]
    bits = decode_integer(payload, width)
    exponent = F.shiftright(bits, fraction_bits).bitwiseAND(F.lit((1 << exponent_bits) - 1).cast("bigint"))
    fraction = bits.bitwiseAND(F.lit((1 << fraction_bits) - 1).cast("bigint")).cast("double")
    least = 2 - (1 << (exponent_bits - 1)) - fraction_bits  # of the smallest number
    special = F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    size = (
        F.when(exponent == (1 << exponent_bits) - 1, special)
        .when(exponent == 0, fraction * F.pow(F.lit(2.0), F.lit(float(least))))
        .otherwise((fraction + float(1 << fraction_bits)) * F.pow(F.lit(2.0), (exponent + (least - 1)).cast("double"))))
    return F.when(F.octet_length(payload) == width, F.when(bits < 0, F.lit(-1.0)).otherwise(F.lit(1.0)) * size)


def encode_floating(number: Column, width: int) -> Column:
    """The IEEE 754 bytes of a number, big-endian; every NaN is written as the same one."""
    kind, method = ("float", "floatToIntBits") if width == 4 else ("double", "doubleToLongBits")
    bits = F.java_method(F.lit(f"java.lang.{kind.title()}"), F.lit(method), number.cast(kind))
    return F.when(number.isNotNull(), encode_integer(bits, width))


# Java's UUID reader takes short hex groups and pads them; text longer than 36 is refused.
_UUID_GROUPS = r"^[0-9a-fA-F]+-[0-9a-fA-F]+-[0-9a-fA-F]+-[0-9a-fA-F]+-[0-9a-fA-F]+$"
_UUID_WIDTHS = [8, 4, 4, 4, 12]


def decode_uuid(payload: Column) -> Column:
    text = F.make_valid_utf8(payload.cast("string"))
    groups = F.split(F.lower(text), "-")
    padded = [F.right(F.lpad(groups[i], 36, "0"), F.lit(w)) for i, w in enumerate(_UUID_WIDTHS)]
    return F.when(text.rlike(_UUID_GROUPS) & (F.length(text) <= 36), F.concat_ws("-", *padded))


DECODERS: dict[str, Callable[[Column], Column]] = {
    "bytes": lambda c: c,
    "byte": lambda c: decode_integer(c, 1).cast("tinyint"),
    "short": lambda c: decode_integer(c, 2).cast("smallint"),
    "integer": lambda c: decode_integer(c, 4).cast("int"),
    "long": lambda c: decode_integer(c, 8),
    "float": lambda c: decode_floating(c, 4).cast("float"),
    "double": lambda c: decode_floating(c, 8),
    "string": lambda c: F.make_valid_utf8(c.cast("string")),
    "uuid": decode_uuid,
}

ENCODERS: dict[str, Callable[[Column], Column]] = {
    "bytes": lambda c: c,
    "byte": lambda c: encode_integer(c, 1),
    "short": lambda c: encode_integer(c, 2),
    "integer": lambda c: encode_integer(c, 4),
    "long": lambda c: encode_integer(c, 8),
    "float": lambda c: encode_floating(c, 4),
    "double": lambda c: encode_floating(c, 8),
    "string": lambda c: F.encode(c.cast("string"), "UTF-8"),
    "uuid": lambda c: F.encode(c.cast("string"), "UTF-8"),
}


def register(name: str, decoder: Callable[[Column], Column], encoder: Callable[[Column], Column]) -> None:
    """Add a payload type of your own; both sides are Column functions (use an Arrow UDF inside if needed)."""
    DECODERS[name] = decoder
    ENCODERS[name] = encoder


def decode(payload: Column, kind: str) -> Column:
    return DECODERS[kind](payload)


def encode(value: Column, kind: str) -> Column:
    return ENCODERS[kind](value)


def decode_failed(payload: Column, decoded: Column) -> Column:
    """A payload that was there but did not decode."""
    return payload.isNotNull() & decoded.isNull()
