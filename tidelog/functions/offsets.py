"""Composite offsets: batch offset and message offset packed into one number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.constants import MESSAGE_OFFSET_BITS, MESSAGE_OFFSET_MASK


def pack_offset(batch: Column, message: Column) -> Column:
    return F.shiftleft(batch.cast("bigint"), MESSAGE_OFFSET_BITS).bitwiseOR(message.cast("bigint"))


def batch_offset(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, MESSAGE_OFFSET_BITS)


def message_offset(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(MESSAGE_OFFSET_MASK).cast("bigint"))
