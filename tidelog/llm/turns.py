"""Turns of conversations in their order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ship
from tidelog.llm.tokens import parts_of
from tidelog.operators.ordered import rank

#: A conversation: its number, and whether that is missing (joins on a null find nothing).
CONV = ["absent", "cid"]


def plain_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, missing: str) -> DataFrame:
    """`absent, cid, turn, role, text` and nothing else; `missing` stands for a null role or text."""
    return turns.select(
        F.col(conv_col).isNull().alias("absent"), F.coalesce(F.col(conv_col).cast("long"), F.lit(0)).alias("cid"), F.col(turn_col).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
    )


def numbered(plain: DataFrame, order: list[str]) -> DataFrame:
    """`plain` with `pos`, the place of a turn in its conversation, from 0.

    Rows are laid along conversation and order by range, so one conversation may fill many tasks. What is sampled for
    the ranges are only numbers, roles and digests, never texts.
    """
    ship(plain.sparkSession)
    return rank(plain, CONV, order, "pos")


def text_digest(*columns: str) -> Column:
    """A digest that tells apart any two tuples of strings, in hexadecimal digits."""
    return F.sha2(F.concat(*[x for c in columns for x in (F.length(c).cast("string"), F.lit(":"), F.col(c))]), 256)


def _digests(batches: Iterator[pa.RecordBatch], keys: list[str], join: bytes) -> Iterator[pa.RecordBatch]:
    own, digest = None, None

    def out(done: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
        columns = [pa.array([d[0][i] for d in done], like.column(k).type) for i, k in enumerate(keys)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], pa.string())], names=[*keys, "digest"])

    batch = None
    for batch in batches:
        at, done = 0, []
        for part in parts_of(batch.column("piece")):
            named = zip(*(batch.column(k).slice(at, len(part)).to_pylist() for k in keys), strict=True)
            for key, piece in zip(named, part.to_pylist(), strict=True):
                if key == own:
                    digest.update(join)
                else:
                    if own is not None:
                        done.append((own, digest.hexdigest()))
                    own, digest = key, hashlib.sha256()
                digest.update(piece.encode())
            at += len(part)
        yield out(done, batch)
    if own is not None:
        yield out([(own, digest.hexdigest())], batch)


def joined_digests(rows: DataFrame, keys: list[str], order: list[str], piece: Column, join: str) -> DataFrame:
    """`keys, digest`: SHA-256 (hexadecimal) of the pieces of each key in their order, with `join` between them.

    Such a digest can only be taken in order, so a key passes through one task; it does so piece by piece, and nothing
    but the running digest is kept.
    """
    ship(rows.sparkSession)
    laid = rows.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, piece.alias("piece"))
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return laid.mapInArrow(partial(_digests, keys=keys, join=join.encode()), f"{schema}, digest string")
