"""Rounds of question and answer between blocks of documents and buckets of names.

Documents are dealt into blocks by id, once; every round reads the same exchange again. In a round each block asks
about the names (fingerprints) of some of its strings: names of equal strings from anywhere meet in the bucket that
the name itself picks, where sorting settles the question, and the bucket answers the block in the order it was
asked. Every name occurs once per block in a question, however often it stands in the block, so a string that fills a
third of the corpus costs its bucket one entry per block. Questions and answers are packed arrays, one row for each
pair of block and bucket that has any. What a block must remember for its next round travels as a note to itself.

All of it is one lazy plan of shuffles: Spark computes a lost part again from the parts before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import block_of, partitions, ship, two_columns
from tidelog.llm.names import equal_runs

LETTER = "bucket int, block int, payload binary"
_LETTER = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
#: Blocks for each shuffle partition, and partitions for each bucket. A round sends a row for every pair of the two, at
#: most as many as a shuffle has parts of files; more blocks and fewer buckets shift memory from those to these.
BLOCKS, BUCKETS = 2, 2


class Block:
    """The documents of one block: their ids (`known` is False at a null one) and all bytes in one array."""

    def __init__(self, number: int, table: pa.Table):
        # shuffles deliver rows in any order, and positions must mean the same in every round
        table = table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")]))
        self.number = number
        self.table = table
        ids = table.column("doc_id").combine_chunks()
        self.known = ~np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0)).astype(np.int64)
        text = table.column("text").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.string())
        text = text.cast(pa.large_binary())
        n = len(text)
        self.offsets = np.frombuffer(text.buffers()[1], np.int64, n + 1, text.offset * 8) if n else np.zeros(1, np.int64)
        lo, hi = int(self.offsets[0]), int(self.offsets[-1])
        body = text.buffers()[2]
        self.data = np.frombuffer(body, np.uint8)[lo:hi] if body is not None and hi > lo else np.zeros(0, np.uint8)
        self.offsets = self.offsets - lo

    def doc_at(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1


@lru_cache(maxsize=1)
def _zstd() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any types as bytes, compressed."""
    head = [len(arrays)]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        code = a.dtype.str.encode().ljust(4)[:4]
        body.append(code + np.int64(len(a)).tobytes() + a.tobytes())
    raw = bytes(head) + b"".join(body)
    return np.int64(len(raw)).tobytes() + _zstd().compress(raw, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(data, np.int64, 1)[0])
    raw = memoryview(_zstd().decompress(memoryview(data)[8:], decompressed_size=size, asbytes=True))
    out, at = [], 1
    for _ in range(raw[0]):
        kind = np.dtype(bytes(raw[at:at + 4]).decode().strip())
        n = int(np.frombuffer(raw, np.int64, 1, at + 4)[0])
        out.append(np.frombuffer(raw, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def narrow(x: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the smallest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


def short_keys(names: np.ndarray, size: int) -> np.ndarray:
    """The lower `size` bytes of 64-bit names, as an array of bytes. The upper ones pick the bucket."""
    return np.ascontiguousarray(names.view(np.uint8).reshape(-1, 8)[:, :size]).reshape(-1)


def long_keys(data: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = data.reshape(-1, size)
    return out.reshape(-1).view(np.uint64)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """From 0 to buckets - 1, growing with the name."""
    return (((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def share_of(names: np.ndarray, buckets: int, shares: int) -> np.ndarray:
    """From 0 to shares - 1 (a power of two up to 256), growing with the name within a bucket."""
    inside = ((names >> np.uint64(32)) * np.uint64(buckets)) & np.uint64(0xFFFFFFFF)
    return ((inside * np.uint64(shares)) >> np.uint64(32)).astype(np.uint8)


def letters(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(_LETTER)], schema=_LETTER)


def to_blocks(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> tuple[DataFrame, int]:
    """`doc_id`, `text`, `block`, and the number of buckets."""
    spark = docs.sparkSession
    ship(spark)
    n = partitions(spark)
    return two_columns(docs, id_col, text_col, carry).withColumn("block", block_of(BLOCKS * n)), -(-n // BUCKETS)


def ask_first(blocks: DataFrame, question: Callable[[Block], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    def first(table: pa.Table) -> pa.Table:
        return letters(question(Block(table.column("block")[0].as_py(), table)))

    return blocks.groupBy("block").applyInArrow(first, LETTER)


def settle(questions: DataFrame, answer: Callable[[list[tuple[int, bytes]]], list[bytes]]) -> DataFrame:
    """Each bucket's answers. A note (negative bucket) goes on unread."""

    def in_bucket(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(["bucket", "block", "payload"])
        rows = list(zip(table.column("block").to_pylist(), table.column("payload").to_pylist(), strict=True))
        bucket = table.column("bucket")[0].as_py()
        return letters((bucket, block, out) for (block, _), out in zip(rows, answer(rows), strict=True))

    return questions.groupBy("bucket").applyInArrow(in_bucket, LETTER)


def ask_again(blocks: DataFrame, answers: DataFrame, then: Callable, schema: str) -> DataFrame:
    """`then(block, {bucket: answer}, note)` for every block; it returns a table of `schema`."""

    def next_round(left: pa.Table, right: pa.Table) -> pa.Table:
        got = dict(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist(), strict=True))
        number = left.column("block")[0].as_py()
        return then(Block(number, left), got, got.pop(-1 - number, None))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(next_round, schema)


def note(number: int, *arrays: np.ndarray) -> tuple[int, int, bytes]:
    return (-1 - number, number, pack(*arrays))


class Question:
    """Distinct names of one block, in the order in which the buckets are asked.

    `docs`, if given, are ids (int64) by entry; `least` and `many` then tell for each distinct name the smallest of
    them and whether there are several.
    """

    def __init__(self, names: np.ndarray, buckets: int, docs: np.ndarray | None = None, second: np.ndarray | None = None):
        order = np.argsort(names) if second is None else np.lexsort((second, names))
        s = names[order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        if second is not None:
            t = second[order]
            new[1:] |= t[1:] != t[:-1]
        at = np.flatnonzero(new)
        self.names = s[at]
        self.second = second[order][at] if second is not None else None
        self.of = np.empty(len(s), np.int64)  # of each entry, the number of its distinct name
        self.of[order] = np.cumsum(new) - 1
        self.parts = np.searchsorted(bucket_of(self.names, buckets), np.arange(buckets + 1))
        if docs is not None:
            d = docs[order]
            self.least = np.minimum.reduceat(d, at) if len(at) else d
            self.many = np.maximum.reduceat(d, at) != self.least if len(at) else np.zeros(0, bool)

    def by_part(self, payload: Callable[[slice], bytes], number: int) -> Iterator[tuple[int, int, bytes]]:
        for b in np.flatnonzero(self.parts[1:] > self.parts[:-1]).tolist():
            yield b, number, payload(slice(self.parts[b], self.parts[b + 1]))

    def bits(self, answers: dict[int, bytes]) -> np.ndarray:
        """One bit per distinct name, from answers that pack them."""
        out = np.zeros(len(self.names), bool)
        for b, data in answers.items():
            lo, hi = self.parts[b], self.parts[b + 1]
            out[lo:hi] = np.unpackbits(np.frombuffer(data, np.uint8), count=hi - lo).view(bool)
        return out


def id_offsets(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids as a base and small offsets, if their range allows it."""
    if len(ids) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    base = int(ids.min())
    if int(ids.max()) - base < 1 << 32:
        return np.array([base], np.int64), narrow(ids - base)
    return np.zeros(1, np.int64), ids


def shared(rows: list[tuple[int, bytes]], size: int) -> list[bytes]:
    """For each name asked about: does a second document have it? (A flag says that one block has several.)"""
    asked = [unpack(p) for _, p in rows]
    counts = [len(k) // size for k, _ in asked]
    keys = np.concatenate([long_keys(k, size) for k, _ in asked])
    many = np.concatenate([np.unpackbits(m, count=c) for (_, m), c in zip(asked, counts, strict=True)]).astype(bool)
    order = np.argsort(keys, kind="stable")
    at = equal_runs(keys[order])
    n = np.diff(np.append(at, len(keys)))
    yes = np.empty(len(keys), bool)
    yes[order] = np.repeat((n > 1) | (np.maximum.reduceat(many[order], at) if len(at) else many), n)
    return [np.packbits(x).tobytes() for x in np.split(yes, np.cumsum(counts)[:-1])]


def ask_shared(question: Question, number: int, size: int) -> Iterator[tuple[int, int, bytes]]:
    return question.by_part(lambda s: pack(short_keys(question.names[s], size), np.packbits(question.many[s])), number)


def ask_least(question: Question, number: int) -> Iterator[tuple[int, int, bytes]]:
    return question.by_part(lambda s: pack(question.names[s], question.second[s].astype(np.uint32), *id_offsets(question.least[s])), number)


def has_least(rows: list[tuple[int, bytes]]) -> list[bytes]:
    """For each name asked about: is the block's smallest document the smallest of all?"""
    asked = [unpack(p) for _, p in rows]
    names = np.concatenate([a[0] for a in asked])
    second = np.concatenate([a[1] for a in asked])
    ids = np.concatenate([a[2][0] + a[3].astype(np.int64) for a in asked])
    order = np.lexsort((second, names))
    s, t = names[order], second[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[order], at) if len(at) else ids
    yes = np.empty(len(names), bool)
    yes[order] = ids[order] == np.repeat(least, np.diff(np.append(at, len(s))))
    return [np.packbits(x).tobytes() for x in np.split(yes, np.cumsum([len(a[0]) for a in asked])[:-1])]
