"""Packing by powers of two: each document is cut into pieces of binary length and pieces of equal length are bucketed.

A document of n tokens gives n // longest pieces of the longest length and one for every set bit of the rest, the
longer first. Each piece is a sequence of its own: none crosses documents, and none needs padding, since a batch is
drawn from one bucket. The work is one pass over the documents without a shuffle: every task adds a file to the bucket
of each length it has pieces of, and what is returned is read from the buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import documents, give_back, scratch_dir, ship, two_columns
from tidelog.llm.tokens import ids_by_word

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
_NAMES = ["doc_id", "start", "length", "doc_tokens", "ids"]


def cuts(n: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the pieces of n tokens; `longest` is a power of two."""
    whole, rest = divmod(n, longest)
    bits = [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]
    lengths = np.array([longest] * whole + bits, np.int64)
    return np.cumsum(lengths) - lengths, lengths


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, longest: int) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_by_word(path, batch.column("text")), strict=True):
            ids += end
            n = len(ids) // 4
            for a, k in zip(*(x.tolist() for x in cuts(n, longest)), strict=True):
                rows.append((doc_id, a, k, n, ids[4 * a : 4 * (a + k)]))
            size += len(ids)
            if size > 1 << 23:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)
    give_back()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)


def cut(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, longest: int = 2048) -> DataFrame:
    """The columns of PIECES, one row per piece, in the order of the documents."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    ship(docs.sparkSession)
    return two_columns(docs, id_col, text_col).mapInArrow(partial(_pieces, path=path, end_id=end_id, longest=longest), PIECES)


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length, which a training run reads with batches of equal shape."""
    packed.write.partitionBy("length").parquet(path)


def read_buckets(spark: SparkSession, path: str, length: int | None = None) -> DataFrame:
    """`doc_id, start, length, doc_tokens, ids, sequence_id, offset` of what `write_buckets` wrote, or of the bucket of
    one length, without the files of the others. Every piece is the whole of its sequence, so `offset` is 0; sequence
    ids are unique within a read."""
    back = spark.read.schema(PIECES).parquet(path).select(*_NAMES)
    if length is not None:  # before rows are numbered, which a filter cannot pass
        back = back.filter(F.col("length") == length)
    return back.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, longest: int = 2048, buckets: str | None = None,
) -> DataFrame:
    """`doc_id, start, length, doc_tokens, ids, sequence_id, offset`, one row per piece; ids are little-endian unsigned
    32-bit, each document's followed by `end_id`. They are written to the folder `buckets`, which must not exist (one
    in the shared folder if none is named), and read from there; sequence ids hold for one read of them.

    A null or empty text is the end id alone. A null id is carried; rows of equal id are documents of their own. No
    documents give no pieces.
    """
    packed = cut(docs, path, id_col, text_col, end_id, longest)
    at = buckets or scratch_dir(docs.sparkSession, "buckets")
    write_buckets(packed, at)
    return read_buckets(docs.sparkSession, at)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1, longest=2048)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op4_packing": op4_packing}
