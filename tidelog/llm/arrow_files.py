"""Token ids in Arrow stream files of equal-length sequences.

A shard file holds two Arrow streams, one after the other. The first has the ids of its documents, one after the
other in ascending order of `doc_id`, cut into sequences of equal length:

    ids   fixed_size_list<uint16 or uint32>[length]   (uint16 if the vocabulary allows it)
    mask  fixed_size_list<bool>[length]               false for the padding behind the shard's last id
    ends  fixed_size_list<bool>[length]               true for the last id of a document

Lists of fixed size have no offsets: sequence i of a batch stands at i * length of one flat buffer, so a mapped file
gives any sequence and its masks without a copy. The second stream lists the shard's documents: `doc_id`, in order.
Shards are ranges of ids; a task writes its range under a temporary name and renames it, so that a repeated task
replaces a file by an equal one and a reader never sees half of one.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import documents, durable_table, give_back, partitions, scratch_dir, ship, two_columns
from tidelog.llm.tokens import forget, library_ids_by_piece, tokenizer

#: Sequences in a batch; ids in a file, after which a range goes on in another file.
BATCH, SHARD = 64, 1 << 24
_DOCUMENTS = pa.schema([("doc_id", pa.int64())])


def sequence_schema(length: int, width: int) -> pa.Schema:
    kind = pa.uint16() if width == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)), ("ends", pa.list_(pa.bool_(), length))])


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class Shard:
    """One file that is being written."""

    def __init__(self, folder: str, name: str, length: int, width: int):
        self.system, at = _file_system(folder)
        self.system.create_dir(at, recursive=True)
        self.name, self.final = name, f"{at}/{name}.arrows"
        self.temporary = f"{self.final}.{uuid.uuid4().hex}.tmp"
        self.file = self.system.open_output_stream(self.temporary)
        self.schema = sequence_schema(length, width)
        self.stream = pa.ipc.new_stream(self.file, self.schema)
        self.length, self.kind = length, np.uint16 if width == 2 else np.uint32
        self.parts: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.waiting = self.total = 0
        self.doc_ids, self.nulls = array("q"), 0  # null ids come first

    def add(self, doc_id: int | None, ids: bytes) -> tuple[int, int]:
        """Returns where the document begins in the file, and its number of ids."""
        x = np.frombuffer(ids, "<u4").astype(self.kind)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)
        self.parts.append(x)
        self.sizes.append(len(x))
        self.waiting += len(x)
        self.total += len(x)
        if self.waiting >= BATCH * self.length:
            self._write(self.waiting // (BATCH * self.length) * BATCH)
        return self.total - len(x), len(x)

    def _write(self, sequences: int) -> None:
        flat = np.concatenate(self.parts) if self.parts else np.zeros(0, self.kind)
        ends = np.zeros(len(flat), bool)
        ends[np.cumsum(self.sizes) - 1] = True  # in a part left over from the batch before, too
        size = sequences * self.length
        body = np.zeros(size, self.kind)
        mask, end = np.zeros(size, bool), np.zeros(size, bool)
        n = min(size, len(flat))
        body[:n], mask[:n], end[:n] = flat[:n], True, ends[:n]
        for lo in range(0, size, BATCH * self.length):
            cut = slice(lo, lo + BATCH * self.length)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[cut]), type=t) for x, t in zip((body, mask, end), self.schema.types, strict=True)]
            self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        rest = flat[n:]
        self.parts, self.waiting = [rest], len(rest)
        left = np.flatnonzero(ends[n:])
        self.sizes = np.diff(left, prepend=-1).tolist()

    def close(self) -> None:
        if self.waiting:
            self._write(-(-self.waiting // self.length))
        self.stream.close()
        with pa.ipc.new_stream(self.file, _DOCUMENTS) as s:
            ids = pa.concat_arrays([pa.nulls(self.nulls, pa.int64()), pa.array(np.frombuffer(self.doc_ids, np.int64))])
            s.write_batch(pa.RecordBatch.from_arrays([ids], schema=_DOCUMENTS))
        self.file.close()
        self.system.move(self.temporary, self.final)


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, length: int) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], "<u4").tobytes()
    width = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    task, number, shard = TaskContext.get().partitionId(), 0, None

    def done(s: Shard) -> pa.RecordBatch:
        s.close()
        return pa.RecordBatch.from_arrays([pa.array([s.name]), pa.array([s.nulls + len(s.doc_ids)], pa.int64()), pa.array([s.total], pa.int64())], names=["shard", "n_docs", "n_tokens"])

    for batch in batches:
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), library_ids_by_piece(path, batch.column("text")), strict=True):
            if shard is None:
                shard = Shard(folder, f"{task:08d}-{number:06d}", length, width)
                number += 1
            shard.add(doc_id, ids + end)
            if shard.total >= SHARD:
                yield done(shard)
                shard = None
    if shard is not None:
        yield done(shard)
    give_back()


def write(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", length: int = 2048) -> DataFrame:
    """Write the ids of all texts below `folder`; returns the manifest `shard, n_docs, n_tokens, start`.

    Shards in the order of their names hold ascending ids (null ids first; rows of equal id by a hash of their text, so
    that a third of all rows may have one id, or none, and still fill many shards). Every
    document is followed by `end_id`; a null or empty text is that alone. An empty table has no shards.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = two_columns(docs, id_col, text_col)
    order = [F.col("doc_id"), F.xxhash64("text")]
    laid = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    write_shards = partial(_write, folder=folder, path=path, end_id=end_id, length=length)
    manifest = durable_table(laid.mapInArrow(write_shards, "shard string, n_docs long, n_tokens long"), "manifest")
    # sums over the tasks, one row each, and over the files of a task
    named = manifest.withColumn("task", F.substring("shard", 1, 8))
    earlier = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = named.groupBy("task").agg(F.sum("n_tokens").alias("n_tokens")).select("task", earlier(Window.orderBy("task")).alias("before"))
    within = named.withColumn("within", earlier(Window.partitionBy("task").orderBy("shard")))
    return within.join(tasks, "task").select("shard", "n_docs", "n_tokens", (F.col("before") + F.col("within")).cast("long").alias("start"))


def _open(system: fs.FileSystem, at: str):
    return pa.memory_map(at) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(at)


def open_shard(source) -> tuple[Iterator[pa.RecordBatch], pa.Array]:
    """The batches of a shard file, which are views of it where it is mapped, and its documents."""
    for _ in pa.ipc.open_stream(source):
        pass  # the documents stand behind the sequences
    doc_ids = pa.ipc.open_stream(source).read_next_batch().column("doc_id")
    source.seek(0)
    return iter(pa.ipc.open_stream(source)), doc_ids


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """Place and ids of each document, from one batch of sequences at a time."""
    begun, place, parts = 0, 0, []
    for batch in batches:
        ids, ends = (batch.column(c).flatten() for c in ("ids", "ends"))
        ids = ids.to_numpy().astype("<u4")
        at = 0
        for end in (np.flatnonzero(ends.to_numpy(zero_copy_only=False)) + 1).tolist():
            parts.append(ids[at:end].tobytes())
            yield begun, b"".join(parts)
            begun, at, parts = place + end, end, []
        parts.append(ids[at:].tobytes())
        place += len(ids)


_READ = ["shard", "doc_id", "at", "n_tokens", "ids"]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()  # the same worker may have written
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, at = _file_system(path)
            shard = at.rsplit("/", 1)[1].removesuffix(".arrows")
            with _open(system, at) as source:
                sequences, doc_ids = open_shard(source)
                rows, size = [], 0
                for doc_id, (begun, ids) in zip(doc_ids, _documents(sequences), strict=True):
                    rows.append((shard, doc_id.as_py(), begun, len(ids) // 4, ids))
                    size += len(ids)
                    if size > 1 << 22:
                        yield _rows(rows)
                        rows, size = [], 0
                yield _rows(rows)
    give_back()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_READ)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """`shard, doc_id, at, n_tokens, ids`: every document in the files, its place in the shard, and its ids as
    little-endian unsigned 32-bit integers. Spark lists the files and deals them out by size; tasks map or open them, and
    hold one batch of sequences at a time."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arrows").load(folder)
    return files.select("path").mapInArrow(_read, "shard string, doc_id long, at long, n_tokens long, ids binary")


def op10_arrow_stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "arrow-files")
    manifest = write(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, length=2048)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    rows = read(spark, folder).select("shard", "doc_id", "at", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return rows.join(manifest.select("shard", "start"), "shard").select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


QUERIES = {"op10_arrow_stream_files": op10_arrow_stream_files}
