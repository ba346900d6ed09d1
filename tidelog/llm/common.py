"""What the operators of this package share: reading documents, block numbers, shared folders, shipping."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import durable_table, scratch_dir  # noqa: F401  general helpers, used by the modules here

#: White space between words: space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Put the package on the path of the Python workers, wherever the driver was started. Once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidelog-llm-")) / "tidelog.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def give_back() -> None:
    """Return memory that a Python worker no longer needs to the system; workers stay while other stages run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    """How many ways keys are dealt out: the session's own setting, which a user raises with the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def two_columns(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """`doc_id`, `text` and nothing else, whatever the other columns are called; a null text is empty.

    With `carry` the other columns come along, by position, in a struct `rest`; `with_rest` puts them back.
    """
    own = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]
    if carry:
        others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col)]
        own.append(F.struct(*others, F.lit(None).cast("int").alias("none")).alias("rest"))
    return docs.select(*own)


def with_rest(docs: DataFrame, out: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`out` (doc_id, text, rest) with the columns of `docs`, in their order."""
    own = {id_col: F.col("doc_id"), text_col: F.col("text")}
    return out.select(*[own.get(c, F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def block_of(n: int) -> Column:
    """A number from 0 to n - 1, the same for rows of the same `doc_id`."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")


#: Bits of the filter of `probably_in`: 1 MB at least, 32 MB at most.
LEAST_SLOTS, MOST_SLOTS = 1 << 23, 1 << 28


def probably_in(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose `keys` are in `wanted`, a written table, and a few others: by one bit for a hash of the keys, in a
    bitmap of some 16 bits a wanted row. It spares a shuffle most of the rows; a join on the keys decides.

    The bitmap is broadcast and never larger than MOST_SLOTS bits. Beyond a wanted row for every bit it would let most
    rows pass, so then all of them do.
    """
    n = wanted.count()
    if n > MOST_SLOTS:
        return rows
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (16 * n).bit_length()))
    slot = F.pmod(F.xxhash64(*keys), F.lit(slots))
    bits = wanted.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # at most slots / 8 bytes in pages of 4 KB
    return rows.withColumn("page", F.bitmap_bucket_number(slot)).join(F.broadcast(bits), "page").filter(F.getbit(byte, (at % 8).cast("int")) == 1).drop("page", "bits")
