"""Exact duplicates by a stream with keyed state on disk.

Documents arrive as a stream of files. The state, in RocksDB and checkpointed in the shared folder, has one entry for
each digest and never expires: how many texts had it, and of the largest id the id and the locator (file and row) of
its content. A later run over new files goes on from the same checkpoint. A digest met more than once is a hit, and
for hits the bytes themselves are compared before anything counts as a copy: texts of one digest that differ are
classes of their own. Texts that are no hits are not shuffled, but for the few that a filter on digests lets pass.

Rows of equal text collapse within each task before they are shuffled, so a text that makes up a third of the corpus
costs one row per task; the join that tells every row its class carries digests and ids only and lets Spark split a
frequent digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import durable_table, probably_in, scratch_dir

#: State on disk, without space reserved ahead in each of the many stores.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
    )


def _stays() -> Column:
    """The largest id; of rows of the same id the last by place."""
    return F.max(F.struct("doc_id", "file", "row"))


def collect_state(spark: SparkSession, path: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = 1 << 36) -> DataFrame:
    """Run the stream over the files below `path` that the checkpoint does not have yet; returns the whole state,
    `digest, stays (doc_id, file, row), n`. `max_bytes` bounds a micro-batch."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        schema = spark.read.parquet(path).schema
        # as a pattern the path may be a single file, too
        source = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes)).parquet(f"{path[:-1]}[{path[-1]}]")
        state = _rows(source, id_col, text_col).groupBy("digest").agg(_stays().alias("stays"), F.count(F.lit(1)).alias("n"))
        run = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        kept = spark.read.format("statestore").load(checkpoint)
        stays, n = kept.schema["value"].dataType.names[:2]
        digest = kept.schema["key"].dataType.names[0]
        # written down, as the store's own files are opened with the settings above
        return durable_table(kept.select(F.col(f"key.{digest}").alias("digest"), F.col(f"value.{stays}").alias("stays"), F.col(f"value.{n}").alias("n")), "state")
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def copies(spark: SparkSession, path: str, checkpoint: str | None = None, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = 1 << 36) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256` for every row of the Parquet table at `path`.

    Rows are equal if their texts are, byte for byte; a null text is empty. The row of the largest id stays; null ids
    are the smallest, and of rows of one id and text the last by file and place stays. Other columns are not read. An
    empty table gives no rows. `checkpoint` (a shared folder) keeps the state for later runs over more files.
    """
    docs = spark.read.parquet(path)
    # without a single file a stream has nothing to start from
    state = collect_state(spark, path, checkpoint or scratch_dir(spark, "stream-dedup"), id_col, text_col, max_bytes)
    rows = _rows(docs, id_col, text_col)
    # the bytes of hits alone: their texts meet whole, one row per task and text, whatever the number of copies; only
    # what is known of a text goes on from there
    hits = durable_table(state.filter("n > 1").select("digest", F.col("n").alias("all")), "hits")
    texts = probably_in(rows, hits, ["digest"]).groupBy("digest", "text").agg(_stays().alias("stays"), F.count(F.lit(1)).alias("n")).select("digest", F.xxhash64("text").alias("mark"), "stays", "n")
    differ = durable_table(texts.join(hits, "digest").filter("n < all").select("digest", "mark", "stays", "n"), "differ")
    light = rows.withColumn("mark", F.xxhash64("text")).drop("text")
    plain = light.join(state, "digest").join(differ.select("digest").distinct(), "digest", "left_anti")
    apart = light.join(differ, ["digest", "mark"]).select(*plain.columns)
    own = F.struct("doc_id", "file", "row")
    return plain.unionByName(apart).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (own == F.col("stays")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op6_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(spark, f"{sf_dir}/documents.parquet")


QUERIES = {"op6_stream_dedup": op6_stream_dedup}
ORACLES = {
    "op6_stream_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
}
