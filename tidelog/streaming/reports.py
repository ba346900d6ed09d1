"""Numbers per micro-batch, kept as a table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.sources import files


def observed(stream: DataFrame, name: str = "messages") -> DataFrame:
    """Count messages, keyed ones, tombstones and bytes while they pass."""
    size: Column = F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))
    return stream.observe(
        name, F.count(F.lit(1)).alias("n_messages"), F.count("key").alias("n_keyed"),
        F.count_if(F.col("value").isNull()).alias("n_null_value"), F.sum(size.cast("bigint")).alias("bytes_in"))


class BatchReports(StreamingQueryListener):
    """One small file per micro-batch in a shared folder, named after the query and the batch; a replayed batch
    replaces its own. `table` reads all of them."""

    DDL = ("query STRING, batch_id BIGINT, n_messages BIGINT, n_keyed BIGINT, n_null_value BIGINT, bytes_in BIGINT, "
           "duration_ms BIGINT")

    def __init__(self, spark: SparkSession, folder: str, name: str = "messages"):
        self.spark, self.folder, self.name = spark, folder.rstrip("/"), name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        numbers = p.observedMetrics.get(self.name)
        if numbers is None:
            return
        row = {"query": str(p.id), "batch_id": p.batchId, "n_messages": numbers.n_messages, "n_keyed": numbers.n_keyed,
               "n_null_value": numbers.n_null_value, "bytes_in": numbers.bytes_in, "duration_ms": p.durationMs.get("triggerExecution")}
        files.write_text(self.spark, f"{self.folder}/{p.id}-{p.batchId:012d}.json", json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def seen(self) -> int:
        return len([n for n in files.names(self.spark, self.folder) if n.endswith(".json")])

    def table(self) -> DataFrame:
        if not self.seen():
            return self.spark.createDataFrame([], self.DDL)
        return self.spark.read.schema(self.DDL).option("pathGlobFilter", "*.json").json(self.folder)
