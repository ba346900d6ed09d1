"""Small state kept as one parquet folder per micro-batch, so that a replayed batch starts from the right state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.sources import files


class BatchTable:
    """`<root>/batch=<id>` holds the state after micro-batch `id`. A replay overwrites its own folder only."""

    def __init__(self, spark: SparkSession, root: str, ddl: str, keep: int = 10):
        self.spark, self.root, self.ddl, self.keep = spark, root.rstrip("/"), ddl, keep

    def done(self) -> list[int]:
        ids = [int(n.removeprefix("batch=")) for n in files.names(self.spark, self.root) if n.startswith("batch=")]
        return sorted(i for i in ids if files.exists(self.spark, f"{self.root}/batch={i}/_SUCCESS"))

    def before(self, batch_id: int) -> DataFrame:
        """State as it was before `batch_id` ran."""
        return self.load([i for i in self.done() if i < batch_id][-1:])

    def latest(self) -> DataFrame:
        return self.load(self.done()[-1:])

    def all(self) -> DataFrame:
        """Rows of every batch, for tables that are appended to."""
        return self.load(self.done())

    def load(self, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.ddl)
        return self.spark.read.schema(self.ddl).parquet(*[f"{self.root}/batch={i}" for i in batches])

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")

    def trim(self) -> None:
        """Drop all but the newest states."""
        for i in self.done()[: -self.keep]:
            self.drop(i)

    def drop(self, batch_id: int) -> None:
        files.delete(self.spark, f"{self.root}/batch={batch_id}")
