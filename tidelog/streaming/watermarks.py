"""Per-partition watermarks in a stream, idle partitions excluded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.eventtime import overall_watermark
from tidelog.operators.ordered import offset_slice, running_max
from tidelog.operators.small import checked_broadcast
from tidelog.streaming.tables import BatchTable

PARTITION = ["topic_uri", "partition"]
PROGRESS_DDL = "topic_uri STRING, partition INT, max_time TIMESTAMP, last_arrival TIMESTAMP"


class PartitionWatermarks:
    """Keeps the highest event time of every partition (one small row each) across micro-batches.

    Spark's own watermark is the maximum over all partitions less a delay, which makes rows of a slow partition
    late. Here a row is late only against its own partition, and windows close on the minimum over partitions.
    """

    def __init__(self, spark: SparkSession, root: str, delay: str = "0 seconds", by: list[str] | None = None,
                 idle_after: str | None = None, expected: DataFrame | None = None):
        """`expected` are the partitions that are subscribed; a group has no watermark before each has been seen."""
        self.expected = expected
        self.state = BatchTable(spark, f"{root}/progress", PROGRESS_DDL)
        self.marks_by = by or ["topic_uri"]
        self.delay, self.idle_after = delay, idle_after

    def advance(self, batch: DataFrame, batch_id: int, arrival=None) -> None:
        """Fold a micro-batch into the state; rows are reduced per partition before they meet the old state."""
        arrived = arrival if arrival is not None else F.current_timestamp()
        seen = batch.groupBy(*PARTITION).agg(F.max("timestamp").alias("max_time"), F.max(arrived).alias("last_arrival"))
        merged = self.state.before(batch_id).unionByName(seen).groupBy(*PARTITION).agg(
            F.max("max_time").alias("max_time"), F.max("last_arrival").alias("last_arrival"))
        self.state.write(merged, batch_id)
        self.state.trim()

    def current(self, now=None, before: int | None = None) -> DataFrame:
        """Watermark per `by` group, less the delay; with `before`, as it was before that micro-batch."""
        progress = self.state.latest() if before is None else self.state.before(before)
        moment = now if now is not None else F.current_timestamp()
        marks = overall_watermark(progress, self.marks_by, self.idle_after, moment)
        if self.expected is not None:
            unseen = self.expected.select(*PARTITION).distinct().join(progress, PARTITION, "left_anti")
            marks = marks.join(unseen.select(*self.marks_by).distinct(), self.marks_by, "left_anti")
        return marks.withColumn("watermark", F.col("watermark") - F.expr(f"INTERVAL {self.delay}"))

    def late(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of a micro-batch older than what their partition had reached when they arrived."""
        old = checked_broadcast(self.state.before(batch_id).select(*PARTITION, F.col("max_time").alias("_old")))
        sliced = batch.withColumn("_slice", offset_slice())
        seen = running_max(sliced, PARTITION, ["offset"], "_slice", "_seen", F.col("timestamp"), include_current=False)
        mark = F.greatest("_seen", "_old") - F.expr(f"INTERVAL {self.delay}")
        return (
            seen.join(old.df, PARTITION, "left").withColumn("watermark", mark)
            .where(F.col("timestamp") < F.col("watermark")).select(*batch.columns, "watermark"))


class TumblingCounts:
    """Tumbling-window aggregates that close on per-partition watermarks.

    Partial counts per window are state; a window is emitted once, when the group's watermark reaches its end. Counts
    that come for a window emitted before go to `late`, and the window stays as it was.
    """

    def __init__(self, spark: SparkSession, root: str, size: str, watermarks: PartitionWatermarks, by: list[str]):
        keys = ", ".join(f"{c} {'INT' if c == 'partition' else 'STRING'}" for c in by)
        self.by, self.size, self.watermarks = by, size, watermarks
        row = f"{keys}, window_start TIMESTAMP, window_end TIMESTAMP, n_rows BIGINT"
        self.open = BatchTable(spark, f"{root}/open", row)
        self.closed = BatchTable(spark, f"{root}/closed", row)
        self.late = BatchTable(spark, f"{root}/late", row)

    def step(self, arrival=None, now=None) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, batch_id: int) -> None:
            kept = batch.persist()
            try:
                self.watermarks.advance(kept, batch_id, arrival)
                self._fold(kept, batch_id, now)
            finally:
                kept.unpersist()

        return run

    def _fold(self, batch: DataFrame, batch_id: int, now) -> None:
        new = batch.groupBy(*self.by, F.window("timestamp", self.size).alias("w")).agg(F.count(F.lit(1)).alias("n_rows")).select(
            *self.by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows")
        new = self._marked(new, self.watermarks.current(now, before=batch_id)).persist()
        try:
            self.late.write(new.where("done").drop("done"), batch_id)
            self._emit(self.open.before(batch_id).unionByName(new.where("NOT done").drop("done")), batch_id, now)
        finally:
            new.unpersist()

    def _marked(self, counts: DataFrame, marks: DataFrame) -> DataFrame:
        on = [c for c in self.watermarks.marks_by if c in self.by]
        side = checked_broadcast(marks.select(*self.watermarks.marks_by, "watermark"))
        done = F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))
        return counts.join(side.df, on, "left").withColumn("done", done).drop("watermark")

    def _emit(self, partial: DataFrame, batch_id: int, now) -> None:
        state = partial.groupBy(*self.by, "window_start", "window_end").agg(F.sum("n_rows").alias("n_rows"))
        marked = self._marked(state, self.watermarks.current(now)).select(*state.columns, "done").persist()
        try:
            self.closed.write(marked.where("done").drop("done"), batch_id)
            self.open.write(marked.where("NOT done").drop("done"), batch_id)
        finally:
            marked.unpersist()
        self.open.trim()

    def results(self) -> DataFrame:
        return self.closed.all()
