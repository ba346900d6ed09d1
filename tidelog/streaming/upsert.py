"""Upsert topics in a stream: live changelog and live buffered upsert."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.constants import LOG_COLUMNS, LOG_DDL
from tidelog.operators.buffering import buffers
from tidelog.operators.changelog import CHANGE_KEY, last_changes, to_changelog
from tidelog.streaming.tables import BatchTable

CHANGE_DDL = (
    "topic_uri STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key BINARY, change_no INT, "
    "row_kind STRING, value BINARY"
)


class BufferedUpsert:
    """An upsert sink's buffers in a stream: each writer's is emptied when it holds `max_keys` keys, or when `interval`
    seconds have passed since it was last emptied.

    What is buffered at the end of a micro-batch, the last change of each key, goes on to the next one: a table of the
    folder `root`, one state a micro-batch, so that a replayed one begins with the state it began with before. The
    position of a carried change stands before all later ones of its writer. Flushes are numbered per writer.
    """

    def __init__(
        self, spark: SparkSession, root: str, writer: list[str], key: list[str], position: str, max_keys: int, columns: list[str],
        schema: str, write: Callable[[DataFrame, int], None], interval: float | None = None, clock: Callable[[], float] = time.time,
    ):
        self.writer, self.key, self.position, self.max_keys, self.columns = writer, key, position, max_keys, columns
        self.write, self.interval, self.clock = write, interval, clock
        self.rows = [*writer, *key, position, "row_kind", *columns]
        self.state = BatchTable(spark, root, f"{schema}, next_no BIGINT, since DOUBLE")

    def step(self, batch: DataFrame, batch_id: int) -> None:
        """The body of a foreachBatch; `batch` has the writer, key, position and other columns, and `row_kind`."""
        now = self.clock()
        before = self.state.before(batch_id)
        changes = before.select(*self.rows, "next_no", "since").where("row_kind IS NOT NULL").unionByName(
            batch.select(*self.rows), allowMissingColumns=True)
        numbered = buffers(changes.drop("next_no", "since"), self.writer, self.key, self.position, self.max_keys)
        known = before.groupBy(*self.writer).agg(F.max("next_no").alias("next_no"), F.max("since").alias("since"))
        whole = F.count_distinct(*self.key) >= self.max_keys
        sizes = numbered.groupBy(*self.writer, "flush_no").agg(whole.alias("whole"))
        last = F.coalesce("since", F.lit(now))
        late = F.lit(False) if self.interval is None else last <= now - self.interval
        told = sizes.join(known, self.writer, "left").withColumn("goes", F.col("whole") | late)
        shift = F.coalesce("next_no", F.lit(0))
        kept = numbered.join(told.select(*self.writer, "flush_no", "goes", shift.alias("shift")), [*self.writer, "flush_no"]).persist()
        try:
            flushed = kept.where("goes").withColumn("flush_no", F.col("flush_no") + F.col("shift"))
            self.write(last_changes(flushed, self.writer, self.key, self.position, self.columns), batch_id)
            open_rows = kept.where("NOT goes").groupBy(*self.writer, *self.key).agg(F.max_by(F.struct(self.position, "row_kind", *self.columns), F.col(self.position)).alias("_row"))
            counts = told.groupBy(*self.writer).agg(F.count_if("goes").alias("_gone"))
            marks = counts.join(known, self.writer, "full").select(
                *self.writer, (F.coalesce("next_no", F.lit(0)) + F.coalesce("_gone", F.lit(0))).alias("next_no"),
                F.when(F.col("_gone") > 0, F.lit(now)).otherwise(last).alias("since"))
            # a writer with nothing buffered keeps its number and time in a row without a change
            left = marks.join(open_rows.select(*self.writer, *self.key, "_row.*"), self.writer, "left")
            self.state.write(left.select(*self.rows, "next_no", "since"), batch_id)
        finally:
            kept.unpersist()
        self.state.trim()

    def drain(self) -> None:
        """Empty all buffers at the end of the input."""
        batch_id = max(self.state.done(), default=-1) + 1
        rest = self.state.latest().where("row_kind IS NOT NULL").withColumn("flush_no", F.col("next_no"))
        self.write(last_changes(rest, self.writer, self.key, self.position, self.columns), batch_id)


class UpsertTable:
    """The current table of an upsert stream, kept as small changes and merged when read.

    A micro-batch writes the last row of each key it saw, tombstones included; nothing already written is touched.
    `compact` folds changes into a base. Reading takes the last row of a key over everything there is, so rows that
    are in a base and still in a change do no harm.
    """

    def __init__(self, spark: SparkSession, root: str, keys: tuple[str, ...] = ("topic_uri", "key")):
        self.changes = BatchTable(spark, f"{root}/changes", LOG_DDL)
        self.base = BatchTable(spark, f"{root}/base", LOG_DDL)
        self.keys = list(keys)

    def step(self, batch: DataFrame, batch_id: int) -> None:
        self.changes.write(self._last(batch.where(F.col("key").isNotNull())), batch_id)

    def _last(self, rows: DataFrame) -> DataFrame:
        columns = [c for c in LOG_COLUMNS if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*columns), F.col("offset")).alias("_row"))
        return last.select(*self.keys, "_row.*").select(*LOG_COLUMNS)

    def read(self) -> DataFrame:
        return self._last(self.base.all().unionByName(self.changes.all())).where(F.col("value").isNotNull())

    def before(self, batch_id: int, wanted: DataFrame) -> DataFrame:
        """The table as it was before a micro-batch, for the keys in `wanted`. Unless compacted beyond, as ever."""
        older = self.base.all().unionByName(self.changes.load([i for i in self.changes.done() if i < batch_id]))
        return self._last(older.join(wanted.select(*self.keys).distinct(), self.keys, "left_semi")).where(F.col("value").isNotNull())

    def compact(self, batch_id: int) -> None:
        """Fold the changes up to and including `batch_id` into the base. A crash leaves nothing out: what was
        folded is dropped only after the new base is complete."""
        bases, folded = self.base.done(), [i for i in self.changes.done() if i <= batch_id]
        self.base.write(self._last(self.base.load(bases).unionByName(self.changes.load(folded))), batch_id)
        for i in bases:
            if i != batch_id:
                self.base.drop(i)
        for i in folded:
            self.changes.drop(i)


class LiveChangelog:
    """A streaming upsert topic as +I, -U/+U, -D rows: each micro-batch against the last values of its keys.

    Last values are a table in the shared folder `root`, merged when read and folded every `compact_every` micro-batches.
    The changes are found by the batch operator, so a key that fills a micro-batch is cut into slices, all in the JVM.
    """

    def __init__(
        self, spark: SparkSession, root: str, write: Callable[[DataFrame, int], None], skip_unchanged: bool = True,
        slice_rows: int | None = None, compact_every: int = 16,
    ):
        self.table = UpsertTable(spark, root, tuple(CHANGE_KEY))
        self.write, self.skip_unchanged, self.slice_rows, self.compact_every = write, skip_unchanged, slice_rows, compact_every

    def step(self, batch: DataFrame, batch_id: int) -> None:
        """The body of a foreachBatch; a replayed micro-batch finds the values it found before."""
        if len([i for i in self.table.changes.done() if i < batch_id]) >= self.compact_every:
            self.table.compact(batch_id - 1)
        kept = batch.where(F.col("key").isNotNull()).select(*LOG_COLUMNS).persist()
        try:
            known = self.table.before(batch_id, kept)
            self.write(to_changelog(kept, self.skip_unchanged, self.slice_rows, known), batch_id)
            self.table.step(kept, batch_id)
        finally:
            kept.unpersist()
