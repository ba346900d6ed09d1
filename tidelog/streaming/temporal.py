"""As-of join of two streams: rows wait until event time has passed them, then take the version valid at their time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.changelog import as_of_join
from tidelog.streaming.tables import BatchTable


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def both_sides(
    left: DataFrame, versions: DataFrame, key: list[str], left_time: str, version_time: str, version_order: list[str],
    left_columns: list[str], version_columns: list[str], deleted: Column,
) -> DataFrame:
    """The two streams as one, which is what `LiveAsOfJoin.step` takes: the key columns, `t`, `is_version`, `ord`, `l`, `v`.

    Rows without a key or a time have no version and do not take part.
    """
    order = F.struct(*version_order)
    none = lambda df, c: F.lit(None).cast(df.select(c.alias("x")).schema["x"].dataType)
    l, v = F.struct(*left_columns), F.when(~deleted, F.struct(*version_columns))
    rows = left.select(*key, F.col(left_time).alias("t"), F.lit(False).alias("is_version"), none(versions, order).alias("ord"), l.alias("l"), none(versions, v).alias("v"))
    known = versions.select(*key, F.col(version_time).alias("t"), F.lit(True).alias("is_version"), order.alias("ord"), none(left, l).alias("l"), v.alias("v"))
    both = rows.unionByName(known).where(F.col("t").isNotNull())
    for k in key:
        both = both.where(F.col(k).isNotNull())
    return both


class LiveAsOfJoin:
    """`as_of_join` over micro-batches, for any key columns.

    A left row is written once the watermark, the highest event time of both sides less `delay`, has passed it; versions
    may arrive up to `delay` out of order. What waits is a table of one state a micro-batch; versions are a table that
    grows by each micro-batch and is folded every `compact_every`: of those the watermark has passed only the last of a
    key can still be asked for. The join is the batch operator's, which spreads a hot key over many tasks. A left row
    that comes when the watermark has passed it goes to `late`, if there is one, and is not answered otherwise.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: list[str], sample: DataFrame, delay: str, write: Callable[[DataFrame, int], None],
        late: Callable[[DataFrame, int], None] | None = None, compact_every: int = 16,
    ):
        """`sample` is the stream of `both_sides`, of which only the schema is used."""
        self.key, self.write, self.late, self.compact_every = key, write, late, compact_every
        self.delay = F.expr(f"INTERVAL {delay}")
        self.waiting = BatchTable(spark, f"{root}/waiting", _ddl(sample.select(*key, "t", "l")))
        version = _ddl(sample.select(*key, "t", "ord", "v"))
        self.versions, self.base = BatchTable(spark, f"{root}/versions", version), BatchTable(spark, f"{root}/base", version)
        self.marks = BatchTable(spark, f"{root}/marks", "high TIMESTAMP")

    def _bound(self, high) -> Column:
        return F.lit(high).cast("timestamp") - self.delay

    def _fold(self, batch_id: int, bound: Column) -> None:
        """Versions of the micro-batches before `batch_id` into the base, less those nothing can ask for any more."""
        bases, folded = self.base.done(), [i for i in self.versions.done() if i < batch_id]
        rows = self.base.load(bases).unionByName(self.versions.load(folded))
        passed = rows.where(F.col("t") < bound).groupBy(*self.key).agg(F.max(F.struct("t", "ord")).alias("m"), F.max_by(F.struct("t", "ord", "v"), F.struct("t", "ord")).alias("x"))
        kept = rows.where(F.col("t") >= bound).unionByName(passed.select(*self.key, "x.*"))
        self.base.write(kept.dropDuplicates([*self.key, "t", "ord"]), batch_id - 1)
        for i in bases:
            if i != batch_id - 1:
                self.base.drop(i)
        for i in folded:
            self.versions.drop(i)

    def step(self, batch: DataFrame, batch_id: int) -> None:
        """The body of a foreachBatch; a replayed micro-batch finds what it found before."""
        before = self.marks.before(batch_id).agg(F.max("high")).first()[0]
        if before is not None and len([i for i in self.versions.done() if i < batch_id]) >= self.compact_every:
            self._fold(batch_id, self._bound(before))
        kept = batch.persist()
        try:
            reached = kept.agg(F.date_trunc("millisecond", F.max("t"))).first()[0]
            high = max((x for x in (before, reached) if x is not None), default=None)
            self.versions.write(kept.where("is_version").select(*self.key, "t", "ord", "v"), batch_id)
            rows = kept.where("NOT is_version").select(*self.key, "t", "l")
            if before is not None:
                if self.late is not None:
                    self.late(rows.where(F.col("t") < self._bound(before)), batch_id)
                rows = rows.where(F.col("t") >= self._bound(before))
            waiting = self.waiting.before(batch_id).unionByName(rows)
            known = self.base.all().unionByName(self.versions.load([i for i in self.versions.done() if i <= batch_id]))
            ready = F.col("t") < self._bound(high) if high is not None else F.lit(False)
            told = as_of_join(waiting.where(ready), known.withColumnRenamed("t", "vt"), self.key, "t", "vt", ["ord"], ["v"], F.col("v").isNull())
            self.write(told.select(*self.key, "l.*", "v.*"), batch_id)
            self.waiting.write(waiting.where(~ready), batch_id)
            self.marks.write(kept.sparkSession.createDataFrame([(high,)], "high TIMESTAMP"), batch_id)
        finally:
            kept.unpersist()
        self.waiting.trim()
        self.marks.trim()
