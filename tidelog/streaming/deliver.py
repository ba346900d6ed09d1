"""Streams into a topic log, with delivery guarantees and offset commits."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.sources.topiclog import TopicLog

NONE, AT_LEAST_ONCE, EXACTLY_ONCE = "none", "at-least-once", "exactly-once"
DISABLED, ON_CHECKPOINTS, PERIODIC = "disabled", "on-checkpoints", "periodic"

Step = Callable[[DataFrame, int], None]


def transaction_id(prefix: str, batch_id: int) -> str:
    return f"{prefix}-{batch_id:012d}"


def commit_mode(auto_commit: bool, commit_on_checkpoint: bool, checkpointing: bool) -> str:
    """With checkpoints only their own flag counts, without them only auto commit does."""
    if checkpointing:
        return ON_CHECKPOINTS if commit_on_checkpoint else DISABLED
    return PERIODIC if auto_commit else DISABLED


def progress_of(batch: DataFrame, group_id: str) -> DataFrame:
    """Next offset per partition after a micro-batch, as rows of the commit log."""
    return batch.groupBy("topic_uri", "partition").agg((F.max("offset") + 1).alias("next_offset")).select(
        F.lit(group_id).alias("group_id"), "topic_uri", "partition", "next_offset",
        F.current_timestamp().alias("committed_at"))


def write_step(
    log: TopicLog, make_outbox: Callable[[DataFrame], DataFrame], order: list[str], prefix: str,
    guarantee: str = EXACTLY_ONCE, group_id: str | None = None, on_commit: Callable[[int], None] | None = None,
) -> Step:
    """The body of a foreachBatch: one transaction per micro-batch.

    Exactly-once names it after the batch, so a replay is a no-op. The weaker guarantees name every attempt
    differently, so a replay may write twice. With `group_id`, input offsets are committed by the same marker.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        txn = transaction_id(prefix, batch_id)
        if guarantee != EXACTLY_ONCE:
            txn = f"{txn}-{uuid.uuid4().hex[:8]}"
        elif log.is_committed(txn):
            return
        kept = batch.persist()  # read by the range sample, the write and the progress
        try:
            offsets = progress_of(kept, group_id) if group_id else None
            done = log.append(make_outbox(kept), txn, order, group_offsets=offsets)
        finally:
            kept.unpersist()
        if done and on_commit:
            on_commit(batch_id)

    return step


def deliver(
    stream: DataFrame, log: TopicLog, make_outbox: Callable[[DataFrame], DataFrame], order: list[str], prefix: str,
    checkpoint: str | None, guarantee: str = EXACTLY_ONCE, group_id: str | None = None,
    old_prefixes: list[str] | None = None, trigger: dict | None = None,
    on_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the stream. Transactions left staged by an earlier run, also under an old prefix, are dropped first."""
    if guarantee == EXACTLY_ONCE and not checkpoint:
        raise ValueError("exactly-once delivery needs a checkpoint location")
    if guarantee == EXACTLY_ONCE:
        log.abort_lingering([prefix, *(old_prefixes or [])])
    step = write_step(log, make_outbox, order, prefix, guarantee, group_id, on_commit)
    writer = stream.writeStream.foreachBatch(step).trigger(**(trigger or {"availableNow": True}))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()


def commit_progress(log: TopicLog, group_id: str, mode: str = ON_CHECKPOINTS, every: int = 1) -> Step:
    """Commit a group's offsets after micro-batches; for information only, a restart uses the checkpoint.

    `on-checkpoints` commits every batch, `periodic` every `every` batches, `disabled` never.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        if mode == DISABLED or (mode == PERIODIC and batch_id % every != 0):
            return
        log.commit_offsets(progress_of(batch, group_id), f"offsets-{transaction_id(group_id, batch_id)}")

    return step


def in_turn(*steps: Step) -> Step:
    """Run several steps on each micro-batch, reading it once."""
    def step(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for s in steps:
                s(kept, batch_id)
        finally:
            kept.unpersist()

    return step


def listen(stream: DataFrame, handle: Callable, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Push every message to `handle(row)` in the tasks."""
    return (
        stream.writeStream.foreach(handle).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start())
