"""Streams that keep more than a window per key: sessions, reading times, grading queues."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lectern.operators import realtime, speed
from lectern.schemas import TOPICS, ddl
from lectern.sources.batches import read_batches, write_batch
from lectern.sources.events import decode_topic
from lectern.functions.keyed import newest

SESSIONS = ddl(
    "user_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, events BIGINT, logins BIGINT, logouts BIGINT"
)
READS = ddl(
    "user_id STRING, notification_id STRING, notification_type STRING, sent_at TIMESTAMP, opened_at TIMESTAMP"
)
QUEUE = ddl("assignment_id STRING, submitted BIGINT, graded BIGINT, depth BIGINT, updated TIMESTAMP")
QUEUE_STATE = ddl("submitted BIGINT, graded BIGINT, updated TIMESTAMP")


def _start(
    rows: DataFrame, name: str, mode: str, write: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None
) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = rows.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_sessions(
    raw: DataFrame, path: str, checkpoint: str, gap: str = "30 minutes", watermark: str = "1 minute",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Sessions as they close: once the watermark has passed their last event by `gap`."""
    events = speed.decode_stream(raw).withWatermark("timestamp", watermark)
    sessions = realtime.session_activity(events, gap)
    write = lambda rows, batch: write_batch(rows, path, batch, "window_start")
    return _start(sessions, "session_activity", "append", write, checkpoint, interval)


def start_reads(
    raw: DataFrame, path: str, checkpoint: str, within: str = "1 day", watermark: str = "1 minute",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Notifications with the time they were opened, or without once that can no longer happen.

    Both sides' state is bounded by the watermark and `within`.
    """
    events = decode_topic(raw.where(F.col("topic") == TOPICS["notification"]), "notification")
    sent, opened = realtime.reading_sides(events.where(F.col("timestamp_parsed").isNotNull()), "timestamp_parsed")
    sent, opened = sent.withWatermark("sent_at", watermark), opened.withWatermark("opened_at", watermark)
    read = realtime.reads(sent, opened, F.expr(f"INTERVAL {within}"))
    write = lambda rows, batch: write_batch(rows, path, batch, "sent_at")
    return _start(read, "notification_reads", "append", write, checkpoint, interval)


def start_popular_videos(
    raw: DataFrame, path: str, checkpoint: str, length: str = "1 minute", watermark: str = "1 minute",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Sketches of the most viewed videos, a row per closed window; `popular_videos` reads them."""
    events = speed.decode_stream(raw).withWatermark("timestamp", watermark)
    sketches = realtime.popularity_sketches(events, length)
    write = lambda rows, batch: write_batch(rows, path, batch, "window_start")
    return _start(sketches, "popular_videos", "append", write, checkpoint, interval)


def grading_queue(ttl_ms: int) -> Callable:
    """Works submitted and graded per assignment, forgotten once the watermark is `ttl_ms` past the last.

    Event time, not the clock, so that a replay forgets what the first run forgot.
    """

    def count(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        submitted, graded, updated = state.get if state.exists else (0, 0, None)
        for part in rows:
            submitted += int(part["submitted"].sum())
            graded += int(part["graded"].sum())
            times = [pd.Timestamp(t) for t in (updated, part["at"].max()) if not pd.isnull(t)]
            updated = max(times, default=None)
        state.update((submitted, graded, None if updated is None else updated.to_pydatetime()))
        last = int(updated.timestamp() * 1000) if updated is not None else 0
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + ttl_ms)
        yield pd.DataFrame({
            "assignment_id": [key[0]], "submitted": [submitted], "graded": [graded],
            "depth": [submitted - graded], "updated": pd.Series([updated], dtype="datetime64[us]"),
        })

    return count


def queue_changes(events: DataFrame) -> DataFrame:
    """Submissions and gradings of assignments at a known time."""
    kind = F.col("event_type")
    both = events.where(kind.isin("SUBMIT_ASSIGNMENT", "GRADE_ASSIGNMENT") & F.col("assignment_id").isNotNull())
    one = lambda name: (kind == name).cast("bigint")
    return both.select(
        "assignment_id", one("SUBMIT_ASSIGNMENT").alias("submitted"), one("GRADE_ASSIGNMENT").alias("graded"),
        F.col("timestamp_parsed").alias("at"),
    ).where(F.col("at").isNotNull())


def start_grading_queue(
    raw: DataFrame, path: str, checkpoint: str, ttl_hours: float = 24 * 30, watermark: str = "1 minute",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Depth of each assignment's grading queue: a row per assignment that a micro-batch touched.

    An assignment is forgotten `ttl_hours` after its last change, so state does not grow
    with all assignments ever.
    """
    events = decode_topic(raw.where(F.col("topic") == TOPICS["assessment"]), "assessment")
    changes = queue_changes(events).withWatermark("at", watermark)
    rows = changes.groupBy("assignment_id").applyInPandasWithState(
        grading_queue(int(ttl_hours * 3_600_000)), QUEUE, QUEUE_STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
    write = lambda rows, batch: write_batch(rows, path, batch, "updated")
    return _start(rows, "grading_queue", "update", write, checkpoint, interval)


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """The newest depth of each assignment's queue."""
    rows = read_batches(spark, path, QUEUE)
    return newest(rows.drop("day"), ["assignment_id"], ["batch_id"]).select(*QUEUE.names)
