"""The three streaming views, from raw records to stored windows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lectern.operators import speed
from lectern.sources.batches import write_batch
from lectern.sources.keyed import conform_speed, upsert

Write = Callable[[DataFrame, int], None]

VIEWS: dict[str, Callable[..., DataFrame]] = {
    "active_users": speed.active_users,
    "course_popularity": speed.course_popularity,
    "video_engagement": speed.video_engagement,
}


@dataclass(frozen=True)
class Settings:
    """Window, lateness and trigger of the speed layer.

    `interval=None` processes what is there and stops.
    """

    root: str
    checkpoints: str
    watermark: str = "1 minute"
    length: str = speed.WINDOWS["micro"]
    slide: str = "30 seconds"
    interval: str | None = "30 seconds"


def view_of(name: str, raw: DataFrame, settings: Settings) -> DataFrame:
    """A view over a stream of raw records, with late events dropped by watermark."""
    events = speed.decode_stream(raw).withWatermark("timestamp", settings.watermark)
    if name == "active_users":
        return speed.counted_users(events, settings.length, settings.slide)
    return VIEWS[name](events, settings.length)


def dual_write(rows: DataFrame, batch_id: int, writes: list[Write]) -> None:
    """Give one micro-batch to several sinks, computing it once.

    A failing sink fails the batch: Spark then runs it again under the same id,
    and both sinks replace what the first attempt left.
    """
    rows.persist()
    try:
        for write in writes:
            write(rows, batch_id)
    finally:
        rows.unpersist()


def sinks(name: str, settings: Settings) -> list[Write]:
    """Append-style files and a keyed table for the view."""
    root = settings.root.rstrip("/")
    return [
        lambda rows, batch: write_batch(rows, f"{root}/views/{name}", batch, "start"),
        lambda rows, batch: upsert(conform_speed(rows, name), f"{root}/keyed/{name}", name, batch),
    ]


def start(
    name: str, raw: DataFrame, settings: Settings, writes: list[Write] | None = None
) -> StreamingQuery:
    targets = writes if writes is not None else sinks(name, settings)
    trigger = (
        {"processingTime": settings.interval} if settings.interval else {"availableNow": True}
    )
    return (
        view_of(name, raw, settings)
        .writeStream.queryName(f"speed_{name}")
        .outputMode("append")
        .foreachBatch(lambda rows, batch: dual_write(rows, batch, targets))
        .option("checkpointLocation", f"{settings.checkpoints.rstrip('/')}/{name}")
        .trigger(**trigger)
        .start()
    )


def start_all(raw: DataFrame, settings: Settings) -> list[StreamingQuery]:
    return [start(name, raw, settings) for name in VIEWS]


def run(spark: SparkSession, raw: DataFrame, settings: Settings) -> None:
    """Run the three views side by side.

    With an interval, until one of them ends, as an error or by being stopped.
    Without one, until each has worked off its input.
    """
    queries = start_all(raw, settings)
    if settings.interval:
        spark.streams.awaitAnyTermination()
        return
    for query in queries:
        query.awaitTermination()
