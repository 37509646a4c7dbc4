"""The realtime side of the merged views: each micro-batch leaves its rollups.

Nothing is kept between micro-batches and nothing is late: a rollup of a part can be
added to any others, so there is no watermark to drop events behind.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lectern.schemas import TOPICS
from lectern.sources.rollups import write_stream_batch


def start(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    interval: str | None = "30 seconds",
    topics: Collection[str] = tuple(TOPICS),
) -> StreamingQuery:
    """Roll up a stream of raw records. `interval=None` processes what is there and stops."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        raw.writeStream.queryName("-".join(["rollups", *(topics if set(topics) != set(TOPICS) else ())]))
        .foreachBatch(lambda rows, batch: write_stream_batch(rows, root, batch, topics))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
