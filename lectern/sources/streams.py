"""Streaming sources and sinks around the raw record shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from lectern.schemas import RAW, TOPICS
from lectern.sources.batches import write_batch
from lectern.sources.compaction import committed_batch, compact
from lectern.sources.events import raw_envelope


def kafka_options(
    bootstrap_servers: str,
    topics: list[str] | None = None,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options: all six topics unless told otherwise.

    Streaming views start at "latest", the master dataset at "earliest". Offsets that
    the broker no longer has fail the query, unless `fail_on_data_loss` is off.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics or TOPICS.values()),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs the public spark-sql-kafka package on the class path."""
    return raw_envelope(spark.readStream.format("kafka").options(**options).load())


def read_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw records arriving as Parquet files, in the shape `read_kafka` gives.

    All files that have arrived are one batch, unless `max_files_per_trigger` is given:
    where batches end decides what the watermark calls late.
    """
    reader = spark.readStream.schema(RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*RAW.names)


def master_sink(
    raw: DataFrame, path: str, checkpoint: str, interval: str | None = "30 seconds"
) -> DataStreamWriter:
    """Append raw records to the master dataset: topic=, day= of the broker time, batch_id=.

    A batch that is run again replaces what its first attempt left, so readers of a
    topic's directory need no log of committed files. `interval=None` processes what is
    there and stops.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        raw.writeStream.foreachBatch(
            lambda rows, batch: write_batch(rows, path, batch, "timestamp", "topic")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


def deduplicated(raw: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A stream's records once each, though parts of it are sent again within `delay`.

    Records sent again keep their broker time. State holds a record only until the
    watermark has passed it by `delay`; the batch form is `distinct`.
    """
    return raw.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(RAW.names)


def compact_master(spark: SparkSession, root: str, checkpoint: str, before_day: int) -> dict[str, list[int]]:
    """Put the batches of each topic's closed days together; returns the days.

    Only batches that the ingesting stream has finished, by its checkpoint, are touched.
    """
    done = committed_batch(spark, checkpoint)
    kept = RAW.fields[:2] + RAW.fields[3:]  # the topic is a directory
    return {
        topic: compact(spark, f"{root.rstrip('/')}/topic={topic}", T.StructType(kept), before_day, done)
        for topic in TOPICS.values()
    }
