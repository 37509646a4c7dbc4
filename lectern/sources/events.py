"""Master dataset: reading raw topics and decoding events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.columns import event_time
from lectern.schemas import EVENT, RAW, TOPICS
from lectern.sources import layout, versions
from lectern.sources.listing import read_or_empty


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """Raw records of one topic; empty if the topic or the whole root is missing.

    Reads the topic's own directory, so the files of other topics are not even
    listed.
    """
    root = root.rstrip("/")
    path = f"{root}/topic={topic}"
    if not versions.exists(spark, layout.log_path(path)):
        return read_or_empty(spark, path, RAW, base=root)
    dated = T.StructType([*RAW.fields, *layout.PARTITIONS.fields])
    return layout.live(spark, path, read_or_empty(spark, path, dated, base=root)).select(*RAW.names)


def raw_envelope(broker: DataFrame) -> DataFrame:
    """Broker records (binary key and value) as text, the shape that is stored."""
    return broker.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("topic"),
        F.col("timestamp"),
    )


def decode(raw: DataFrame, schema: T.StructType, *kept: Column | str) -> DataFrame:
    """JSON text to typed columns, after the raw columns in `kept`.

    Malformed text keeps its row, with NULL fields.

    `inline` makes the decode a plan node of its own. With a plain projection
    Catalyst copies `from_json` into every filter it pushes below it and parses
    each record once per copy.
    """
    return raw.select(*kept, F.inline(F.array(F.from_json(F.col("value"), schema))))


def decode_topic(raw: DataFrame, name: str, *kept: Column | str) -> DataFrame:
    """Typed events of a topic with their event time parsed."""
    return decode(raw, EVENT[name], *kept).withColumn("timestamp_parsed", event_time())


def encode(events: DataFrame, key: str, topic: Column, broker_time: Column) -> DataFrame:
    """Events as keyed JSON records, ready for a broker or the master dataset.

    NULL fields are left out of the JSON text.
    """
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
        topic.alias("topic"),
        broker_time.alias("timestamp"),
    )
