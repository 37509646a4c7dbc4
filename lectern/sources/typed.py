"""The typed layer: each topic's events decoded once into columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.schemas import EVENT, RAW, TOPICS
from lectern.sources import layout, manifest, versions
from lectern.sources.batches import read_batches, replace_directories
from lectern.sources.events import decode_topic, read_topic


def typed_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def typed_schema(name: str) -> T.StructType:
    return T.StructType([*EVENT[name].fields, T.StructField("timestamp_parsed", T.TimestampType())])


def write_typed(spark: SparkSession, raw_root: str, typed_root: str, name: str) -> int:
    """Decode one topic once into columnar Parquet; returns the rows written.

    Each task orders its rows by event type, without a shuffle. Pages and row
    groups then hold few types each, so a view's `event_type` filter skips the
    others. The row count is observed during the write instead of costing a
    second scan.
    """
    seen = Observation(f"typed_{name}")
    events = decode_topic(read_topic(spark, raw_root, TOPICS[name]), name)
    rows = events.observe(seen, F.count(F.lit(1)).alias("rows")).sortWithinPartitions("event_type")
    versions.replace(spark, typed_path(typed_root, name), rows.write.parquet)
    return seen.get["rows"]


def days_path(typed_root: str, name: str) -> str:
    return f"{typed_root.rstrip('/')}/days/{name}"


def days_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField("arrived", T.TimestampType()), *typed_schema(name).fields])


def directories_path(typed_root: str, name: str) -> str:
    return f"{typed_root.rstrip('/')}/directories/{name}"


def update_typed(spark: SparkSession, raw_root: str, typed_root: str, name: str) -> int:
    """Decode the directories of a topic that changed since the last call; returns the rows written.

    The table is laid out as the master dataset is, by day of arrival and batch, and each
    of its directories is made from the master's directory of the same name. A batch that
    was written again, or was seen half-way before, is decoded again and replaces what
    was there; a directory that the master has no longer goes. `arrived` is the broker's
    time of each event.
    """
    source, path = f"{raw_root.rstrip('/')}/topic={TOPICS[name]}", days_path(typed_root, name)
    known, listed = directories_path(typed_root, name), f"{typed_root.rstrip('/')}/listed/{name}"
    manifest.write(layout.live(spark, source, manifest.directories(spark, source)), listed)
    now, before = (manifest.read(spark, p, manifest.DIRECTORIES) for p in (listed, known))
    new, lost = manifest.changed(now, before), manifest.gone(now, before)
    rows = 0
    days = [r["day"] for r in new.select("day").distinct().collect()]
    if days:
        parts = T.StructType([*RAW.fields, *layout.PARTITIONS.fields])
        raw = spark.read.schema(parts).option("basePath", raw_root).parquet(source).where(manifest.on_days(days))
        raw = raw.join(new, manifest.same(raw, new, ["day", "batch_id"]), "left_semi")
        seen = Observation(f"typed_{name}")
        events = decode_topic(raw.withColumnRenamed("timestamp", "arrived"), name, "day", "batch_id", "arrived")
        events = events.observe(seen, F.count(F.lit(1)).alias("rows"))
        replace_directories(events.hint("rebalance", "day"), path, "day", "batch_id")
        rows = seen.get["rows"]
    manifest.drop_directories(spark, path, lost)
    manifest.write(now, known)
    return rows


def read_days(spark: SparkSession, typed_root: str, name: str) -> DataFrame:
    """The events that `update_typed` has decoded so far, with `arrived`, `day` and `batch_id`."""
    return read_batches(spark, days_path(typed_root, name), days_schema(name))


def read_typed(spark: SparkSession, typed_root: str, name: str) -> DataFrame:
    return versions.read(spark, typed_path(typed_root, name), typed_schema(name))
