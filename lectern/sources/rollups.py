"""Stored rollups: of the batch by day of arrival, of the stream by day and micro-batch.

Both count the same events, the batch from the master dataset and the stream as they
come. An event belongs to the day on which the broker took it, whatever its own time
says, so late events need no special care and a cut between two days of arrival parts
all events into two: up to the horizon the batch counts, from it on the stream does.
"""

from __future__ import annotations

import datetime
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.rollups import SKETCHED, roll, rollup_schema, sketch
from lectern.schemas import TOPICS, ddl
from lectern.sources import manifest, versions
from lectern.sources.batches import day_number, read_batches, replace_directories
from lectern.sources.events import decode_topic
from lectern.sources.listing import read_or_empty
from lectern.sources.typed import directories_path, read_days

DAY = T.StructField("day", T.LongType())
HORIZON = ddl("day BIGINT")


def _path(root: str, kind: str, topic: str = "") -> str:
    return "/".join(p for p in (root.rstrip("/"), kind, topic) if p)


def _sketch_schema(topic: str) -> T.StructType:
    kinds = {f.name: f for f in [*rollup_schema(topic).fields, T.StructField("date", T.DateType())]}
    users = [T.StructField("users", T.BinaryType()), T.StructField("rows", T.LongType())]
    return T.StructType([*[kinds[c] for c in SKETCHED], *users, DAY])


def _dated(rollup: DataFrame) -> DataFrame:
    return rollup if "date" in rollup.columns else rollup.withColumn("date", F.to_date("hour_start"))


def update(spark: SparkSession, typed_root: str, root: str, topic: str) -> list[int | None]:
    """Roll up the days whose typed directories changed since the last call; returns them.

    A day's rollup and sketches are replaced; days that are gone are removed. The
    manifest of days is written last, so a call that dies is made up for by the next.
    """
    done = _path(root, "days", topic)
    now = manifest.days(manifest.read(spark, directories_path(typed_root, topic), manifest.DIRECTORIES))
    before = manifest.read(spark, done, manifest.DAYS)
    days = [r["day"] for r in manifest.changed(now, before).collect()]
    if days:
        events = read_days(spark, typed_root, topic).where(manifest.on_days(days))
        replace_directories(roll(events, topic, ["day"]).hint("rebalance", "day"), _path(root, "rollups", topic), "day")
        rolled = read(spark, root, topic).where(manifest.on_days(days))
        replace_directories(sketch(_dated(rolled), ["day"]).hint("rebalance", "day"), _path(root, "sketches", topic), "day")
    lost = manifest.gone(now, before)
    for kind in ("rollups", "sketches"):
        manifest.drop_directories(spark, _path(root, kind, topic), lost)
    manifest.write(now, done)
    return days


def read(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The batch's rollup of a topic, with the `day` of arrival."""
    schema = T.StructType([*rollup_schema(topic).fields, DAY])
    return read_or_empty(spark, _path(root, "rollups", topic), schema)


def read_sketches(spark: SparkSession, root: str, topic: str) -> DataFrame:
    return read_or_empty(spark, _path(root, "sketches", topic), _sketch_schema(topic))


def set_horizon(spark: SparkSession, root: str, topics: list[str]) -> None:
    """The newest day of arrival that the batch has seen; it may still be open."""
    newest = [
        manifest.read(spark, _path(root, "days", t), manifest.DAYS).agg(F.max("day")).first()[0] for t in topics
    ]
    found = [d for d in newest if d is not None]
    rows = spark.createDataFrame([(max(found),)] if found else [], HORIZON)
    versions.replace(spark, _path(root, "horizon"), rows.write.parquet)


def horizon(spark: SparkSession, root: str) -> int | None:
    """The first day of arrival that the stream is to count, as days since 1970."""
    row = versions.read(spark, _path(root, "horizon"), HORIZON).first()
    return row["day"] if row else None


def write_stream_batch(
    rows: DataFrame, root: str, batch_id: int, topics: Collection[str] = tuple(TOPICS)
) -> None:
    """Roll up one micro-batch of raw records, each of `topics` below its own directory.

    Only `day=/batch_id=` directories of this batch are replaced, so it can run again.
    """
    if len(topics) > 1:  # else the records are read once anyway
        rows.persist()
    try:
        for topic in topics:
            arrived = rows.where(F.col("topic") == TOPICS[topic]).withColumn("day", day_number(F.col("timestamp")))
            arrived = arrived.where(F.col("day").isNotNull())  # counted by the batch, whatever the horizon
            rolled = roll(decode_topic(arrived, topic, "day"), topic, ["day"])
            rolled = rolled.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            path = _path(root, "rollups", topic)
            replace_directories(rolled.hint("rebalance", "day"), path, "day", "batch_id")
    finally:
        rows.unpersist()


def read_stream(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The stream's rollups of a topic, with `day` of arrival and `batch_id`."""
    return read_batches(spark, _path(root, "rollups", topic), rollup_schema(topic))


def _day(cut: int | datetime.date) -> int:
    return cut if isinstance(cut, int) else (cut - datetime.date(1970, 1, 1)).days


def merged(
    spark: SparkSession, batch_root: str, stream_root: str, topic: str, cut: int | datetime.date | None = None
) -> DataFrame:
    """A topic's rollup over all events, each counted once: by the batch or by the stream.

    `cut` is the first day of arrival that the stream counts, by default the horizon of
    the last incremental run; without one the stream counts everything that has a time
    of arrival. Both sides skip the directories of the other's days.
    """
    cut = horizon(spark, batch_root) if cut is None else _day(cut)
    batch, stream = read(spark, batch_root, topic), read_stream(spark, stream_root, topic)
    columns = rollup_schema(topic).names
    if cut is None:
        return batch.where(F.col("day").isNull()).select(*columns).unionByName(stream.select(*columns))
    batch = batch.where(F.col("day").isNull() | (F.col("day") < cut))
    return batch.select(*columns).unionByName(stream.where(F.col("day") >= cut).select(*columns))


def merged_sketches(
    spark: SparkSession, batch_root: str, stream_root: str, topic: str, cut: int | datetime.date
) -> DataFrame:
    """Sketches of all events: the batch's stored ones, and one made of the stream's rollups."""
    cut = _day(cut)
    columns = [f.name for f in _sketch_schema(topic).fields if f.name != "day"]
    batch = read_sketches(spark, batch_root, topic).where(F.col("day").isNull() | (F.col("day") < cut))
    stream = read_stream(spark, stream_root, topic).where(F.col("day") >= cut)
    return batch.select(*columns).unionByName(sketch(_dated(stream)).select(*columns))


def trim(spark: SparkSession, stream_root: str, cut: int) -> None:
    """Remove the stream's rollups of the days before `cut`, which the batch counts."""
    for topic in TOPICS:
        days = read_stream(spark, stream_root, topic).select("day").where(F.col("day") < cut).distinct()
        manifest.drop_directories(spark, _path(stream_root, "rollups", topic), days)
