"""Windowed views. The same functions run on streams and on batch frames.

Input: decoded events whose `timestamp` is the parsed event time; a stream also
carries its watermark. Rows without an event time fall in no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import event_time
from lectern.schemas import STREAM_EVENT
from lectern.sources.events import decode

# Named window lengths.
WINDOWS = {"micro": "1 minute", "short": "5 minutes", "medium": "15 minutes", "long": "1 hour"}


def decode_stream(raw: DataFrame) -> DataFrame:
    """Raw records of any topic to the columns the windowed views read."""
    return (
        decode(raw, STREAM_EVENT)
        .withColumn("timestamp", event_time())
        .withColumn("processing_time", F.current_timestamp())
    )


def _per_window(events: DataFrame, window: Column, keys: list[str], measure: Column) -> DataFrame:
    name = "_window"
    counted = events.groupBy(window.alias(name), *keys).agg(measure)
    measures = [c for c in counted.columns if c not in (name, *keys)]
    return counted.select(
        F.col(f"{name}.start").alias("start"), F.col(f"{name}.end").alias("end"), *keys, *measures
    )


def active_users(
    events: DataFrame, length: str = "1 minute", slide: str = "30 seconds", exact: bool = False
) -> DataFrame:
    """Distinct users logging in per sliding window.

    Approximate by default, which keeps a fixed-size sketch per window as state.
    `exact` is for batch frames; streams cannot aggregate distinct values, and count
    them by `counted_users`.
    """
    users = F.countDistinct("user_id") if exact else F.approx_count_distinct("user_id")
    logins = events.where(F.col("event_type") == "LOGIN")
    return _per_window(
        logins, F.window("timestamp", length, slide), [], users.alias("active_users")
    )


def counted_users(events: DataFrame, length: str = "1 minute", slide: str = "30 seconds") -> DataFrame:
    """What `active_users` counts, exactly and on streams too, in two aggregations.

    State is a row per user and open window. A window is counted when the first
    aggregation has closed it, in the same micro-batch.
    """
    logins = events.where(F.col("event_type") == "LOGIN")
    window = F.window("timestamp", length, slide).alias("_window")
    users = logins.groupBy(window, "user_id").agg(F.count(F.lit(1)).alias("logins"))
    counted = users.groupBy("_window").agg(F.count("user_id").alias("active_users"))
    return counted.select(F.col("_window.start").alias("start"), F.col("_window.end").alias("end"), "active_users")


def course_popularity(events: DataFrame, length: str = "1 minute") -> DataFrame:
    """Events of any kind that name a course, per tumbling window and course."""
    return _per_window(
        events.where(F.col("course_id").isNotNull()),
        F.window("timestamp", length),
        ["course_id"],
        F.count(F.lit(1)).alias("interactions"),
    )


def video_engagement(events: DataFrame, length: str = "1 minute") -> DataFrame:
    """Video watch events per tumbling window and video."""
    watched = (F.col("event_category") == "VIDEO") & (F.col("event_type") == "VIDEO_WATCHED")
    return _per_window(
        events.where(watched),
        F.window("timestamp", length),
        ["video_id"],
        F.count(F.lit(1)).alias("views"),
    )


def closed_windows(view: DataFrame, rows: DataFrame, delay: str = "1 minute") -> DataFrame:
    """The windows an append-mode stream has emitted when its input is worked off.

    `rows` are the events the view counts, not all events: Catalyst moves a view's
    filter below the watermark, which therefore follows the filtered rows.
    """
    watermark = rows.agg(F.max("timestamp") - F.expr(f"INTERVAL {delay}")).scalar()
    return view.where(F.col("end") <= watermark)
