"""Batch views over authentication events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import count_if, day, day_as_text, of_type
from lectern.functions.keyed import (
    lookup_join,
    pair_count,
    pair_max,
    pair_min,
    pair_seconds,
    pair_stats,
    pair_timed,
)


def daily_active_users(auth: DataFrame) -> DataFrame:
    return day_as_text(
        of_type(auth, "LOGIN")
        .groupBy(day())
        .agg(
            F.countDistinct("user_id").alias("daily_active_users"),
            F.countDistinct("session_id").alias("total_sessions"),
        )
    )


def hourly_login_patterns(auth: DataFrame) -> DataFrame:
    return day_as_text(
        of_type(auth, "LOGIN")
        .groupBy(day(), F.hour("timestamp_parsed").alias("hour"))
        .agg(F.count("user_id").alias("login_count"))
    )


def user_session_metrics(auth: DataFrame) -> DataFrame:
    """Durations over every login/logout pair that shares a session id.

    Negative durations count. Both sides are reduced per session first, so a
    session with many logins and logouts costs rows, not rows squared.
    """
    logins = (
        of_type(auth, "LOGIN")
        .where(F.col("session_id").isNotNull())
        .groupBy("session_id", "user_id")
        .agg(*pair_stats("l", "timestamp_parsed"))
    )
    logouts = (
        of_type(auth, "LOGOUT")
        .where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(*pair_stats("r", "timestamp_parsed"))
    )
    per_user = (
        lookup_join(logins, logouts, ["session_id"], "inner")
        .groupBy("user_id")
        .agg(
            pair_count().alias("total_sessions"),
            pair_timed().alias("timed"),
            pair_seconds().cast("double").alias("seconds"),
            pair_min().alias("shortest"),
            pair_max().alias("longest"),
        )
    )
    return per_user.select(
        "user_id",
        "total_sessions",
        F.try_divide("seconds", F.col("timed") * 60).alias("avg_session_duration_minutes"),
        (F.col("shortest") / 60).alias("min_session_duration_minutes"),
        (F.col("longest") / 60).alias("max_session_duration_minutes"),
        (F.col("seconds") / 60).alias("total_time_online_minutes"),
    )


def user_activity_summary(auth: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return auth.groupBy("user_id", "role").agg(
        count_if(kind == "LOGIN").alias("total_logins"),
        count_if(kind == "LOGOUT").alias("total_logouts"),
        F.min("timestamp_parsed").alias("first_activity"),
        F.max("timestamp_parsed").alias("last_activity"),
        F.countDistinct("session_id").alias("unique_sessions"),
    )


def registration_analytics(auth: DataFrame) -> DataFrame:
    return day_as_text(
        of_type(auth, "SIGNUP")
        .groupBy(day(), "registration_source", "role")
        .agg(F.count("user_id").alias("new_signups"))
    )
