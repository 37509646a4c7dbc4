"""Batch views over profile changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import day, day_as_text, of_type


def update_frequency(profile: DataFrame) -> DataFrame:
    return (
        of_type(profile, "UPDATE_PROFILE")
        .groupBy("user_id")
        .agg(
            F.count("user_id").alias("total_profile_updates"),
            F.min("timestamp_parsed").alias("first_update"),
            F.max("timestamp_parsed").alias("last_update"),
        )
    )


def field_changes(profile: DataFrame) -> DataFrame:
    return (
        of_type(profile, "UPDATE_PROFILE")
        .groupBy("field_name")
        .agg(
            F.count("user_id").alias("total_updates"),
            F.countDistinct("user_id").alias("unique_users_updating"),
        )
    )


def avatar_changes(profile: DataFrame) -> DataFrame:
    return (
        of_type(profile, "CHANGE_AVATAR")
        .groupBy("user_id")
        .agg(
            F.count("user_id").alias("avatar_changes_count"),
            F.min("timestamp_parsed").alias("first_change"),
            F.max("timestamp_parsed").alias("last_change"),
        )
    )


def daily_activity(profile: DataFrame) -> DataFrame:
    return day_as_text(
        profile.groupBy(day(), "event_type").agg(
            F.countDistinct("user_id").alias("unique_users"),
            F.count("user_id").alias("event_count"),
        )
    )
