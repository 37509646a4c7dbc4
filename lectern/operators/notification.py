"""Batch views over notification delivery and clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import count_if, day, day_as_text, of_type, percent, unmatched_null

SENT = "NOTIFICATION_SENT"
CLICKED = "NOTIFICATION_CLICKED"


def delivery_stats(notification: DataFrame) -> DataFrame:
    return (
        of_type(notification, SENT)
        .groupBy("notification_type")
        .agg(
            F.count("user_id").alias("total_sent"),
            F.countDistinct("user_id").alias("unique_recipients"),
        )
    )


def engagement(notification: DataFrame) -> DataFrame:
    return (
        of_type(notification, CLICKED)
        .groupBy("user_id", "notification_type")
        .agg(F.count("notification_id").alias("notifications_clicked"))
    )


def _clicked_of_sent(notification, keys, sent_name, clicked_name, rate_name) -> DataFrame:
    """Clicks beside deliveries for every key that had a delivery.

    A left join of two aggregates on equal keys, done as one GROUP BY.
    """
    kind = F.col("event_type")
    counted = (
        of_type(notification, SENT, CLICKED)
        .groupBy(*keys, unmatched_null(keys, kind))
        .agg(
            F.count(F.when(kind == SENT, F.col("notification_id"))).alias(sent_name),
            F.count(F.when(kind == CLICKED, F.col("notification_id"))).alias(clicked_name),
            count_if(kind == SENT).alias("_sent_rows"),
        )
        .where(F.col("_sent_rows") > 0)
    )
    return counted.select(
        *keys,
        sent_name,
        clicked_name,
        percent(F.col(clicked_name), F.col(sent_name)).alias(rate_name),
    )


def click_through_rate(notification: DataFrame) -> DataFrame:
    return _clicked_of_sent(
        notification,
        ["notification_type"],
        "total_sent",
        "total_clicked",
        "click_through_rate",
    )


def user_preferences(notification: DataFrame) -> DataFrame:
    return _clicked_of_sent(
        notification,
        ["user_id", "notification_type"],
        "notifications_received",
        "notifications_clicked",
        "engagement_rate",
    )


def daily_activity(notification: DataFrame) -> DataFrame:
    return day_as_text(
        notification.groupBy(day(), "event_type", "notification_type").agg(
            F.countDistinct("user_id").alias("unique_users"),
            F.count("notification_id").alias("event_count"),
        )
    )


def user_summary(notification: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    received, clicked = count_if(kind == SENT), count_if(kind == CLICKED)
    return notification.groupBy("user_id").agg(
        received.alias("total_received"),
        clicked.alias("total_clicked"),
        percent(clicked, received).alias("overall_engagement_rate"),
    )
