"""Batch views over video watching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import day, day_as_text, hours, of_type, percent
from lectern.functions.keyed import lookup_join

SECONDS = "watch_duration_seconds"


def total_watch_time(video: DataFrame) -> DataFrame:
    total = F.sum(SECONDS)
    return (
        of_type(video, "VIDEO_WATCHED")
        .groupBy("user_id", "video_id", "course_id")
        .agg(
            total.alias("total_watch_seconds"),
            F.count("session_id").alias("total_watch_sessions"),
            F.avg(SECONDS).alias("avg_watch_duration_seconds"),
            F.max(SECONDS).alias("longest_session_seconds"),
            F.min(SECONDS).alias("shortest_session_seconds"),
            (total / 60).alias("total_watch_minutes"),
            hours(total).alias("total_watch_hours"),
        )
    )


def student_engagement(video: DataFrame) -> DataFrame:
    total = F.sum(SECONDS)
    return (
        of_type(video, "VIDEO_WATCHED")
        .groupBy("user_id", "course_id")
        .agg(
            F.countDistinct("video_id").alias("unique_videos_watched"),
            total.alias("total_watch_seconds"),
            F.count("video_id").alias("total_video_events"),
            F.avg(SECONDS).alias("avg_watch_duration_seconds"),
            hours(total).alias("total_watch_hours"),
        )
    )


def popularity(video: DataFrame) -> DataFrame:
    total = F.sum(SECONDS)
    return (
        of_type(video, "VIDEO_WATCHED")
        .groupBy("video_id", "course_id")
        .agg(
            F.countDistinct("user_id").alias("unique_viewers"),
            total.alias("total_views_seconds"),
            F.count("user_id").alias("total_view_events"),
            F.avg(SECONDS).alias("avg_view_duration_seconds"),
            hours(total).alias("total_views_hours"),
        )
    )


def daily_engagement(video: DataFrame) -> DataFrame:
    total = F.sum(SECONDS)
    return day_as_text(
        of_type(video, "VIDEO_WATCHED")
        .groupBy(day(), "course_id")
        .agg(
            F.countDistinct("user_id").alias("active_video_watchers"),
            F.countDistinct("video_id").alias("unique_videos_watched"),
            total.alias("total_watch_seconds"),
            F.count("user_id").alias("total_watch_events"),
            hours(total).alias("total_watch_hours"),
        )
    )


def course_metrics(video: DataFrame) -> DataFrame:
    total = F.sum(SECONDS)
    return (
        of_type(video, "VIDEO_WATCHED")
        .groupBy("course_id")
        .agg(
            F.countDistinct("user_id").alias("total_students_watching"),
            F.countDistinct("video_id").alias("total_videos_in_course"),
            total.alias("total_course_watch_seconds"),
            hours(total).alias("total_course_watch_hours"),
        )
    )


def student_course_summary(video: DataFrame) -> DataFrame:
    """Per student and course, with the share of the course's videos the student saw."""
    watched = of_type(video, "VIDEO_WATCHED")
    total = F.sum(SECONDS)
    per_student = watched.groupBy("user_id", "course_id").agg(
        F.countDistinct("video_id").alias("videos_watched_count"),
        total.alias("total_watch_seconds"),
        F.count("session_id").alias("total_sessions"),
        hours(total).alias("total_watch_hours"),
    )
    per_course = watched.groupBy("course_id").agg(
        F.countDistinct("video_id").alias("total_videos_in_course")
    )
    coverage = percent(F.col("videos_watched_count"), F.col("total_videos_in_course"))
    return lookup_join(per_student, per_course, ["course_id"], "left").withColumn(
        "video_coverage_percentage", coverage
    )


def drop_off_indicators(video: DataFrame) -> DataFrame:
    """Average watch time per video in three bands; an unknown average is not a risk."""
    average = F.avg(SECONDS)
    return (
        of_type(video, "VIDEO_WATCHED")
        .groupBy("video_id", "course_id")
        .agg(
            F.count("user_id").alias("total_views"),
            average.alias("avg_watch_duration"),
            F.min(SECONDS).alias("min_watch_duration"),
            F.countDistinct("user_id").alias("unique_viewers"),
            F.when(average < 60, "High Risk")
            .when(average < 180, "Medium Risk")
            .otherwise("Good Engagement")
            .alias("potential_drop_off"),
        )
    )
