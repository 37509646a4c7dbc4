"""Batch views that combine several topics. Inputs hold student events only.

Where the inputs meet on equal keys, the topics are unioned as narrow labelled
rows and grouped once. That replaces one shuffle per input plus the joins by a
single shuffle with map-side combine, and no join input can be skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import count_if, of_type, unmatched_null
from lectern.functions.keyed import lookup_join

ENROLLED = "COURSE_ENROLLED"
DOWNLOADED = "DOWNLOAD_MATERIAL"


def students_only(events: DataFrame) -> DataFrame:
    return events.where(F.col("role") == "student")


def _labelled(label: str, events: DataFrame, *columns) -> DataFrame:
    return events.select(F.lit(label).alias("_kind"), *columns)


def _stack(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def course_overview(course: DataFrame, video: DataFrame) -> DataFrame:
    """Courses with at least one enrolment, with their video and download counts."""
    kind = F.col("_kind")
    rows = _stack(
        _labelled("enrolled", of_type(course, ENROLLED), "course_id", "user_id"),
        _labelled("video", video, "course_id"),
        _labelled("download", of_type(course, DOWNLOADED), "course_id"),
    )
    return (
        rows.groupBy("course_id", unmatched_null(["course_id"], kind))
        .agg(
            F.countDistinct("user_id").alias("total_enrolled_students"),
            count_if(kind == "video").alias("total_videos_watched"),
            count_if(kind == "download").alias("total_materials_downloaded"),
            count_if(kind == "enrolled").alias("_enrolments"),
        )
        .where(F.col("_enrolments") > 0)
        .drop("_null_side", "_enrolments")
    )


def student_overview(
    course: DataFrame, video: DataFrame, assessment: DataFrame, auth: DataFrame
) -> DataFrame:
    """Students with at least one enrolment, with their activity in four topics."""
    kind = F.col("_kind")
    rows = _stack(
        _labelled("enrolled", of_type(course, ENROLLED), "user_id", "course_id"),
        _labelled("video", video, "user_id"),
        _labelled("submit", of_type(assessment, "SUBMIT_ASSIGNMENT"), "user_id", "score"),
        _labelled("login", of_type(auth, "LOGIN"), "user_id"),
    )
    counted = (
        rows.groupBy("user_id", unmatched_null(["user_id"], kind))
        .agg(
            F.countDistinct("course_id").alias("total_courses_enrolled"),
            count_if(kind == "video").alias("total_videos_watched"),
            count_if(kind == "submit").alias("total_assignments_submitted"),
            F.coalesce(F.avg("score"), F.lit(0.0)).alias("avg_assignment_score"),
            count_if(kind == "login").alias("total_logins"),
            count_if(kind == "enrolled").alias("_enrolments"),
        )
        .where(F.col("_enrolments") > 0)
    )
    return counted.drop("_null_side", "_enrolments").withColumnRenamed("user_id", "student_id")


def student_course_enrollment(course: DataFrame, video: DataFrame) -> DataFrame:
    """One row per enrolment event, repeats included, with the pair's video count."""
    enrolments = of_type(course, ENROLLED).select(
        "user_id", "course_id", F.col("timestamp_parsed").alias("enrollment_date")
    )
    watched = video.groupBy("user_id", "course_id").agg(
        F.count(F.lit(1)).alias("total_videos_watched")
    )
    return (
        lookup_join(enrolments, watched, ["user_id", "course_id"], "left")
        .na.fill(0, ["total_videos_watched"])
        .withColumnRenamed("user_id", "student_id")
    )


def student_course_detailed(course: DataFrame, video: DataFrame) -> DataFrame:
    """Students and courses with at least one video event, plus their course activity."""
    kind = F.col("_kind")
    keys = ["user_id", "course_id"]
    rows = _stack(
        _labelled("video", video, *keys, "watch_duration_seconds"),
        _labelled(
            "course",
            course,
            *keys,
            F.col("timestamp_parsed").alias("course_time"),
            (F.col("event_type") == DOWNLOADED).alias("is_download"),
        ),
    )
    counted = (
        rows.groupBy(*keys, unmatched_null(keys, kind))
        .agg(
            count_if(kind == "video").alias("videos_watched"),
            count_if(F.col("is_download")).alias("materials_downloaded"),
            F.max("course_time").alias("last_activity_date"),
            (F.sum("watch_duration_seconds") / 60).alias("watch_time_minutes"),
        )
        .where(F.col("videos_watched") > 0)
    )
    return counted.drop("_null_side").withColumnRenamed("user_id", "student_id")
