"""Batch views over course interaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import count_if, day, day_as_text, of_type, unmatched_null


def enrollment_stats(course: DataFrame) -> DataFrame:
    return day_as_text(
        of_type(course, "COURSE_ENROLLED")
        .groupBy(day(), "course_id")
        .agg(
            F.count("user_id").alias("new_enrollments"),
            F.countDistinct("user_id").alias("unique_new_students"),
        )
    )


def material_access(course: DataFrame) -> DataFrame:
    return (
        of_type(course, "ACCESS_COURSE_MATERIAL")
        .groupBy("user_id", "course_id")
        .agg(
            F.count("material_id").alias("total_material_accesses"),
            F.countDistinct("material_id").alias("unique_materials_accessed"),
            F.min("timestamp_parsed").alias("first_access"),
            F.max("timestamp_parsed").alias("last_access"),
        )
    )


def material_popularity(course: DataFrame) -> DataFrame:
    return (
        of_type(course, "ACCESS_COURSE_MATERIAL")
        .groupBy("course_id", "material_id", "material_type")
        .agg(
            F.countDistinct("user_id").alias("unique_accessors"),
            F.count("user_id").alias("total_accesses"),
        )
    )


def download_analytics(course: DataFrame) -> DataFrame:
    return (
        of_type(course, "DOWNLOAD_MATERIAL")
        .groupBy("user_id", "course_id")
        .agg(
            F.count("resource_id").alias("total_downloads"),
            F.countDistinct("resource_id").alias("unique_resources_downloaded"),
        )
    )


def resource_download_stats(course: DataFrame) -> DataFrame:
    return (
        of_type(course, "DOWNLOAD_MATERIAL")
        .groupBy("course_id", "resource_id")
        .agg(
            F.countDistinct("user_id").alias("unique_downloaders"),
            F.count("user_id").alias("total_download_count"),
        )
    )


def activity_summary(course: DataFrame) -> DataFrame:
    """Enrolments, accesses and downloads per user, 0 where a user did none.

    A chain of outer joins on the user is one GROUP BY over the three event types.
    """
    kind = F.col("event_type")
    enrolled = kind == "COURSE_ENROLLED"
    accessed = kind == "ACCESS_COURSE_MATERIAL"
    downloaded = kind == "DOWNLOAD_MATERIAL"
    return (
        of_type(course, "COURSE_ENROLLED", "ACCESS_COURSE_MATERIAL", "DOWNLOAD_MATERIAL")
        .groupBy("user_id", unmatched_null(["user_id"], kind))
        .agg(
            F.countDistinct(F.when(enrolled, F.col("course_id"))).alias("courses_enrolled"),
            F.count(F.when(accessed, F.col("material_id"))).alias("total_material_accesses"),
            F.countDistinct(F.when(accessed, F.col("course_id"))).alias(
                "courses_with_material_access"
            ),
            F.count(F.when(downloaded, F.col("resource_id"))).alias("total_downloads"),
        )
        .drop("_null_side")
    )


def daily_engagement(course: DataFrame) -> DataFrame:
    return day_as_text(
        course.groupBy(day(), "course_id", "event_type").agg(
            F.countDistinct("user_id").alias("unique_users"),
            F.count("user_id").alias("event_count"),
        )
    )


def overall_metrics(course: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return course.groupBy("course_id").agg(
        count_if(kind == "COURSE_ENROLLED").alias("total_enrollments"),
        count_if(kind == "ACCESS_COURSE_MATERIAL").alias("total_material_accesses"),
        count_if(kind == "DOWNLOAD_MATERIAL").alias("total_downloads"),
        F.countDistinct("user_id").alias("unique_students_interacting"),
    )
