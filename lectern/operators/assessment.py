"""Batch views over assignment, quiz and grading events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import day, day_as_text, hours, of_type, side, unmatched_null
from lectern.functions.keyed import (
    lookup_join,
    pair_count,
    pair_max,
    pair_min,
    pair_seconds,
    pair_stats,
    pair_timed,
)


def student_submissions(assessment: DataFrame) -> DataFrame:
    return (
        of_type(assessment, "SUBMIT_ASSIGNMENT")
        .groupBy("user_id", "course_id")
        .agg(
            F.countDistinct("assignment_id").alias("total_assignments_submitted"),
            F.count("assignment_id").alias("total_submissions"),
            F.min("timestamp_parsed").alias("first_submission"),
            F.max("timestamp_parsed").alias("last_submission"),
        )
    )


def engagement_timeline(assessment: DataFrame) -> DataFrame:
    """Hours between each first view and each submission of the same assignment.

    The course is the one the view names. Pairs are never built, see `pair_stats`.
    """
    keyed = assessment.where(F.col("user_id").isNotNull() & F.col("assignment_id").isNotNull())
    views = (
        of_type(keyed, "VIEW_ASSIGNMENT_FIRST_TIME")
        .groupBy("user_id", "assignment_id", "course_id")
        .agg(*pair_stats("l", "timestamp_parsed"))
    )
    submissions = (
        of_type(keyed, "SUBMIT_ASSIGNMENT")
        .groupBy("user_id", "assignment_id")
        .agg(*pair_stats("r", "timestamp_parsed"))
    )
    per_course = (
        lookup_join(views, submissions, ["user_id", "assignment_id"], "inner")
        .groupBy("user_id", "course_id")
        .agg(
            pair_count().alias("assignments_completed"),
            pair_timed().alias("timed"),
            pair_seconds().cast("double").alias("seconds"),
            pair_min().alias("fastest"),
            pair_max().alias("slowest"),
        )
    )
    return per_course.select(
        "user_id",
        "course_id",
        "assignments_completed",
        F.try_divide("seconds", F.col("timed") * 3600).alias("avg_hours_to_submit"),
        hours(F.col("fastest")).alias("min_hours_to_submit"),
        hours(F.col("slowest")).alias("max_hours_to_submit"),
    )


def quiz_performance(assessment: DataFrame) -> DataFrame:
    return (
        of_type(assessment, "QUIZ_COMPLETED")
        .groupBy("user_id", "course_id")
        .agg(
            F.count("quiz_id").alias("total_quizzes_completed"),
            F.avg("correct_answers").alias("avg_correct_answers"),
            F.sum("correct_answers").alias("total_correct_answers"),
            F.min("correct_answers").alias("min_correct_answers"),
            F.max("correct_answers").alias("max_correct_answers"),
        )
    )


def grading_stats(assessment: DataFrame) -> DataFrame:
    return (
        of_type(assessment, "GRADE_ASSIGNMENT")
        .groupBy("student_id", "course_id")
        .agg(
            F.count("assignment_id").alias("total_assignments_graded"),
            F.avg("score").alias("avg_assignment_score"),
            F.min("score").alias("min_assignment_score"),
            F.max("score").alias("max_assignment_score"),
            F.sum("score").alias("total_assignment_score"),
        )
    )


def teacher_workload(assessment: DataFrame) -> DataFrame:
    """Works viewed beside works graded; a teacher who did only one keeps NULL for the other.

    Both sides share their keys, so the outer join is one GROUP BY: one scan, one
    shuffle that combines map-side.
    """
    viewed = F.col("event_type") == "VIEW_STUDENT_WORK"
    graded = F.col("event_type") == "GRADE_ASSIGNMENT"
    keys = ["user_id", "course_id"]
    return (
        of_type(assessment, "VIEW_STUDENT_WORK", "GRADE_ASSIGNMENT")
        .groupBy(*keys, unmatched_null(keys, F.col("event_type")))
        .agg(
            side(viewed, F.count(F.when(viewed, F.col("student_id")))).alias("total_works_viewed"),
            side(graded, F.count(F.when(graded, F.col("student_id")))).alias(
                "total_assignments_graded"
            ),
            F.avg(F.when(graded, F.col("score"))).alias("avg_score_given"),
        )
        .drop("_null_side")
    )


def submission_distribution(assessment: DataFrame) -> DataFrame:
    return day_as_text(
        of_type(assessment, "SUBMIT_ASSIGNMENT")
        .groupBy(day(), "course_id", "assignment_type")
        .agg(
            F.count("user_id").alias("submissions_count"),
            F.countDistinct("user_id").alias("unique_students"),
        )
    )


def student_overall_performance(assessment: DataFrame) -> DataFrame:
    """Quizzes a student completed beside assignments graded for that student."""
    quiz = F.col("event_type") == "QUIZ_COMPLETED"
    grade = F.col("event_type") == "GRADE_ASSIGNMENT"
    keys = ["user_id", "course_id"]
    student = F.when(grade, F.col("student_id")).otherwise(F.col("user_id"))
    return (
        of_type(assessment, "QUIZ_COMPLETED", "GRADE_ASSIGNMENT")
        .withColumn("user_id", student)
        .groupBy(*keys, unmatched_null(keys, F.col("event_type")))
        .agg(
            side(quiz, F.count(F.when(quiz, F.col("quiz_id")))).alias("quizzes_completed"),
            F.avg(F.when(quiz, F.col("correct_answers"))).alias("avg_quiz_correct"),
            side(grade, F.count(F.when(grade, F.col("assignment_id")))).alias(
                "assignments_graded"
            ),
            F.avg(F.when(grade, F.col("score"))).alias("avg_assignment_score"),
        )
        .drop("_null_side")
    )
