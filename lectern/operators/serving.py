"""Serving queries over the batch and speed views.

Frames in, one lazy frame out. "Now" is always the argument `as_of`: a Column, a
datetime or timestamp text, so an answer can be repeated. One-row results are put
together from scalar subqueries, which need no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = Column | datetime | str

# Engagement bands by total interactions.
BANDS = [
    ("highly_active", "Highly Active"),
    ("moderately_active", "Moderately Active"),
    ("low_activity", "Low Activity"),
    ("inactive", "Inactive"),
]


def moment(as_of: AsOf) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def _back(as_of: AsOf, hours: int) -> Column:
    return moment(as_of) - F.make_dt_interval(hours=F.lit(hours))


def _since(view: DataFrame, as_of: AsOf, hours: int) -> DataFrame:
    return view.where(F.col("window_start") >= _back(as_of, hours))


def _one_row(some: DataFrame, **columns: Column) -> DataFrame:
    row = some.sparkSession.range(1)
    return row.select(*[c.alias(n) for n, c in columns.items()])


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def _total(df: DataFrame, column: str) -> Column:
    return df.agg(F.coalesce(F.sum(column), F.lit(0).cast("bigint"))).scalar()


# ---- batch views ---------------------------------------------------------


def batch_summary(students: DataFrame, courses: DataFrame) -> DataFrame:
    """Row counts of both overviews, and their last run if the view records it."""
    last = (
        courses.agg(F.max("last_updated")).scalar()
        if "last_updated" in courses.columns
        else F.lit(None).cast("timestamp")
    )
    return _one_row(
        students,
        total_students=_count(students),
        total_courses=_count(courses),
        batch_last_run=last,
    )


def student_engagement_distribution(students: DataFrame) -> DataFrame:
    total = (
        F.col("total_videos_watched")
        + F.col("total_assignments_submitted")
        + F.col("total_logins")
    )
    band = {
        "highly_active": total > 50,
        "moderately_active": total.between(10, 50),
        "low_activity": total.between(1, 9),
        "inactive": total == 0,
    }
    return students.agg(*[F.count(F.when(band[n], 1)).alias(n) for n, _ in BANDS])


def historical_dau(dau: DataFrame, as_of: AsOf, hours: int = 6) -> DataFrame:
    start = F.col("date").try_cast("timestamp")
    return (
        dau.where(start >= _back(as_of, hours))
        .select(
            F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("date"),
            F.col("daily_active_users").alias("users"),
            F.lit("batch").alias("source"),
        )
        .orderBy("date")
    )


def batch_activity_stats(courses: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return courses.agg(
        F.coalesce(F.sum("total_videos_watched"), zero).alias("total_videos_watched"),
        F.coalesce(F.sum("total_materials_downloaded"), zero).alias("total_materials_downloaded"),
    )


def all_courses(courses: DataFrame) -> DataFrame:
    return courses


def all_students(students: DataFrame) -> DataFrame:
    return students


def course_details(courses: DataFrame, course_id: str) -> DataFrame:
    """Empty when the course is unknown."""
    return courses.where(F.col("course_id") == course_id)


def student_details(students: DataFrame, student_id: str) -> DataFrame:
    return students.where(F.col("student_id") == student_id)


def course_students(enrollments: DataFrame, course_id: str) -> DataFrame:
    return enrollments.where(F.col("course_id") == course_id)


def student_courses(enrollments: DataFrame, student_id: str) -> DataFrame:
    return enrollments.where(F.col("student_id") == student_id)


def student_course_performance(detailed: DataFrame, student_id: str, course_id: str) -> DataFrame:
    return detailed.where(
        (F.col("student_id") == student_id) & (F.col("course_id") == course_id)
    )


# ---- speed views, conformed to window_start / window_end --------------------


# The age up to which speed data is healthy; states are unknown, healthy, stale.
HEALTHY_SECONDS = 300


def _latest(active_users: DataFrame) -> DataFrame:
    """The newest window; among equal starts, the one that ends last."""
    order = F.struct("window_start", "window_end")
    return active_users.agg(
        F.coalesce(F.max_by("active_users", order), F.lit(0).cast("bigint")).alias("active_users"),
        F.max("window_start").alias("window_start"),
    )


def speed_summary(active_users: DataFrame, popularity: DataFrame, as_of: AsOf) -> DataFrame:
    age = F.unix_timestamp(moment(as_of)) - F.unix_timestamp("window_start")
    courses = _since(popularity, as_of, 1).agg(F.countDistinct("course_id")).scalar()
    return _latest(active_users).select(
        F.col("active_users").alias("current_active_users"),
        courses.alias("total_active_courses"),
        F.when(F.col("window_start").isNull(), "unknown")
        .when(age < HEALTHY_SECONDS, "healthy")
        .otherwise("stale")
        .alias("speed_layer_status"),
        F.col("window_start").alias("last_update"),
    )


def recent_activity(
    engagement: DataFrame, popularity: DataFrame, as_of: AsOf, hours: int = 1
) -> DataFrame:
    return _one_row(
        engagement,
        videos_watched=_total(_since(engagement, as_of, hours), "views"),
        course_interactions=_total(_since(popularity, as_of, hours), "interactions"),
        time_period_hours=F.lit(hours),
    )


def realtime_active_users(
    active_users: DataFrame, as_of: AsOf, hours: int = 6, zone: str = "Asia/Ho_Chi_Minh"
) -> DataFrame:
    """Active users per window since the cutoff; times shown in `zone`."""
    stored_zone = F.current_timezone()
    local = F.convert_timezone(stored_zone, F.lit(zone), F.col("window_start").cast("timestamp_ntz"))
    return (
        _since(active_users, as_of, hours)
        .select(
            F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("date"),
            F.coalesce("active_users", F.lit(0)).alias("users"),
            F.lit("speed").alias("source"),
        )
        .orderBy("date", "users")
    )


def course_popularity(
    popularity: DataFrame, as_of: AsOf, limit: int = 10, hours: int = 24
) -> DataFrame:
    """The `limit` busiest courses since the cutoff."""
    return (
        _since(popularity, as_of, hours)
        .groupBy("course_id")
        .agg(F.sum(F.coalesce("interactions", F.lit(0))).alias("interactions"))
        .orderBy(F.desc("interactions"), "course_id")
        .limit(limit)
    )


def video_stats(engagement: DataFrame, as_of: AsOf, limit: int = 20, hours: int = 1) -> DataFrame:
    """The `limit` most viewed videos since the cutoff, with their newest window."""
    return (
        _since(engagement, as_of, hours)
        .groupBy("video_id")
        .agg(
            F.sum(F.coalesce("views", F.lit(0))).alias("views"),
            F.max("window_end").alias("window_end"),
        )
        .orderBy(F.desc("views"), "video_id")
        .limit(limit)
    )


def latest_active_users(active_users: DataFrame) -> DataFrame:
    return _latest(active_users).select("active_users", F.col("window_start").alias("timestamp"))


def system_summary(
    active_users: DataFrame,
    popularity: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    as_of: AsOf,
) -> DataFrame:
    """One dashboard row; active courses are those in any speed row."""
    now = moment(as_of)
    return _latest(active_users).select(
        F.lit("main").alias("summary_id"),
        F.col("active_users").alias("current_active_users"),
        popularity.agg(F.countDistinct("course_id")).scalar().alias("total_active_courses"),
        _count(students).alias("total_students"),
        _count(courses).alias("total_courses"),
        now.alias("batch_last_run"),
        F.lit("healthy").alias("speed_layer_status"),
        now.alias("last_updated"),
    )


# ---- dashboard arithmetic ---------------------------------------------------


def active_user_stats(series: DataFrame) -> DataFrame:
    """Peak and mean of a `realtime_active_users` series."""
    return series.agg(F.max("users").alias("peak_users"), F.avg("users").alias("avg_users"))


def activity_comparison(recent: DataFrame, cumulative: DataFrame) -> DataFrame:
    """Speed and batch activity side by side, one row per measure (labels are fixed values)."""

    def long_form(df, layer, **measures):
        names = ", ".join(f"'{label}', {column}" for column, label in measures.items())
        return df.selectExpr(f"stack({len(measures)}, {names}) AS (Metric, Count)").withColumn(
            "Layer", F.lit(layer)
        )

    speed = long_form(
        recent, "Speed", videos_watched="Videos (1h)", course_interactions="Interactions (1h)"
    )
    batch = long_form(
        cumulative,
        "Batch",
        total_videos_watched="Total Videos",
        total_materials_downloaded="Total Materials",
    )
    return speed.unionByName(batch)


def engagement_long_form(distribution: DataFrame) -> DataFrame:
    """The four bands as rows, each with the share of highly or moderately active students."""
    total = sum((F.col(n) for n, _ in BANDS), F.lit(0))
    active = F.col("highly_active") + F.col("moderately_active")
    share = F.coalesce(F.try_divide(active, total) * 100, F.lit(0.0)).alias("active_share")
    bands = F.array(
        *[
            F.struct(F.lit(label).alias("Category"), F.col(n).alias("Students"))
            for n, label in BANDS
        ]
    )
    return distribution.select(F.inline(bands), share)


def total_interactions(top_courses: DataFrame) -> DataFrame:
    return top_courses.agg(
        F.coalesce(F.sum("interactions"), F.lit(0).cast("bigint")).alias("total_interactions")
    )


def available_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])
