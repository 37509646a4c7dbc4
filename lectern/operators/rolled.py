"""The 41 batch views from rollups instead of events; same columns, types and rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import count_if, day_as_text, hours, of_type, percent, side, unmatched_null
from lectern.functions.keyed import lookup_join, pair_count, pair_max, pair_min, pair_seconds, pair_timed
from lectern.operators.cross_domain import DOWNLOADED, ENROLLED, _labelled, _stack
from lectern.operators.notification import CLICKED, SENT
from lectern.operators.rollups import events_where, known, mean, pair_sides

VIEWED, GRADED, SUBMITTED, QUIZ = "VIEW_STUDENT_WORK", "GRADE_ASSIGNMENT", "SUBMIT_ASSIGNMENT", "QUIZ_COMPLETED"
ACCESSED, WATCHED = "ACCESS_COURSE_MATERIAL", "VIDEO_WATCHED"


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def _extent(first: str, last: str) -> list[Column]:
    return [F.min("first").alias(first), F.max("last").alias(last)]


def _pairs(left: DataFrame, right: DataFrame, on: list[str], keys: list[str], names: list[str], unit: int) -> DataFrame:
    """Statistics over all pairs of two sides; `names`: count, average, least, most."""
    found = lookup_join(left, right, on, "inner").groupBy(*keys).agg(
        pair_count().alias(names[0]), pair_timed().alias("timed"), pair_seconds().cast("double").alias("seconds"),
        pair_min().alias("least"), pair_max().alias("most"),
    )
    return found.select(
        *keys, names[0], F.try_divide("seconds", F.col("timed") * unit).alias(names[1]),
        (F.col("least") / unit).alias(names[2]), (F.col("most") / unit).alias(names[3]), "seconds",
    )


# ---- auth ---------------------------------------------------------------------


def daily_active_users(auth):
    return day_as_text(of_type(auth, "LOGIN").groupBy(F.to_date("hour_start").alias("date")).agg(
        F.countDistinct("user_id").alias("daily_active_users"), F.countDistinct("session_id").alias("total_sessions")
    ))


def hourly_login_patterns(auth):
    keys = F.to_date("hour_start").alias("date"), F.hour("hour_start").alias("hour")
    return day_as_text(of_type(auth, "LOGIN").groupBy(*keys).agg(known("user_id").alias("login_count")))


def user_session_metrics(auth):
    named = auth.where(F.col("session_id").isNotNull())
    logins = of_type(named, "LOGIN").groupBy("session_id", "user_id").agg(*pair_sides("l"))
    logouts = of_type(named, "LOGOUT").groupBy("session_id").agg(*pair_sides("r"))
    names = ["total_sessions", *(f"{n}_session_duration_minutes" for n in ("avg", "min", "max"))]
    found = _pairs(logins, logouts, ["session_id"], ["user_id"], names, 60)
    return found.withColumn("total_time_online_minutes", F.col("seconds") / 60).drop("seconds")


def user_activity_summary(auth):
    return auth.groupBy("user_id", "role").agg(
        events_where(_is("LOGIN")).alias("total_logins"), events_where(_is("LOGOUT")).alias("total_logouts"),
        *_extent("first_activity", "last_activity"), F.countDistinct("session_id").alias("unique_sessions"),
    )


def registration_analytics(auth):
    keys = F.to_date("hour_start").alias("date"), "registration_source", "role"
    return day_as_text(of_type(auth, "SIGNUP").groupBy(*keys).agg(known("user_id").alias("new_signups")))


# ---- assessment -----------------------------------------------------------------


def student_submissions(assessment):
    return of_type(assessment, SUBMITTED).groupBy("user_id", "course_id").agg(
        F.countDistinct("assignment_id").alias("total_assignments_submitted"),
        known("assignment_id").alias("total_submissions"), *_extent("first_submission", "last_submission"),
    )


def engagement_timeline(assessment):
    keyed = assessment.where(F.col("user_id").isNotNull() & F.col("assignment_id").isNotNull())
    views = of_type(keyed, "VIEW_ASSIGNMENT_FIRST_TIME").groupBy("user_id", "assignment_id", "course_id")
    done = of_type(keyed, SUBMITTED).groupBy("user_id", "assignment_id").agg(*pair_sides("r"))
    names = ["assignments_completed", *(f"{n}_hours_to_submit" for n in ("avg", "min", "max"))]
    on, keys = ["user_id", "assignment_id"], ["user_id", "course_id"]
    return _pairs(views.agg(*pair_sides("l")), done, on, keys, names, 3600).drop("seconds")


def quiz_performance(assessment):
    return of_type(assessment, QUIZ).groupBy("user_id", "course_id").agg(
        known("quiz_id").alias("total_quizzes_completed"), mean("answers").alias("avg_correct_answers"),
        F.sum("answers_sum").alias("total_correct_answers"), F.min("answers_min").alias("min_correct_answers"),
        F.max("answers_max").alias("max_correct_answers"),
    )


def grading_stats(assessment):
    return of_type(assessment, GRADED).groupBy("student_id", "course_id").agg(
        known("assignment_id").alias("total_assignments_graded"), mean("score").alias("avg_assignment_score"),
        F.min("score_min").alias("min_assignment_score"), F.max("score_max").alias("max_assignment_score"),
        F.sum("score_sum").alias("total_assignment_score"),
    )


def teacher_workload(assessment):
    keys, viewed, graded = ["user_id", "course_id"], _is(VIEWED), _is(GRADED)
    return of_type(assessment, VIEWED, GRADED).groupBy(*keys, unmatched_null(keys, F.col("event_type"))).agg(
        side(viewed, known("student_id", viewed)).alias("total_works_viewed"),
        side(graded, known("student_id", graded)).alias("total_assignments_graded"),
        mean("score", graded).alias("avg_score_given"),
    ).drop("_null_side")


def submission_distribution(assessment):
    return day_as_text(of_type(assessment, SUBMITTED).groupBy("date", "course_id", "assignment_type").agg(
        known("user_id").alias("submissions_count"), F.countDistinct("user_id").alias("unique_students")
    ))


def student_overall_performance(assessment):
    keys, quiz, grade = ["user_id", "course_id"], _is(QUIZ), _is(GRADED)
    student = F.when(grade, F.col("student_id")).otherwise(F.col("user_id"))
    rows = of_type(assessment, QUIZ, GRADED).withColumn("user_id", student)
    return rows.groupBy(*keys, unmatched_null(keys, F.col("event_type"))).agg(
        side(quiz, known("quiz_id", quiz)).alias("quizzes_completed"), mean("answers", quiz).alias("avg_quiz_correct"),
        side(grade, known("assignment_id", grade)).alias("assignments_graded"),
        mean("score", grade).alias("avg_assignment_score"),
    ).drop("_null_side")


# ---- video ----------------------------------------------------------------------


def total_watch_time(video):
    total = F.sum("watch_sum")
    return of_type(video, WATCHED).groupBy("user_id", "video_id", "course_id").agg(
        total.alias("total_watch_seconds"), events_where(of="sessions").alias("total_watch_sessions"),
        mean("watch").alias("avg_watch_duration_seconds"), F.max("watch_max").alias("longest_session_seconds"),
        F.min("watch_min").alias("shortest_session_seconds"), (total / 60).alias("total_watch_minutes"),
        hours(total).alias("total_watch_hours"),
    )


def student_engagement(video):
    total = F.sum("watch_sum")
    return of_type(video, WATCHED).groupBy("user_id", "course_id").agg(
        F.countDistinct("video_id").alias("unique_videos_watched"), total.alias("total_watch_seconds"),
        known("video_id").alias("total_video_events"), mean("watch").alias("avg_watch_duration_seconds"),
        hours(total).alias("total_watch_hours"),
    )


def popularity(video):
    total = F.sum("watch_sum")
    return of_type(video, WATCHED).groupBy("video_id", "course_id").agg(
        F.countDistinct("user_id").alias("unique_viewers"), total.alias("total_views_seconds"),
        known("user_id").alias("total_view_events"), mean("watch").alias("avg_view_duration_seconds"),
        hours(total).alias("total_views_hours"),
    )


def video_daily_engagement(video):
    total = F.sum("watch_sum")
    return day_as_text(of_type(video, WATCHED).groupBy("date", "course_id").agg(
        F.countDistinct("user_id").alias("active_video_watchers"),
        F.countDistinct("video_id").alias("unique_videos_watched"), total.alias("total_watch_seconds"),
        known("user_id").alias("total_watch_events"), hours(total).alias("total_watch_hours"),
    ))


def course_metrics(video):
    total = F.sum("watch_sum")
    return of_type(video, WATCHED).groupBy("course_id").agg(
        F.countDistinct("user_id").alias("total_students_watching"),
        F.countDistinct("video_id").alias("total_videos_in_course"), total.alias("total_course_watch_seconds"),
        hours(total).alias("total_course_watch_hours"),
    )


def student_course_summary(video):
    watched, total = of_type(video, WATCHED), F.sum("watch_sum")
    per_student = watched.groupBy("user_id", "course_id").agg(
        F.countDistinct("video_id").alias("videos_watched_count"), total.alias("total_watch_seconds"),
        events_where(of="sessions").alias("total_sessions"), hours(total).alias("total_watch_hours"),
    )
    per_course = watched.groupBy("course_id").agg(F.countDistinct("video_id").alias("total_videos_in_course"))
    coverage = percent(F.col("videos_watched_count"), F.col("total_videos_in_course"))
    joined = lookup_join(per_student, per_course, ["course_id"], "left")
    return joined.withColumn("video_coverage_percentage", coverage)


def drop_off_indicators(video):
    average = mean("watch")
    risk = F.when(average < 60, "High Risk").when(average < 180, "Medium Risk").otherwise("Good Engagement")
    return of_type(video, WATCHED).groupBy("video_id", "course_id").agg(
        known("user_id").alias("total_views"), average.alias("avg_watch_duration"),
        F.min("watch_min").alias("min_watch_duration"), F.countDistinct("user_id").alias("unique_viewers"),
        risk.alias("potential_drop_off"),
    )


# ---- course -----------------------------------------------------------------------


def enrollment_stats(course):
    return day_as_text(of_type(course, ENROLLED).groupBy("date", "course_id").agg(
        known("user_id").alias("new_enrollments"), F.countDistinct("user_id").alias("unique_new_students")
    ))


def material_access(course):
    return of_type(course, ACCESSED).groupBy("user_id", "course_id").agg(
        known("material_id").alias("total_material_accesses"),
        F.countDistinct("material_id").alias("unique_materials_accessed"), *_extent("first_access", "last_access"),
    )


def material_popularity(course):
    return of_type(course, ACCESSED).groupBy("course_id", "material_id", "material_type").agg(
        F.countDistinct("user_id").alias("unique_accessors"), known("user_id").alias("total_accesses")
    )


def download_analytics(course):
    return of_type(course, DOWNLOADED).groupBy("user_id", "course_id").agg(
        known("resource_id").alias("total_downloads"),
        F.countDistinct("resource_id").alias("unique_resources_downloaded"),
    )


def resource_download_stats(course):
    return of_type(course, DOWNLOADED).groupBy("course_id", "resource_id").agg(
        F.countDistinct("user_id").alias("unique_downloaders"), known("user_id").alias("total_download_count")
    )


def activity_summary(course):
    rows = of_type(course, ENROLLED, ACCESSED, DOWNLOADED)
    return rows.groupBy("user_id", unmatched_null(["user_id"], F.col("event_type"))).agg(
        F.countDistinct(F.when(_is(ENROLLED), F.col("course_id"))).alias("courses_enrolled"),
        known("material_id", _is(ACCESSED)).alias("total_material_accesses"),
        F.countDistinct(F.when(_is(ACCESSED), F.col("course_id"))).alias("courses_with_material_access"),
        known("resource_id", _is(DOWNLOADED)).alias("total_downloads"),
    ).drop("_null_side")


def course_daily_engagement(course):
    return day_as_text(course.groupBy("date", "course_id", "event_type").agg(
        F.countDistinct("user_id").alias("unique_users"), known("user_id").alias("event_count")
    ))


def overall_metrics(course):
    return course.groupBy("course_id").agg(
        events_where(_is(ENROLLED)).alias("total_enrollments"),
        events_where(_is(ACCESSED)).alias("total_material_accesses"),
        events_where(_is(DOWNLOADED)).alias("total_downloads"),
        F.countDistinct("user_id").alias("unique_students_interacting"),
    )


# ---- profile and notification -------------------------------------------------------


def update_frequency(profile):
    return of_type(profile, "UPDATE_PROFILE").groupBy("user_id").agg(
        known("user_id").alias("total_profile_updates"), *_extent("first_update", "last_update")
    )


def field_changes(profile):
    return of_type(profile, "UPDATE_PROFILE").groupBy("field_name").agg(
        known("user_id").alias("total_updates"), F.countDistinct("user_id").alias("unique_users_updating")
    )


def avatar_changes(profile):
    return of_type(profile, "CHANGE_AVATAR").groupBy("user_id").agg(
        known("user_id").alias("avatar_changes_count"), *_extent("first_change", "last_change")
    )


def profile_daily_activity(profile):
    return day_as_text(profile.groupBy("date", "event_type").agg(
        F.countDistinct("user_id").alias("unique_users"), known("user_id").alias("event_count")
    ))


def delivery_stats(notification):
    return of_type(notification, SENT).groupBy("notification_type").agg(
        known("user_id").alias("total_sent"), F.countDistinct("user_id").alias("unique_recipients")
    )


def notification_engagement(notification):
    keys = "user_id", "notification_type"
    return of_type(notification, CLICKED).groupBy(*keys).agg(events_where(of="ids").alias("notifications_clicked"))


def _clicked_of_sent(notification, keys, sent, clicked, rate):
    rows = of_type(notification, SENT, CLICKED).groupBy(*keys, unmatched_null(keys, F.col("event_type")))
    counted = rows.agg(
        events_where(_is(SENT), "ids").alias(sent), events_where(_is(CLICKED), "ids").alias(clicked),
        count_if(_is(SENT)).alias("_sent_rows"),
    ).where(F.col("_sent_rows") > 0)
    return counted.select(*keys, sent, clicked, percent(F.col(clicked), F.col(sent)).alias(rate))


def click_through_rate(notification):
    return _clicked_of_sent(notification, ["notification_type"], "total_sent", "total_clicked", "click_through_rate")


def user_preferences(notification):
    names = "notifications_received", "notifications_clicked", "engagement_rate"
    return _clicked_of_sent(notification, ["user_id", "notification_type"], *names)


def notification_daily_activity(notification):
    return day_as_text(notification.groupBy("date", "event_type", "notification_type").agg(
        F.countDistinct("user_id").alias("unique_users"), events_where(of="ids").alias("event_count")
    ))


def user_summary(notification):
    received, clicked = events_where(_is(SENT)), events_where(_is(CLICKED))
    return notification.groupBy("user_id").agg(
        received.alias("total_received"), clicked.alias("total_clicked"),
        percent(clicked, received).alias("overall_engagement_rate"),
    )


# ---- several topics -----------------------------------------------------------------


def course_overview(course, video):
    kind = F.col("_kind")
    rows = _stack(
        _labelled("enrolled", of_type(course, ENROLLED), "course_id", "user_id", "rows"),
        _labelled("video", video, "course_id", "rows"),
        _labelled("download", of_type(course, DOWNLOADED), "course_id", "rows"),
    )
    counted = rows.groupBy("course_id", unmatched_null(["course_id"], kind)).agg(
        F.countDistinct("user_id").alias("total_enrolled_students"),
        events_where(kind == "video").alias("total_videos_watched"),
        events_where(kind == "download").alias("total_materials_downloaded"),
        count_if(kind == "enrolled").alias("_enrolments"),
    )
    return counted.where(F.col("_enrolments") > 0).drop("_null_side", "_enrolments")


def student_overview(course, video, assessment, auth):
    kind = F.col("_kind")
    rows = _stack(
        _labelled("enrolled", of_type(course, ENROLLED), "user_id", "course_id", "rows"),
        _labelled("video", video, "user_id", "rows"),
        _labelled("submit", of_type(assessment, SUBMITTED), "user_id", "rows", "score_sum", "score_count"),
        _labelled("login", of_type(auth, "LOGIN"), "user_id", "rows"),
    )
    counted = rows.groupBy("user_id", unmatched_null(["user_id"], kind)).agg(
        F.countDistinct("course_id").alias("total_courses_enrolled"),
        events_where(kind == "video").alias("total_videos_watched"),
        events_where(kind == "submit").alias("total_assignments_submitted"),
        F.coalesce(mean("score"), F.lit(0.0)).alias("avg_assignment_score"),
        events_where(kind == "login").alias("total_logins"), count_if(kind == "enrolled").alias("_enrolments"),
    )
    counted = counted.where(F.col("_enrolments") > 0).drop("_null_side", "_enrolments")
    return counted.withColumnRenamed("user_id", "student_id")


def student_course_enrollment(course, video):
    """The rollup keeps the time of each enrolment; equal ones are repeated as often as they occurred."""
    repeats = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows")))
    enrolments = of_type(course, ENROLLED).select(
        "user_id", "course_id", F.col("enrolled_at").alias("enrollment_date"), repeats.alias("_copy")
    )
    watched = video.groupBy("user_id", "course_id").agg(F.sum("rows").alias("total_videos_watched"))
    joined = lookup_join(enrolments.drop("_copy"), watched, ["user_id", "course_id"], "left")
    return joined.na.fill(0, ["total_videos_watched"]).withColumnRenamed("user_id", "student_id")


def student_course_detailed(course, video):
    kind, keys = F.col("_kind"), ["user_id", "course_id"]
    rows = _stack(
        _labelled("video", video, *keys, "rows", "watch_sum"),
        _labelled("course", course, *keys, "rows", "last", _is(DOWNLOADED).alias("is_download")),
    )
    counted = rows.groupBy(*keys, unmatched_null(keys, kind)).agg(
        events_where(kind == "video").alias("videos_watched"),
        events_where(F.col("is_download")).alias("materials_downloaded"), F.max("last").alias("last_activity_date"),
        (F.sum("watch_sum") / 60).alias("watch_time_minutes"),
    )
    counted = counted.where(F.col("videos_watched") > 0).drop("_null_side")
    return counted.withColumnRenamed("user_id", "student_id")


# View names.
BUILD: dict[str, Callable[..., DataFrame]] = {
    "auth_daily_active_users": daily_active_users,
    "auth_hourly_login_patterns": hourly_login_patterns,
    "auth_user_session_metrics": user_session_metrics,
    "auth_user_activity_summary": user_activity_summary,
    "auth_registration_analytics": registration_analytics,
    "assessment_student_submissions": student_submissions,
    "assessment_engagement_timeline": engagement_timeline,
    "assessment_quiz_performance": quiz_performance,
    "assessment_grading_stats": grading_stats,
    "assessment_teacher_workload": teacher_workload,
    "assessment_submission_distribution": submission_distribution,
    "assessment_student_overall_performance": student_overall_performance,
    "video_total_watch_time": total_watch_time,
    "video_student_engagement": student_engagement,
    "video_popularity": popularity,
    "video_daily_engagement": video_daily_engagement,
    "video_course_metrics": course_metrics,
    "video_student_course_summary": student_course_summary,
    "video_drop_off_indicators": drop_off_indicators,
    "course_enrollment_stats": enrollment_stats,
    "course_material_access": material_access,
    "course_material_popularity": material_popularity,
    "course_download_analytics": download_analytics,
    "course_resource_download_stats": resource_download_stats,
    "course_activity_summary": activity_summary,
    "course_daily_engagement": course_daily_engagement,
    "course_overall_metrics": overall_metrics,
    "profile_update_frequency": update_frequency,
    "profile_field_changes": field_changes,
    "profile_avatar_changes": avatar_changes,
    "profile_daily_activity": profile_daily_activity,
    "notification_delivery_stats": delivery_stats,
    "notification_engagement": notification_engagement,
    "notification_click_through_rate": click_through_rate,
    "notification_user_preferences": user_preferences,
    "notification_daily_activity": notification_daily_activity,
    "notification_user_summary": user_summary,
    "course_overview": course_overview,
    "student_overview": student_overview,
    "student_course_enrollment": student_course_enrollment,
    "student_course_detailed": student_course_detailed,
}
