"""The 41 batch views: what each reads, how it is built, how its output is ordered.

`order` names columns, "-" in front for descending. Ranking orders end in the
view's keys, so equal ranks fall in a fixed order and a range partitioning can
split a long run of ties.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators import (
    assessment,
    auth,
    course,
    cross_domain,
    notification,
    profile,
    rolled,
    video,
)

TopicFrames = Callable[[str], DataFrame]


@dataclass(frozen=True)
class View:
    name: str
    job: str
    topics: tuple[str, ...]
    build: Callable[..., DataFrame]
    order: tuple[str, ...] = ()
    students_only: bool = False


def _domain(job, topic, *views):
    return [View(name, job, (topic,), fn, tuple(order)) for name, fn, order in views]


def _cross(*views):
    return [
        View(
            name,
            "student_course_analytics",
            tuple(topics),
            fn,
            tuple(order),
            students_only=True,
        )
        for name, topics, fn, order in views
    ]


# The views' names, their topics and the columns that order them.
_ALL = [
    *_domain(
        "auth",
        "auth",
        ("auth_daily_active_users", auth.daily_active_users, ["date"]),
        ("auth_hourly_login_patterns", auth.hourly_login_patterns, ["date", "hour"]),
        ("auth_user_session_metrics", auth.user_session_metrics, ["-total_sessions", "user_id"]),
        ("auth_user_activity_summary", auth.user_activity_summary, ["-total_logins", "user_id", "role"]),
        ("auth_registration_analytics", auth.registration_analytics, ["date", "registration_source", "role"]),
    ),
    *_domain(
        "assessment",
        "assessment",
        ("assessment_student_submissions", assessment.student_submissions, ["-total_assignments_submitted", "user_id", "course_id"]),
        ("assessment_engagement_timeline", assessment.engagement_timeline, ["user_id", "course_id"]),
        ("assessment_quiz_performance", assessment.quiz_performance, ["-avg_correct_answers", "user_id", "course_id"]),
        ("assessment_grading_stats", assessment.grading_stats, ["-avg_assignment_score", "student_id", "course_id"]),
        ("assessment_teacher_workload", assessment.teacher_workload, ["user_id", "course_id"]),
        ("assessment_submission_distribution", assessment.submission_distribution, ["date", "course_id", "assignment_type"]),
        ("assessment_student_overall_performance", assessment.student_overall_performance, ["user_id", "course_id"]),
    ),
    *_domain(
        "video",
        "video",
        ("video_total_watch_time", video.total_watch_time, ["-total_watch_seconds", "user_id", "video_id", "course_id"]),
        ("video_student_engagement", video.student_engagement, ["-total_watch_seconds", "user_id", "course_id"]),
        ("video_popularity", video.popularity, ["-unique_viewers", "video_id", "course_id"]),
        ("video_daily_engagement", video.daily_engagement, ["date", "course_id"]),
        ("video_course_metrics", video.course_metrics, ["course_id"]),
        ("video_student_course_summary", video.student_course_summary, ["user_id", "course_id"]),
        ("video_drop_off_indicators", video.drop_off_indicators, ["avg_watch_duration", "video_id", "course_id"]),
    ),
    *_domain(
        "course",
        "course",
        ("course_enrollment_stats", course.enrollment_stats, ["date", "course_id"]),
        ("course_material_access", course.material_access, ["user_id", "course_id"]),
        ("course_material_popularity", course.material_popularity, ["-total_accesses", "course_id", "material_id", "material_type"]),
        ("course_download_analytics", course.download_analytics, ["-total_downloads", "user_id", "course_id"]),
        ("course_resource_download_stats", course.resource_download_stats, ["-total_download_count", "course_id", "resource_id"]),
        ("course_activity_summary", course.activity_summary, ["user_id"]),
        ("course_daily_engagement", course.daily_engagement, ["date", "course_id", "event_type"]),
        ("course_overall_metrics", course.overall_metrics, ["-total_enrollments", "course_id"]),
    ),
    *_domain(
        "profile_notification",
        "profile",
        ("profile_update_frequency", profile.update_frequency, ["-total_profile_updates", "user_id"]),
        ("profile_field_changes", profile.field_changes, ["-total_updates", "field_name"]),
        ("profile_avatar_changes", profile.avatar_changes, ["-avatar_changes_count", "user_id"]),
        ("profile_daily_activity", profile.daily_activity, ["date", "event_type"]),
    ),
    *_domain(
        "profile_notification",
        "notification",
        ("notification_delivery_stats", notification.delivery_stats, ["-total_sent", "notification_type"]),
        ("notification_engagement", notification.engagement, ["-notifications_clicked", "user_id", "notification_type"]),
        ("notification_click_through_rate", notification.click_through_rate, ["-click_through_rate", "notification_type"]),
        ("notification_user_preferences", notification.user_preferences, ["user_id", "-engagement_rate", "notification_type"]),
        ("notification_daily_activity", notification.daily_activity, ["date", "event_type", "notification_type"]),
        ("notification_user_summary", notification.user_summary, ["-overall_engagement_rate", "user_id"]),
    ),
    # Enrolment events may be exact copies, which no ordering can spread over tasks;
    # they stay unordered.
    *_cross(
        ("course_overview", ["course", "video"], cross_domain.course_overview, ["course_id"]),
        ("student_overview", ["course", "video", "assessment", "auth"], cross_domain.student_overview, ["student_id"]),
        ("student_course_enrollment", ["course", "video"], cross_domain.student_course_enrollment, []),
        ("student_course_detailed", ["course", "video"], cross_domain.student_course_detailed, ["student_id", "course_id"]),
    ),
]

VIEWS: dict[str, View] = {v.name: v for v in _ALL}
JOBS: tuple[str, ...] = tuple(dict.fromkeys(v.job for v in _ALL))


def views_of(job: str) -> list[View]:
    return [v for v in VIEWS.values() if v.job == job]


def sort_columns(order: tuple[str, ...]) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


def build_view(name: str, topic_frame: TopicFrames, ordered: bool = True) -> DataFrame:
    """A view from typed topic frames; `topic_frame("auth")` gives the auth events."""
    return _build(VIEWS[name], VIEWS[name].build, topic_frame, ordered)


def build_rolled(name: str, rollup: TopicFrames, ordered: bool = False) -> DataFrame:
    """The same view from the topics' rollups; `rollup("auth")` gives the auth rollup."""
    return _build(VIEWS[name], rolled.BUILD[name], rollup, ordered)


def _build(view: View, build: Callable[..., DataFrame], topic_frame: TopicFrames, ordered: bool) -> DataFrame:
    inputs = [topic_frame(t) for t in view.topics]
    if view.students_only:
        inputs = [cross_domain.students_only(df) for df in inputs]
    result = build(*inputs)
    return result.orderBy(*sort_columns(view.order)) if ordered and view.order else result


def view_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"
