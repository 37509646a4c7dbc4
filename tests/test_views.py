"""Edge cases of the batch views on hand-written events."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lectern.operators import (
    assessment,
    auth,
    course,
    cross_domain,
    notification,
    profile,
    video,
)
from lectern.plans.registry import JOBS, VIEWS, build_view, views_of
from lectern.sources.sample import typed_topics


def ev(kind, user, time="2024-01-01 10:00:00", **more):
    return {"event_type": kind, "user_id": user, "timestamp": time, **more}


def test_registry_is_complete():
    assert len(VIEWS) == 41 and len(JOBS) == 6
    assert sum(len(views_of(j)) for j in JOBS) == 41


def test_sessions_pair_every_login_with_every_logout(typed, rows):
    events = typed(
        "auth",
        [
            ev("LOGIN", "a", "2024-01-01 10:00:00", session_id="s"),
            ev("LOGIN", "a", "2024-01-01 10:10:00", session_id="s"),
            ev("LOGOUT", "a", "2024-01-01 10:20:00", session_id="s"),
            ev("LOGOUT", "a", "2024-01-01 09:50:00", session_id="s"),
            ev("LOGIN", "b", session_id=None),
            ev("LOGOUT", "b", session_id=None),
            ev("LOGIN", "c", "not-a-time", session_id="t"),
            ev("LOGOUT", "c", session_id="t"),
        ],
    )
    assert rows(auth.user_session_metrics(events)) == [
        {
            "user_id": "a",
            "total_sessions": 4,
            "avg_session_duration_minutes": 0.0,
            "min_session_duration_minutes": -20.0,
            "max_session_duration_minutes": 20.0,
            "total_time_online_minutes": 0.0,
        },
        {
            "user_id": "c",
            "total_sessions": 1,
            "avg_session_duration_minutes": None,
            "min_session_duration_minutes": None,
            "max_session_duration_minutes": None,
            "total_time_online_minutes": None,
        },
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_pair_statistics_match_a_real_join(typed, seed):
    """Sessions shared by several users, unreadable times, hot and missing keys."""
    rng = random.Random(seed)

    def one():
        moment = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(10**7))
        text = "oops" if rng.random() < 0.1 else moment.strftime("%Y-%m-%d %H:%M:%S")
        session = None if rng.random() < 0.1 else f"s{min(rng.randrange(9), 3)}"
        return ev(rng.choice(["LOGIN", "LOGOUT"]), f"u{rng.randrange(4)}", text, session_id=session)

    events = typed("auth", [one() for _ in range(300)]).cache()
    login = events.where("event_type = 'LOGIN'").select(
        "user_id", "session_id", F.col("timestamp_parsed").alias("i")
    )
    logout = events.where("event_type = 'LOGOUT'").select(
        "session_id", F.col("timestamp_parsed").alias("o")
    )
    seconds = F.unix_timestamp("o") - F.unix_timestamp("i")
    expected = (
        login.join(logout, "session_id")
        .groupBy("user_id")
        .agg(
            F.count("session_id"),
            F.avg(seconds / 60),
            F.min(seconds / 60),
            F.max(seconds / 60),
            F.sum(seconds / 60),
        )
    )
    ours = {r[0]: r[1:] for r in auth.user_session_metrics(events).collect()}
    theirs = {r[0]: r[1:] for r in expected.collect()}
    assert ours.keys() == theirs.keys()
    for user in ours:
        assert ours[user] == pytest.approx(theirs[user], rel=1e-9)


def test_timeline_uses_the_course_of_the_view(typed, rows):
    events = typed(
        "assessment",
        [
            ev("VIEW_ASSIGNMENT_FIRST_TIME", "a", assignment_id="x", course_id="c1"),
            ev("SUBMIT_ASSIGNMENT", "a", "2024-01-01 13:00:00", assignment_id="x", course_id="c2"),
            ev("SUBMIT_ASSIGNMENT", "a", "2024-01-01 11:00:00", assignment_id="x"),
            ev("SUBMIT_ASSIGNMENT", "b", "2024-01-01 11:00:00", assignment_id="x"),
        ],
    )
    assert rows(assessment.engagement_timeline(events)) == [
        {
            "user_id": "a",
            "course_id": "c1",
            "assignments_completed": 2,
            "avg_hours_to_submit": 2.0,
            "min_hours_to_submit": 1.0,
            "max_hours_to_submit": 3.0,
        }
    ]


def test_workload_keeps_null_for_the_missing_side(typed, rows):
    events = typed(
        "assessment",
        [
            ev("VIEW_STUDENT_WORK", "t1", course_id="c", student_id="s"),
            ev("VIEW_STUDENT_WORK", "t1", course_id="c", student_id=None),
            ev("GRADE_ASSIGNMENT", "t2", course_id="c", student_id=None, score=7),
            ev("VIEW_STUDENT_WORK", "t3", student_id="s"),
            ev("GRADE_ASSIGNMENT", "t3", student_id="s", score=9),
        ],
    )
    got = {
        (r["user_id"], r["total_works_viewed"]): (r["total_assignments_graded"], r["avg_score_given"])
        for r in rows(assessment.teacher_workload(events))
    }
    assert got == {
        ("t1", 1): (None, None),
        ("t2", None): (0, 7.0),
        # NULL course: an equi-join does not match, so the two sides stay apart
        ("t3", 1): (None, None),
        ("t3", None): (1, 9.0),
    }


def test_overall_performance_joins_the_graded_student(typed, rows):
    events = typed(
        "assessment",
        [
            ev("QUIZ_COMPLETED", "s", course_id="c", quiz_id="q", correct_answers=4),
            ev("GRADE_ASSIGNMENT", "t", course_id="c", student_id="s", assignment_id="x", score=6),
        ],
    )
    assert rows(assessment.student_overall_performance(events)) == [
        {
            "user_id": "s",
            "course_id": "c",
            "quizzes_completed": 1,
            "avg_quiz_correct": 4.0,
            "assignments_graded": 1,
            "avg_assignment_score": 6.0,
        }
    ]


def test_drop_off_bands(typed):
    seconds = {"v1": [59, 60], "v2": [60, 60], "v3": [179, 180], "v4": [180], "v5": [None]}
    events = typed(
        "video",
        [
            ev("VIDEO_WATCHED", "a", video_id=v, course_id="c", watch_duration_seconds=s)
            for v, values in seconds.items()
            for s in values
        ],
    )
    bands = {r.video_id: r.potential_drop_off for r in video.drop_off_indicators(events).collect()}
    assert bands == {
        "v1": "High Risk",
        "v2": "Medium Risk",
        "v3": "Medium Risk",
        "v4": "Good Engagement",
        "v5": "Good Engagement",
    }


def test_coverage(typed, rows):
    events = typed(
        "video",
        [
            ev("VIDEO_WATCHED", "a", video_id="1", course_id="c"),
            ev("VIDEO_WATCHED", "b", video_id="2", course_id="c"),
            ev("VIDEO_WATCHED", "b", video_id="3", course_id="c"),
            ev("VIDEO_WATCHED", "a", video_id="9", course_id=None),
        ],
    )
    got = rows(
        video.student_course_summary(events), "user_id", "course_id", "video_coverage_percentage"
    )
    assert {(r["user_id"], r["course_id"]): r["video_coverage_percentage"] for r in got} == {
        ("a", "c"): Decimal("33.33"),
        ("b", "c"): Decimal("66.67"),
        ("a", None): None,
    }


def test_rates(typed, rows):
    clicks = [ev("NOTIFICATION_CLICKED", "b", notification_type="t", notification_id="n")] * 11
    events = typed(
        "notification",
        [
            ev("NOTIFICATION_CLICKED", "a", notification_type="t", notification_id="n"),
            ev("NOTIFICATION_SENT", "b", notification_type="t", notification_id="n"),
            *clicks,
            *[ev("NOTIFICATION_SENT", "c", notification_type="t", notification_id="n")] * 3,
            ev("NOTIFICATION_CLICKED", "c", notification_type="t", notification_id="n"),
            ev("NOTIFICATION_SENT", "d", notification_type="u", notification_id=None),
            ev("NOTIFICATION_SENT", "e", notification_type=None, notification_id="n"),
            ev("NOTIFICATION_CLICKED", "e", notification_type=None, notification_id="n"),
        ],
    )
    summary = {r.user_id: r.overall_engagement_rate for r in notification.user_summary(events).collect()}
    assert summary["a"] is None and summary["b"] is None and summary["c"] == Decimal("33.33")
    preferences = {
        r.user_id: (r.notifications_received, r.notifications_clicked, r.engagement_rate)
        for r in notification.user_preferences(events).collect()
    }
    assert "a" not in preferences  # never sent anything
    assert preferences["d"] == (0, 0, None)
    assert preferences["e"] == (1, 0, Decimal("0.00"))  # NULL type matches nothing
    rates = {r.notification_type: r for r in notification.click_through_rate(events).collect()}
    assert rates["t"].total_sent == 4 and rates["t"].total_clicked == 13
    assert rates["t"].click_through_rate == Decimal("325.00")
    assert rates[None].total_clicked == 0


def test_course_activity_keeps_unmatched_users(typed, rows):
    events = typed(
        "course",
        [
            ev("COURSE_ENROLLED", "a", course_id="c"),
            ev("COURSE_ENROLLED", "a", course_id="c"),
            ev("DOWNLOAD_MATERIAL", "b", course_id="c", resource_id="r"),
            ev("ACCESS_COURSE_MATERIAL", None, course_id="c", material_id="m"),
            ev("DOWNLOAD_MATERIAL", None, course_id="c", resource_id="r"),
        ],
    )
    got = [tuple(r.values()) for r in rows(course.activity_summary(events))]
    assert sorted(got, key=str) == sorted(
        [("a", 1, 0, 0, 0), ("b", 0, 0, 0, 1), (None, 0, 1, 1, 0), (None, 0, 0, 0, 1)], key=str
    )


def test_repeat_enrolments_stay(typed, rows):
    one = ev("COURSE_ENROLLED", "a", course_id="c", role="student")
    courses = typed("course", [one, one, ev("DOWNLOAD_MATERIAL", "b", course_id="d", role="student")])
    videos = typed("video", [ev("VIDEO_WATCHED", "a", course_id="c", video_id="v", role="student")])
    enrolled = rows(cross_domain.student_course_enrollment(courses, videos))
    assert [(r["student_id"], r["total_videos_watched"]) for r in enrolled] == [("a", 1), ("a", 1)]
    overview = rows(cross_domain.course_overview(courses, videos))
    assert [tuple(r.values()) for r in overview] == [("c", 1, 1, 0)]


def test_only_students_reach_the_cross_domain_views(typed):
    frames = {
        "course": typed("course", [ev("COURSE_ENROLLED", "t", course_id="c", role="teacher")]),
        "video": typed("video", [ev("VIDEO_WATCHED", "a")]),
    }
    assert build_view("course_overview", frames.__getitem__).count() == 0


def test_detailed_starts_from_videos(typed, rows):
    courses = typed(
        "course",
        [
            ev("DOWNLOAD_MATERIAL", "a", "2024-01-02 00:00:00", course_id="c"),
            ev("DOWNLOAD_MATERIAL", "z", course_id="c"),
        ],
    )
    videos = typed(
        "video",
        [
            ev("VIDEO_WATCHED", "a", course_id="c", watch_duration_seconds=90),
            ev("VIDEO_WATCHED", "b", course_id="c"),
        ],
    )
    got = rows(cross_domain.student_course_detailed(courses, videos))
    assert got == [
        {
            "student_id": "a",
            "course_id": "c",
            "videos_watched": 1,
            "materials_downloaded": 1,
            "last_activity_date": dt.datetime(2024, 1, 2),
            "watch_time_minutes": 1.5,
        },
        {
            "student_id": "b",
            "course_id": "c",
            "videos_watched": 1,
            "materials_downloaded": 0,
            "last_activity_date": None,
            "watch_time_minutes": None,
        },
    ]


def test_bad_rows_form_null_groups(typed, rows):
    events = typed("profile", ["{bad", ev("UPDATE_PROFILE", "a", "not-a-time", field_name="f")])
    got = rows(profile.daily_activity(events))
    assert {(r["date"], r["event_type"], r["event_count"]) for r in got} == {
        (None, None, 0),
        (None, "UPDATE_PROFILE", 1),
    }


def test_counts_add_up(spark, sf_dir):
    topics = typed_topics(spark, sf_dir)
    per_hour = build_view("auth_hourly_login_patterns", topics).agg(F.sum("login_count")).first()[0]
    assert per_hour == topics("auth").where("event_type = 'LOGIN'").count()
    per_day = build_view("course_daily_engagement", topics).agg(F.sum("event_count")).first()[0]
    assert per_day == topics("course").where("user_id IS NOT NULL").count()


def test_partitioning_of_the_input_does_not_matter(spark, sf_dir):
    topics = typed_topics(spark, sf_dir)
    for name in ("auth_user_session_metrics", "student_overview", "notification_user_preferences"):
        plain = build_view(name, topics).collect()
        shuffled = build_view(name, lambda t: topics(t).repartition(5, "user_id")).collect()
        assert sorted(map(str, plain)) == sorted(map(str, shuffled))


def test_ranking_order(spark, sf_dir):
    view = build_view("video_popularity", typed_topics(spark, sf_dir)).collect()
    keys = [(-r.unique_viewers, r.video_id, r.course_id) for r in view]
    assert keys == sorted(keys)
