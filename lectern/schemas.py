"""Every schema the package reads or writes, as "name TYPE, ..." text.

One superset schema per topic: an operator selects the columns it needs and
Catalyst prunes the rest, including the unused fields of ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def ddl(text: str) -> T.StructType:
    """Like `StructType.fromDDL`, which needs a running session."""
    fields = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Broker record as stored in the master dataset. `timestamp` is broker time.
RAW = ddl("key STRING, value STRING, topic STRING, timestamp TIMESTAMP")

# The topic names of the event bus.
TOPICS = {
    "auth": "auth_topic",
    "assessment": "assessment_topic",
    "video": "video_topic",
    "course": "course_topic",
    "profile": "profile_topic",
    "notification": "notification_topic",
}

_HEAD = "event_category STRING, event_type STRING, user_id STRING, timestamp STRING"

# The JSON field names and types of each topic.
EVENT = {
    "auth": ddl(
        f"{_HEAD}, role STRING, session_id STRING, email STRING, registration_source STRING"
    ),
    "assessment": ddl(
        f"{_HEAD}, role STRING, course_id STRING, assignment_id STRING, quiz_id STRING,"
        " student_id STRING, assignment_type STRING, file_url STRING, feedback STRING,"
        " score INT, correct_answers INT, total_questions INT"
    ),
    "video": ddl(
        f"{_HEAD}, role STRING, course_id STRING, video_id STRING, session_id STRING,"
        " watch_duration_seconds INT"
    ),
    "course": ddl(
        f"{_HEAD}, role STRING, course_id STRING, material_id STRING, material_type STRING,"
        " resource_id STRING, resource_type STRING"
    ),
    "profile": ddl(f"{_HEAD}, field_name STRING, new_value STRING"),
    "notification": ddl(f"{_HEAD}, notification_type STRING, notification_id STRING"),
}

# What the streaming views read from any of the six topics.
STREAM_EVENT = ddl(
    f"{_HEAD}, role STRING, course_id STRING, video_id STRING, watch_duration_seconds INT"
)

# Keyed serving tables and their keys. Counters stay 64-bit: a 32-bit counter overflows at the
# data volumes this package is written for.
SERVING = {
    "active_users": ddl(
        "window_start TIMESTAMP, window_end TIMESTAMP, active_users BIGINT, source STRING"
    ),
    "course_popularity": ddl(
        "course_id STRING, window_start TIMESTAMP, window_end TIMESTAMP,"
        " interactions BIGINT, views BIGINT"
    ),
    "video_engagement": ddl(
        "video_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, views BIGINT,"
        " unique_viewers BIGINT, total_watch_seconds BIGINT"
    ),
    "course_overview": ddl(
        "course_id STRING, total_enrolled_students BIGINT, total_videos_watched BIGINT,"
        " total_materials_downloaded BIGINT, total_assignments_submitted BIGINT,"
        " total_quizzes_completed BIGINT, avg_assignment_score DOUBLE, avg_quiz_score DOUBLE,"
        " total_interactions BIGINT, last_updated TIMESTAMP"
    ),
    "student_overview": ddl(
        "student_id STRING, total_courses_enrolled BIGINT, total_videos_watched BIGINT,"
        " total_assignments_submitted BIGINT, total_quizzes_completed BIGINT,"
        " total_logins BIGINT, total_materials_downloaded BIGINT, avg_assignment_score DOUBLE,"
        " avg_quiz_score DOUBLE, total_watch_time_minutes DOUBLE, last_login TIMESTAMP,"
        " last_updated TIMESTAMP"
    ),
    "student_course_enrollment": ddl(
        "student_id STRING, course_id STRING, enrollment_date TIMESTAMP, videos_watched BIGINT,"
        " assignments_submitted BIGINT, quizzes_completed BIGINT, materials_downloaded BIGINT,"
        " avg_score DOUBLE, last_activity TIMESTAMP"
    ),
    "student_course_detailed": ddl(
        "student_id STRING, course_id STRING, videos_watched BIGINT, watch_time_minutes DOUBLE,"
        " materials_downloaded BIGINT, assignments_submitted BIGINT, quizzes_completed BIGINT,"
        " avg_assignment_score DOUBLE, avg_quiz_score DOUBLE, total_logins BIGINT,"
        " last_activity TIMESTAMP"
    ),
    "auth_daily_active_users": ddl(
        "date TIMESTAMP, daily_active_users BIGINT, total_sessions BIGINT,"
        " avg_session_duration_minutes DOUBLE"
    ),
    "system_summary": ddl(
        "summary_id STRING, current_active_users BIGINT, total_active_courses BIGINT,"
        " total_students BIGINT, total_courses BIGINT, batch_last_run TIMESTAMP,"
        " speed_layer_status STRING, last_updated TIMESTAMP"
    ),
}

SERVING_KEYS = {
    "active_users": ("window_start", "window_end"),
    "course_popularity": ("course_id", "window_start"),
    "video_engagement": ("video_id", "window_start"),
    "course_overview": ("course_id",),
    "student_overview": ("student_id",),
    "student_course_enrollment": ("student_id", "course_id"),
    "student_course_detailed": ("student_id", "course_id"),
    "auth_daily_active_users": ("date",),
    "system_summary": ("summary_id",),
}
