"""Learning events derived from the generic `events` table, for checks and benchmarks.

Every field is integer arithmetic on event_id, user_id and the number in props,
so another SQL engine can derive the same rows. FIXTURES.md lists the rules. They
are SQL text here: hundreds of Column calls would cost more than the queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.schemas import TOPICS, ddl
from lectern.sources.events import decode_topic

SOURCE_SCHEMA = ddl(
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

# Event vocabulary of the fixture, by domain.
EVENT_TYPES = {
    "auth": ["LOGIN", "LOGOUT", "SIGNUP"],
    "assessment": [
        "VIEW_ASSIGNMENT_FIRST_TIME",
        "SUBMIT_ASSIGNMENT",
        "EDIT_ASSIGNMENT",
        "DELETE_ASSIGNMENT",
        "QUIZ_COMPLETED",
        "VIEW_STUDENT_WORK",
        "GRADE_ASSIGNMENT",
        "ASSIGNMENT_REOPENED",
    ],
    "video": ["VIDEO_WATCHED"],
    "course": [
        "COURSE_ENROLLED",
        "ACCESS_COURSE_MATERIAL",
        "DOWNLOAD_MATERIAL",
        "COURSE_VIEW",
        "ITEM_CLICK",
        "COURSE_DROPPED",
        "COURSE_CREATED",
        "COURSE_DELETED",
    ],
    "profile": [
        "CREATE_PROFILE",
        "UPDATE_PROFILE",
        "PROFILE_PICTURE_UPDATED",
        "PASSWORD_CHANGED",
        "CHANGE_AVATAR",
    ],
    "notification": ["NOTIFICATION_SENT", "NOTIFICATION_OPENED", "NOTIFICATION_CLICKED"],
}
TEACHER_TYPES = [
    "VIEW_STUDENT_WORK",
    "GRADE_ASSIGNMENT",
    "ASSIGNMENT_REOPENED",
    "COURSE_CREATED",
    "COURSE_DELETED",
]
REGISTRATION_SOURCES = ["web", "mobile", "admin"]
ASSIGNMENT_TYPES = ["homework", "project", "essay", "lab"]
WATCH_SECONDS = [30, 60, 120, 300, 600, 1200, 1800]
MATERIAL_TYPES = ["pdf", "slides", "video"]
PROFILE_FIELDS = ["phone_number", "email", "address", "emergency_contact"]
NOTIFICATION_TYPES = [
    "assignment_reminder",
    "grade_posted",
    "course_announcement",
    "deadline_approaching",
    "new_message",
]


def _pick(index: str, items: list) -> str:
    return f"elt(CAST({index} AS INT) + 1, {', '.join(map(repr, items))})"


def _pad(prefix: str, number: str, width: int) -> str:
    return f"concat('{prefix}', lpad(CAST({number} AS STRING), {width}, '0'))"


def _in(column: str, *values: str) -> str:
    return f"{column} IN ({', '.join(map(repr, values))})"


def _when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


_DOMAIN = """CASE WHEN m < 15 THEN 'auth' WHEN m < 40 THEN 'assessment' WHEN m < 75 THEN 'video'
    WHEN m < 93 THEN 'course' WHEN m < 96 THEN 'profile' ELSE 'notification' END"""

_KIND = " ".join(
    [
        "CASE domain",
        *[
            f"WHEN '{name}' THEN {_pick(f'(q + m) % {len(types)}', types)}"
            for name, types in EVENT_TYPES.items()
        ],
        "END",
    ]
)

_TEACHER = f"""{_in("kind", *TEACHER_TYPES)}
    OR ({_in("domain", "auth", "profile", "notification")} AND u % 6 = 0)"""

_IN_COURSE = f"""{_in("domain", "video", "course")} OR
    (domain = 'assessment' AND NOT {_in("kind", "DELETE_ASSIGNMENT", "ASSIGNMENT_REOPENED")})"""

_SECONDS = f"get(array({', '.join(map(str, WATCH_SECONDS))}), CAST(k % 7 AS INT))"

_USER = f"IF(teacher, {_pad('GV', 'u % 10', 6)}, {_pad('SV', 'u', 6)})"

# JSON fields of a record, in order; a field whose rule gives NULL is left out.
_FIELDS = {
    "event_category": "upper(domain)",
    "event_type": "kind",
    "user_id": _USER,
    "role": "IF(teacher, 'teacher', 'student')",
    "timestamp": "IF(e % 499 = 7, 'not-a-time', date_format(ts, 'yyyy-MM-dd HH:mm:ss'))",
    "session_id": f"""CASE WHEN {_in("kind", "LOGIN", "LOGOUT")}
        THEN concat('S', u, '-', dayofmonth(ts)) WHEN domain = 'video' THEN concat('V', e) END""",
    "registration_source": _when("kind = 'SIGNUP'", _pick("k % 3", REGISTRATION_SOURCES)),
    "course_id": _when(_IN_COURSE, _pad("COURSE", "k % 20 + 1", 3)),
    "assignment_id": _when(
        "domain = 'assessment' AND kind <> 'QUIZ_COMPLETED'",
        _pad("ASM", "(u % 25) * 4 + k % 4 + 1", 3),
    ),
    "quiz_id": _when("kind = 'QUIZ_COMPLETED'", _pad("QUIZ", "k % 50 + 1", 3)),
    "assignment_type": _when(
        _in("kind", "VIEW_ASSIGNMENT_FIRST_TIME", "SUBMIT_ASSIGNMENT"),
        _pick("k % 4", ASSIGNMENT_TYPES),
    ),
    "correct_answers": _when("kind = 'QUIZ_COMPLETED'", "5 + k % 46"),
    "score": _when("kind = 'GRADE_ASSIGNMENT'", "40 + k % 61"),
    "student_id": _when(
        _in("kind", "VIEW_STUDENT_WORK", "GRADE_ASSIGNMENT", "ASSIGNMENT_REOPENED"),
        _pad("SV", "(u + k) % 150", 6),
    ),
    "video_id": _when("domain = 'video'", _pad("VID", "(u + k) % 200 + 1", 3)),
    "watch_duration_seconds": _when("domain = 'video'", _SECONDS),
    "material_id": _when(
        _in("kind", "ACCESS_COURSE_MATERIAL", "DOWNLOAD_MATERIAL"), "concat('MAT', k % 40 + 1)"
    ),
    "material_type": _when("kind = 'ACCESS_COURSE_MATERIAL'", _pick("k % 3", MATERIAL_TYPES)),
    "resource_id": _when("kind = 'DOWNLOAD_MATERIAL'", "concat('RES', k % 40 + 1)"),
    "field_name": _when("kind = 'UPDATE_PROFILE'", _pick("k % 4", PROFILE_FIELDS)),
    "notification_type": _when("domain = 'notification'", _pick("k % 5", NOTIFICATION_TYPES)),
    "notification_id": _when("domain = 'notification'", "concat('NOTIF', k)"),
}

_VALUE = f"to_json(named_struct({', '.join(f"'{n}', {rule}" for n, rule in _FIELDS.items())}))"


def derive(events: DataFrame) -> DataFrame:
    """`events` rows (batch or stream) to raw records: key, value, topic, timestamp."""
    numbers = events.selectExpr(
        "event_id AS e",
        "user_id AS u",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "event_id % 100 AS m",
        "event_id DIV 100 AS q",
        "ts",
    )
    kinds = numbers.selectExpr("*", f"{_DOMAIN} AS domain").selectExpr("*", f"{_KIND} AS kind")
    return kinds.selectExpr("*", f"{_TEACHER} AS teacher").selectExpr(
        f"{_USER} AS key",
        f"IF(e % 997 = 5, '{{bad', {_VALUE}) AS value",
        "concat(domain, '_topic') AS topic",
        "CAST(ts AS TIMESTAMP) AS timestamp",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark.read.schema(SOURCE_SCHEMA).parquet(f"{sf_dir}/events.parquet"))


def spread(events: DataFrame) -> DataFrame:
    """The same `events` rows, dealt to tasks by size and not by the file's row groups.

    A record costs far more to derive than its row to read, and a scan has no more tasks
    than row groups. For what derives whole topics; AQE sizes the shuffle.
    """
    return events.repartition("event_id")


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`raw_events`, derived by as many tasks as there are cores for it."""
    return derive(spread(spark.read.schema(SOURCE_SCHEMA).parquet(f"{sf_dir}/events.parquet")))


def typed_topics(spark: SparkSession, sf_dir: str):
    """Typed frame per topic name, decoded from the derived raw records."""
    raw = raw_events(spark, sf_dir)
    return lambda name: decode_topic(raw.where(F.col("topic") == TOPICS[name]), name)
