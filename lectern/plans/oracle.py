"""DuckDB statements equivalent to the catalog's queries, for cross-checking.

The typed rows are derived straight from `events`, without JSON, so the encode
and decode steps of the Spark side are checked too. Joins are written out plainly
here where the Spark side replaces them by aggregates.
"""

from __future__ import annotations

_DERIVED = """
n AS (
  SELECT event_id AS e, user_id AS u, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id % 100 AS m, event_id // 100 AS q,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, CAST(day(ts) AS INTEGER) AS d
  FROM events
),
domains AS (
  SELECT *, CASE WHEN m < 15 THEN 'auth' WHEN m < 40 THEN 'assessment' WHEN m < 75 THEN 'video'
                 WHEN m < 93 THEN 'course' WHEN m < 96 THEN 'profile' ELSE 'notification' END AS dom
  FROM n
),
kinds AS (
  SELECT *, CASE dom
    WHEN 'auth' THEN (['LOGIN', 'LOGOUT', 'SIGNUP'])[(q + m) % 3 + 1]
    WHEN 'assessment' THEN (['VIEW_ASSIGNMENT_FIRST_TIME', 'SUBMIT_ASSIGNMENT', 'EDIT_ASSIGNMENT',
      'DELETE_ASSIGNMENT', 'QUIZ_COMPLETED', 'VIEW_STUDENT_WORK', 'GRADE_ASSIGNMENT',
      'ASSIGNMENT_REOPENED'])[(q + m) % 8 + 1]
    WHEN 'video' THEN 'VIDEO_WATCHED'
    WHEN 'course' THEN (['COURSE_ENROLLED', 'ACCESS_COURSE_MATERIAL', 'DOWNLOAD_MATERIAL',
      'COURSE_VIEW', 'ITEM_CLICK', 'COURSE_DROPPED', 'COURSE_CREATED', 'COURSE_DELETED'])[(q + m) % 8 + 1]
    WHEN 'profile' THEN (['CREATE_PROFILE', 'UPDATE_PROFILE', 'PROFILE_PICTURE_UPDATED',
      'PASSWORD_CHANGED', 'CHANGE_AVATAR'])[(q + m) % 5 + 1]
    ELSE (['NOTIFICATION_SENT', 'NOTIFICATION_OPENED', 'NOTIFICATION_CLICKED'])[(q + m) % 3 + 1]
    END AS kind
  FROM domains
),
roles AS (
  SELECT *, kind IN ('VIEW_STUDENT_WORK', 'GRADE_ASSIGNMENT', 'ASSIGNMENT_REOPENED',
                     'COURSE_CREATED', 'COURSE_DELETED')
            OR (dom IN ('auth', 'profile', 'notification') AND u % 6 = 0) AS teacher
  FROM kinds
),
fields AS (
  SELECT e, ts, dom || '_topic' AS topic, e % 997 = 5 AS bad,
    CASE WHEN teacher THEN 'GV' || lpad(CAST(u % 10 AS VARCHAR), 6, '0')
         ELSE 'SV' || lpad(CAST(u AS VARCHAR), 6, '0') END AS user_id,
    upper(dom) AS event_category, kind AS event_type,
    CASE WHEN teacher THEN 'teacher' ELSE 'student' END AS role,
    CASE WHEN e % 499 = 7 THEN 'not-a-time' ELSE t END AS "timestamp",
    CASE WHEN kind IN ('LOGIN', 'LOGOUT') THEN 'S' || u || '-' || d
         WHEN dom = 'video' THEN 'V' || e END AS session_id,
    CASE WHEN kind = 'SIGNUP' THEN (['web', 'mobile', 'admin'])[k % 3 + 1] END AS registration_source,
    CASE WHEN dom IN ('video', 'course') OR (dom = 'assessment'
              AND kind NOT IN ('DELETE_ASSIGNMENT', 'ASSIGNMENT_REOPENED'))
         THEN 'COURSE' || lpad(CAST(k % 20 + 1 AS VARCHAR), 3, '0') END AS course_id,
    CASE WHEN dom = 'assessment' AND kind <> 'QUIZ_COMPLETED'
         THEN 'ASM' || lpad(CAST((u % 25) * 4 + k % 4 + 1 AS VARCHAR), 3, '0') END AS assignment_id,
    CASE WHEN kind = 'QUIZ_COMPLETED'
         THEN 'QUIZ' || lpad(CAST(k % 50 + 1 AS VARCHAR), 3, '0') END AS quiz_id,
    CASE WHEN kind IN ('VIEW_ASSIGNMENT_FIRST_TIME', 'SUBMIT_ASSIGNMENT')
         THEN (['homework', 'project', 'essay', 'lab'])[k % 4 + 1] END AS assignment_type,
    CASE WHEN kind = 'QUIZ_COMPLETED' THEN CAST(5 + k % 46 AS INTEGER) END AS correct_answers,
    CASE WHEN kind = 'GRADE_ASSIGNMENT' THEN CAST(40 + k % 61 AS INTEGER) END AS score,
    CASE WHEN kind IN ('VIEW_STUDENT_WORK', 'GRADE_ASSIGNMENT', 'ASSIGNMENT_REOPENED')
         THEN 'SV' || lpad(CAST((u + k) % 150 AS VARCHAR), 6, '0') END AS student_id,
    CASE WHEN dom = 'video'
         THEN 'VID' || lpad(CAST((u + k) % 200 + 1 AS VARCHAR), 3, '0') END AS video_id,
    CASE WHEN dom = 'video' THEN CAST(([30, 60, 120, 300, 600, 1200, 1800])[k % 7 + 1] AS INTEGER)
         END AS watch_duration_seconds,
    CASE WHEN kind IN ('ACCESS_COURSE_MATERIAL', 'DOWNLOAD_MATERIAL') THEN 'MAT' || (k % 40 + 1) END
         AS material_id,
    CASE WHEN kind = 'ACCESS_COURSE_MATERIAL' THEN (['pdf', 'slides', 'video'])[k % 3 + 1] END
         AS material_type,
    CASE WHEN kind = 'DOWNLOAD_MATERIAL' THEN 'RES' || (k % 40 + 1) END AS resource_id,
    CASE WHEN kind = 'UPDATE_PROFILE'
         THEN (['phone_number', 'email', 'address', 'emergency_contact'])[k % 4 + 1] END AS field_name,
    CASE WHEN dom = 'notification' THEN (['assignment_reminder', 'grade_posted',
         'course_announcement', 'deadline_approaching', 'new_message'])[k % 5 + 1] END
         AS notification_type,
    CASE WHEN dom = 'notification' THEN 'NOTIF' || k END AS notification_id
  FROM roles
)"""

_TEXT_FIELDS = [
    "event_category",
    "event_type",
    "user_id",
    "role",
    "timestamp",
    "session_id",
    "registration_source",
    "course_id",
    "assignment_id",
    "quiz_id",
    "assignment_type",
    "correct_answers",
    "score",
    "student_id",
    "video_id",
    "watch_duration_seconds",
    "material_id",
    "material_type",
    "resource_id",
    "field_name",
    "notification_type",
    "notification_id",
]
_INT_FIELDS = {"correct_answers", "score", "watch_duration_seconds"}


def _json(names: list[str]) -> str:
    """JSON text of the non-NULL fields, in order; the values need no escaping."""
    parts = [
        f"""'"{n}":' || "{n}\"""" if n in _INT_FIELDS else f"""'"{n}":"' || "{n}" || '"'"""
        for n in names
    ]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


_RAW = f"""
raw AS (
  SELECT user_id AS key, CASE WHEN bad THEN '{{bad' ELSE {_json(_TEXT_FIELDS)} END AS value,
         topic, ts AS "timestamp"
  FROM fields
)"""

_TYPED = (
    "\ntyped AS (\n  SELECT e, topic, "
    + ", ".join(f'CASE WHEN NOT bad THEN "{n}" END AS "{n}"' for n in _TEXT_FIELDS)
    + """,
    CASE WHEN NOT bad THEN TRY_CAST("timestamp" AS TIMESTAMP) END AS tp,
    strftime(CASE WHEN NOT bad THEN TRY_CAST("timestamp" AS TIMESTAMP) END, '%Y-%m-%d') AS date
  FROM fields
),
auth AS (SELECT * FROM typed WHERE topic = 'auth_topic'),
assessment AS (SELECT * FROM typed WHERE topic = 'assessment_topic'),
video AS (SELECT * FROM typed WHERE topic = 'video_topic'),
course AS (SELECT * FROM typed WHERE topic = 'course_topic'),
profile AS (SELECT * FROM typed WHERE topic = 'profile_topic'),
notification AS (SELECT * FROM typed WHERE topic = 'notification_topic'),
s_auth AS (SELECT * FROM auth WHERE role = 'student'),
s_assessment AS (SELECT * FROM assessment WHERE role = 'student'),
s_video AS (SELECT * FROM video WHERE role = 'student'),
s_course AS (SELECT * FROM course WHERE role = 'student')"""
)

# One entry per batch view, over the CTEs above.
_VIEW = {
    "auth_daily_active_users": """
SELECT date, count(DISTINCT user_id) AS daily_active_users,
       count(DISTINCT session_id) AS total_sessions
FROM auth WHERE event_type = 'LOGIN' GROUP BY date""",
    "auth_hourly_login_patterns": """
SELECT date, CAST(hour(tp) AS INTEGER) AS hour, count(user_id) AS login_count
FROM auth WHERE event_type = 'LOGIN' GROUP BY date, CAST(hour(tp) AS INTEGER)""",
    "auth_user_session_metrics": """
SELECT user_id, count(*) AS total_sessions,
       CAST(sum(s) AS DOUBLE) / (count(s) * 60) AS avg_session_duration_minutes,
       min(s) / 60 AS min_session_duration_minutes, max(s) / 60 AS max_session_duration_minutes,
       CAST(sum(s) AS DOUBLE) / 60 AS total_time_online_minutes
FROM (SELECT i.user_id, date_diff('second', i.tp, o.tp) AS s
      FROM auth i JOIN auth o ON i.session_id = o.session_id
      WHERE i.event_type = 'LOGIN' AND o.event_type = 'LOGOUT')
GROUP BY user_id""",
    "auth_user_activity_summary": """
SELECT user_id, role, count(CASE WHEN event_type = 'LOGIN' THEN 1 END) AS total_logins,
       count(CASE WHEN event_type = 'LOGOUT' THEN 1 END) AS total_logouts,
       min(tp) AS first_activity, max(tp) AS last_activity,
       count(DISTINCT session_id) AS unique_sessions
FROM auth GROUP BY user_id, role""",
    "auth_registration_analytics": """
SELECT date, registration_source, role, count(user_id) AS new_signups
FROM auth WHERE event_type = 'SIGNUP' GROUP BY date, registration_source, role""",
    "assessment_student_submissions": """
SELECT user_id, course_id, count(DISTINCT assignment_id) AS total_assignments_submitted,
       count(assignment_id) AS total_submissions, min(tp) AS first_submission,
       max(tp) AS last_submission
FROM assessment WHERE event_type = 'SUBMIT_ASSIGNMENT' GROUP BY user_id, course_id""",
    "assessment_engagement_timeline": """
SELECT user_id, course_id, count(*) AS assignments_completed,
       CAST(sum(s) AS DOUBLE) / (count(s) * 3600) AS avg_hours_to_submit,
       min(s) / 3600 AS min_hours_to_submit, max(s) / 3600 AS max_hours_to_submit
FROM (SELECT v.user_id, v.course_id, date_diff('second', v.tp, s.tp) AS s
      FROM assessment v JOIN assessment s
        ON v.user_id = s.user_id AND v.assignment_id = s.assignment_id
      WHERE v.event_type = 'VIEW_ASSIGNMENT_FIRST_TIME' AND s.event_type = 'SUBMIT_ASSIGNMENT')
GROUP BY user_id, course_id""",
    "assessment_quiz_performance": """
SELECT user_id, course_id, count(quiz_id) AS total_quizzes_completed,
       avg(correct_answers) AS avg_correct_answers,
       CAST(sum(correct_answers) AS BIGINT) AS total_correct_answers,
       min(correct_answers) AS min_correct_answers, max(correct_answers) AS max_correct_answers
FROM assessment WHERE event_type = 'QUIZ_COMPLETED' GROUP BY user_id, course_id""",
    "assessment_grading_stats": """
SELECT student_id, course_id, count(assignment_id) AS total_assignments_graded,
       avg(score) AS avg_assignment_score, min(score) AS min_assignment_score,
       max(score) AS max_assignment_score, CAST(sum(score) AS BIGINT) AS total_assignment_score
FROM assessment WHERE event_type = 'GRADE_ASSIGNMENT' GROUP BY student_id, course_id""",
    "assessment_teacher_workload": """
SELECT user_id, course_id, total_works_viewed, total_assignments_graded, avg_score_given
FROM (SELECT user_id, course_id, count(student_id) AS total_works_viewed
      FROM assessment WHERE event_type = 'VIEW_STUDENT_WORK' GROUP BY user_id, course_id) v
FULL JOIN (SELECT user_id, course_id, count(student_id) AS total_assignments_graded,
                  avg(score) AS avg_score_given
           FROM assessment WHERE event_type = 'GRADE_ASSIGNMENT' GROUP BY user_id, course_id) g
USING (user_id, course_id)""",
    "assessment_submission_distribution": """
SELECT date, course_id, assignment_type, count(user_id) AS submissions_count,
       count(DISTINCT user_id) AS unique_students
FROM assessment WHERE event_type = 'SUBMIT_ASSIGNMENT' GROUP BY date, course_id, assignment_type""",
    "assessment_student_overall_performance": """
SELECT user_id, course_id, quizzes_completed, avg_quiz_correct, assignments_graded,
       avg_assignment_score
FROM (SELECT user_id, course_id, count(quiz_id) AS quizzes_completed,
             avg(correct_answers) AS avg_quiz_correct
      FROM assessment WHERE event_type = 'QUIZ_COMPLETED' GROUP BY user_id, course_id) z
FULL JOIN (SELECT student_id AS user_id, course_id, count(assignment_id) AS assignments_graded,
                  avg(score) AS avg_assignment_score
           FROM assessment WHERE event_type = 'GRADE_ASSIGNMENT' GROUP BY student_id, course_id) g
USING (user_id, course_id)""",
    "video_total_watch_time": """
SELECT user_id, video_id, course_id,
       CAST(sum(watch_duration_seconds) AS BIGINT) AS total_watch_seconds,
       count(session_id) AS total_watch_sessions,
       avg(watch_duration_seconds) AS avg_watch_duration_seconds,
       max(watch_duration_seconds) AS longest_session_seconds,
       min(watch_duration_seconds) AS shortest_session_seconds,
       CAST(sum(watch_duration_seconds) AS DOUBLE) / 60 AS total_watch_minutes,
       CAST(sum(watch_duration_seconds) AS DOUBLE) / 3600 AS total_watch_hours
FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY user_id, video_id, course_id""",
    "video_student_engagement": """
SELECT user_id, course_id, count(DISTINCT video_id) AS unique_videos_watched,
       CAST(sum(watch_duration_seconds) AS BIGINT) AS total_watch_seconds,
       count(video_id) AS total_video_events,
       avg(watch_duration_seconds) AS avg_watch_duration_seconds,
       CAST(sum(watch_duration_seconds) AS DOUBLE) / 3600 AS total_watch_hours
FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY user_id, course_id""",
    "video_popularity": """
SELECT video_id, course_id, count(DISTINCT user_id) AS unique_viewers,
       CAST(sum(watch_duration_seconds) AS BIGINT) AS total_views_seconds,
       count(user_id) AS total_view_events,
       avg(watch_duration_seconds) AS avg_view_duration_seconds,
       CAST(sum(watch_duration_seconds) AS DOUBLE) / 3600 AS total_views_hours
FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY video_id, course_id""",
    "video_daily_engagement": """
SELECT date, course_id, count(DISTINCT user_id) AS active_video_watchers,
       count(DISTINCT video_id) AS unique_videos_watched,
       CAST(sum(watch_duration_seconds) AS BIGINT) AS total_watch_seconds,
       count(user_id) AS total_watch_events,
       CAST(sum(watch_duration_seconds) AS DOUBLE) / 3600 AS total_watch_hours
FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY date, course_id""",
    "video_course_metrics": """
SELECT course_id, count(DISTINCT user_id) AS total_students_watching,
       count(DISTINCT video_id) AS total_videos_in_course,
       CAST(sum(watch_duration_seconds) AS BIGINT) AS total_course_watch_seconds,
       CAST(sum(watch_duration_seconds) AS DOUBLE) / 3600 AS total_course_watch_hours
FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY course_id""",
    "video_student_course_summary": """
SELECT s.user_id, s.course_id, videos_watched_count, total_watch_seconds, total_sessions,
       total_watch_hours, total_videos_in_course,
       TRY_CAST(videos_watched_count / nullif(total_videos_in_course, 0) * 100 AS DECIMAL(5, 2))
         AS video_coverage_percentage
FROM (SELECT user_id, course_id, count(DISTINCT video_id) AS videos_watched_count,
             CAST(sum(watch_duration_seconds) AS BIGINT) AS total_watch_seconds,
             count(session_id) AS total_sessions,
             CAST(sum(watch_duration_seconds) AS DOUBLE) / 3600 AS total_watch_hours
      FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY user_id, course_id) s
LEFT JOIN (SELECT course_id, count(DISTINCT video_id) AS total_videos_in_course
           FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY course_id) c
  ON s.course_id = c.course_id""",
    "video_drop_off_indicators": """
SELECT video_id, course_id, count(user_id) AS total_views,
       avg(watch_duration_seconds) AS avg_watch_duration,
       min(watch_duration_seconds) AS min_watch_duration,
       count(DISTINCT user_id) AS unique_viewers,
       CASE WHEN avg(watch_duration_seconds) < 60 THEN 'High Risk'
            WHEN avg(watch_duration_seconds) < 180 THEN 'Medium Risk'
            ELSE 'Good Engagement' END AS potential_drop_off
FROM video WHERE event_type = 'VIDEO_WATCHED' GROUP BY video_id, course_id""",
    "course_enrollment_stats": """
SELECT date, course_id, count(user_id) AS new_enrollments,
       count(DISTINCT user_id) AS unique_new_students
FROM course WHERE event_type = 'COURSE_ENROLLED' GROUP BY date, course_id""",
    "course_material_access": """
SELECT user_id, course_id, count(material_id) AS total_material_accesses,
       count(DISTINCT material_id) AS unique_materials_accessed, min(tp) AS first_access,
       max(tp) AS last_access
FROM course WHERE event_type = 'ACCESS_COURSE_MATERIAL' GROUP BY user_id, course_id""",
    "course_material_popularity": """
SELECT course_id, material_id, material_type, count(DISTINCT user_id) AS unique_accessors,
       count(user_id) AS total_accesses
FROM course WHERE event_type = 'ACCESS_COURSE_MATERIAL'
GROUP BY course_id, material_id, material_type""",
    "course_download_analytics": """
SELECT user_id, course_id, count(resource_id) AS total_downloads,
       count(DISTINCT resource_id) AS unique_resources_downloaded
FROM course WHERE event_type = 'DOWNLOAD_MATERIAL' GROUP BY user_id, course_id""",
    "course_resource_download_stats": """
SELECT course_id, resource_id, count(DISTINCT user_id) AS unique_downloaders,
       count(user_id) AS total_download_count
FROM course WHERE event_type = 'DOWNLOAD_MATERIAL' GROUP BY course_id, resource_id""",
    "course_activity_summary": """
SELECT user_id, coalesce(courses_enrolled, 0) AS courses_enrolled,
       coalesce(total_material_accesses, 0) AS total_material_accesses,
       coalesce(courses_with_material_access, 0) AS courses_with_material_access,
       coalesce(total_downloads, 0) AS total_downloads
FROM (SELECT user_id, count(DISTINCT course_id) AS courses_enrolled
      FROM course WHERE event_type = 'COURSE_ENROLLED' GROUP BY user_id) e
FULL JOIN (SELECT user_id, count(material_id) AS total_material_accesses,
                  count(DISTINCT course_id) AS courses_with_material_access
           FROM course WHERE event_type = 'ACCESS_COURSE_MATERIAL' GROUP BY user_id) a
  USING (user_id)
FULL JOIN (SELECT user_id, count(resource_id) AS total_downloads
           FROM course WHERE event_type = 'DOWNLOAD_MATERIAL' GROUP BY user_id) d
  USING (user_id)""",
    "course_daily_engagement": """
SELECT date, course_id, event_type, count(DISTINCT user_id) AS unique_users,
       count(user_id) AS event_count
FROM course GROUP BY date, course_id, event_type""",
    "course_overall_metrics": """
SELECT course_id, count(CASE WHEN event_type = 'COURSE_ENROLLED' THEN 1 END) AS total_enrollments,
       count(CASE WHEN event_type = 'ACCESS_COURSE_MATERIAL' THEN 1 END) AS total_material_accesses,
       count(CASE WHEN event_type = 'DOWNLOAD_MATERIAL' THEN 1 END) AS total_downloads,
       count(DISTINCT user_id) AS unique_students_interacting
FROM course GROUP BY course_id""",
    "profile_update_frequency": """
SELECT user_id, count(user_id) AS total_profile_updates, min(tp) AS first_update,
       max(tp) AS last_update
FROM profile WHERE event_type = 'UPDATE_PROFILE' GROUP BY user_id""",
    "profile_field_changes": """
SELECT field_name, count(user_id) AS total_updates, count(DISTINCT user_id) AS unique_users_updating
FROM profile WHERE event_type = 'UPDATE_PROFILE' GROUP BY field_name""",
    "profile_avatar_changes": """
SELECT user_id, count(user_id) AS avatar_changes_count, min(tp) AS first_change,
       max(tp) AS last_change
FROM profile WHERE event_type = 'CHANGE_AVATAR' GROUP BY user_id""",
    "profile_daily_activity": """
SELECT date, event_type, count(DISTINCT user_id) AS unique_users, count(user_id) AS event_count
FROM profile GROUP BY date, event_type""",
    "notification_delivery_stats": """
SELECT notification_type, count(user_id) AS total_sent, count(DISTINCT user_id) AS unique_recipients
FROM notification WHERE event_type = 'NOTIFICATION_SENT' GROUP BY notification_type""",
    "notification_engagement": """
SELECT user_id, notification_type, count(notification_id) AS notifications_clicked
FROM notification WHERE event_type = 'NOTIFICATION_CLICKED' GROUP BY user_id, notification_type""",
    "notification_click_through_rate": """
SELECT s.notification_type, total_sent, coalesce(total_clicked, 0) AS total_clicked,
       TRY_CAST(coalesce(total_clicked, 0) / nullif(total_sent, 0) * 100 AS DECIMAL(5, 2))
         AS click_through_rate
FROM (SELECT notification_type, count(notification_id) AS total_sent
      FROM notification WHERE event_type = 'NOTIFICATION_SENT' GROUP BY notification_type) s
LEFT JOIN (SELECT notification_type, count(notification_id) AS total_clicked
           FROM notification WHERE event_type = 'NOTIFICATION_CLICKED' GROUP BY notification_type) c
  ON s.notification_type = c.notification_type""",
    "notification_user_preferences": """
SELECT s.user_id, s.notification_type, notifications_received,
       coalesce(notifications_clicked, 0) AS notifications_clicked,
       TRY_CAST(coalesce(notifications_clicked, 0) / nullif(notifications_received, 0) * 100
                AS DECIMAL(5, 2)) AS engagement_rate
FROM (SELECT user_id, notification_type, count(notification_id) AS notifications_received
      FROM notification WHERE event_type = 'NOTIFICATION_SENT'
      GROUP BY user_id, notification_type) s
LEFT JOIN (SELECT user_id, notification_type, count(notification_id) AS notifications_clicked
           FROM notification WHERE event_type = 'NOTIFICATION_CLICKED'
           GROUP BY user_id, notification_type) c
  ON s.user_id = c.user_id AND s.notification_type = c.notification_type""",
    "notification_daily_activity": """
SELECT date, event_type, notification_type, count(DISTINCT user_id) AS unique_users,
       count(notification_id) AS event_count
FROM notification GROUP BY date, event_type, notification_type""",
    "notification_user_summary": """
SELECT user_id, total_received, total_clicked,
       TRY_CAST(total_clicked / nullif(total_received, 0) * 100 AS DECIMAL(5, 2))
         AS overall_engagement_rate
FROM (SELECT user_id, count(CASE WHEN event_type = 'NOTIFICATION_SENT' THEN 1 END) AS total_received,
             count(CASE WHEN event_type = 'NOTIFICATION_CLICKED' THEN 1 END) AS total_clicked
      FROM notification GROUP BY user_id)""",
    "course_overview": """
SELECT e.course_id, total_enrolled_students, coalesce(v.c, 0) AS total_videos_watched,
       coalesce(d.c, 0) AS total_materials_downloaded
FROM (SELECT course_id, count(DISTINCT user_id) AS total_enrolled_students
      FROM s_course WHERE event_type = 'COURSE_ENROLLED' GROUP BY course_id) e
LEFT JOIN (SELECT course_id, count(*) AS c FROM s_video GROUP BY course_id) v
  ON e.course_id = v.course_id
LEFT JOIN (SELECT course_id, count(*) AS c FROM s_course
           WHERE event_type = 'DOWNLOAD_MATERIAL' GROUP BY course_id) d
  ON e.course_id = d.course_id""",
    "student_overview": """
SELECT e.user_id AS student_id, total_courses_enrolled, coalesce(v.c, 0) AS total_videos_watched,
       coalesce(a.c, 0) AS total_assignments_submitted,
       coalesce(a.score, 0.0) AS avg_assignment_score, coalesce(l.c, 0) AS total_logins
FROM (SELECT user_id, count(DISTINCT course_id) AS total_courses_enrolled
      FROM s_course WHERE event_type = 'COURSE_ENROLLED' GROUP BY user_id) e
LEFT JOIN (SELECT user_id, count(*) AS c FROM s_video GROUP BY user_id) v ON e.user_id = v.user_id
LEFT JOIN (SELECT user_id, count(*) AS c, avg(score) AS score FROM s_assessment
           WHERE event_type = 'SUBMIT_ASSIGNMENT' GROUP BY user_id) a ON e.user_id = a.user_id
LEFT JOIN (SELECT user_id, count(*) AS c FROM s_auth
           WHERE event_type = 'LOGIN' GROUP BY user_id) l ON e.user_id = l.user_id""",
    "student_course_enrollment": """
SELECT e.user_id AS student_id, e.course_id, e.tp AS enrollment_date,
       coalesce(v.c, 0) AS total_videos_watched
FROM (SELECT * FROM s_course WHERE event_type = 'COURSE_ENROLLED') e
LEFT JOIN (SELECT user_id, course_id, count(*) AS c FROM s_video GROUP BY user_id, course_id) v
  ON e.user_id = v.user_id AND e.course_id = v.course_id""",
    "student_course_detailed": """
SELECT v.user_id AS student_id, v.course_id, videos_watched,
       coalesce(d.c, 0) AS materials_downloaded, last_activity_date,
       CAST(s AS DOUBLE) / 60 AS watch_time_minutes
FROM (SELECT user_id, course_id, count(*) AS videos_watched, sum(watch_duration_seconds) AS s
      FROM s_video GROUP BY user_id, course_id) v
LEFT JOIN (SELECT user_id, course_id, count(*) AS c FROM s_course
           WHERE event_type = 'DOWNLOAD_MATERIAL' GROUP BY user_id, course_id) d
  ON v.user_id = d.user_id AND v.course_id = d.course_id
LEFT JOIN (SELECT user_id, course_id, max(tp) AS last_activity_date
           FROM s_course GROUP BY user_id, course_id) a
  ON v.user_id = a.user_id AND v.course_id = a.course_id""",
}


def _sliding(length: int, slide: int) -> str:
    """Active users in windows of `length` seconds starting every `slide` seconds."""
    steps = length // slide
    return f"""
SELECT w AS start, w + INTERVAL {length} SECOND AS "end", count(DISTINCT user_id) AS active_users
FROM (SELECT time_bucket(INTERVAL {slide} SECOND, tp, TIMESTAMP '2000-01-01')
               - to_seconds({slide} * i) AS w, user_id
      FROM typed, range({steps}) AS r(i)
      WHERE event_type = 'LOGIN' AND tp IS NOT NULL)
GROUP BY w"""


def _tumbling(minutes: int, key: str, count: str, condition: str) -> str:
    return f"""
SELECT w AS start, w + INTERVAL {minutes} MINUTE AS "end", {key}, count(*) AS {count}
FROM (SELECT time_bucket(INTERVAL {minutes} MINUTE, tp, TIMESTAMP '2000-01-01') AS w, {key}
      FROM typed WHERE tp IS NOT NULL AND {condition})
GROUP BY w, {key}"""


_WATCHED = "event_category = 'VIDEO' AND event_type = 'VIDEO_WATCHED'"
_IN_COURSE = "course_id IS NOT NULL"

_WINDOWED = {
    "speed_active_users": _sliding(60, 30),
    "speed_active_users_5min": _sliding(300, 60),
    "speed_course_popularity": _tumbling(1, "course_id", "interactions", _IN_COURSE),
    "speed_course_popularity_15min": _tumbling(15, "course_id", "interactions", _IN_COURSE),
    "speed_video_engagement": _tumbling(1, "video_id", "views", _WATCHED),
    "speed_video_engagement_1h": _tumbling(60, "video_id", "views", _WATCHED),
}

_SPEED_TABLE = {
    "active_users": (
        'SELECT start AS window_start, "end" AS window_end, active_users, \'speed\' AS source'
        f" FROM ({_WINDOWED['speed_active_users']})"
    ),
    "course_popularity": (
        'SELECT course_id, start AS window_start, "end" AS window_end, interactions,'
        " CAST(0 AS BIGINT) AS views"
        f" FROM ({_WINDOWED['speed_course_popularity']})"
    ),
    "video_engagement": (
        'SELECT video_id, start AS window_start, "end" AS window_end, views,'
        " CAST(0 AS BIGINT) AS unique_viewers, CAST(0 AS BIGINT) AS total_watch_seconds"
        f" FROM ({_WINDOWED['speed_video_engagement']})"
    ),
}

_VIEW_CTES = ",".join(
    [
        f"\nv_{name} AS ({_VIEW[name]})"
        for name in (
            "course_overview",
            "student_overview",
            "student_course_enrollment",
            "student_course_detailed",
            "auth_daily_active_users",
        )
    ]
    + [f"\n{name} AS ({sql})" for name, sql in _SPEED_TABLE.items()]
    + ["\nnow AS (SELECT max(tp) AS as_of FROM typed)"]
)

_ZERO = "CAST(0 AS BIGINT)"
_ENROLLED = f"""
SELECT student_id, course_id, max(enrollment_date) AS enrollment_date,
       max(total_videos_watched) AS videos_watched, {_ZERO} AS assignments_submitted,
       {_ZERO} AS quizzes_completed, {_ZERO} AS materials_downloaded,
       CAST(0 AS DOUBLE) AS avg_score, CAST(NULL AS TIMESTAMP) AS last_activity
FROM v_student_course_enrollment
WHERE student_id IS NOT NULL AND course_id IS NOT NULL GROUP BY student_id, course_id"""


def _hours(n: int) -> str:
    return f"(SELECT as_of - INTERVAL {n} HOUR FROM now)"


def _recent(hours: int) -> str:
    return f"""
SELECT (SELECT CAST(coalesce(sum(views), 0) AS BIGINT) FROM video_engagement
        WHERE window_start >= {_hours(hours)}) AS videos_watched,
       (SELECT CAST(coalesce(sum(interactions), 0) AS BIGINT) FROM course_popularity
        WHERE window_start >= {_hours(hours)}) AS course_interactions,
       CAST({hours} AS INTEGER) AS time_period_hours"""


_DISTRIBUTION = """
SELECT count(CASE WHEN t > 50 THEN 1 END) AS highly_active,
       count(CASE WHEN t >= 10 AND t <= 50 THEN 1 END) AS moderately_active,
       count(CASE WHEN t >= 1 AND t < 10 THEN 1 END) AS low_activity,
       count(CASE WHEN t = 0 THEN 1 END) AS inactive
FROM (SELECT total_videos_watched + total_assignments_submitted + total_logins AS t
      FROM v_student_overview)"""

_BATCH_STATS = """
SELECT CAST(coalesce(sum(total_videos_watched), 0) AS BIGINT) AS total_videos_watched,
       CAST(coalesce(sum(total_materials_downloaded), 0) AS BIGINT) AS total_materials_downloaded
FROM v_course_overview"""

_SERIES = f"""
SELECT strftime(window_start + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS date,
       coalesce(active_users, 0) AS users, 'speed' AS source
FROM active_users WHERE window_start >= {_hours(48)}"""

_TOP_COURSES = f"""
SELECT course_id, CAST(sum(interactions) AS BIGINT) AS interactions
FROM course_popularity WHERE window_start >= {_hours(24)}
GROUP BY course_id ORDER BY interactions DESC, course_id LIMIT 10"""

_LATEST = "FROM active_users ORDER BY window_start DESC, window_end DESC LIMIT 1"

_SERVE = {
    **{f"table_speed_{name}": f"SELECT * FROM {name}" for name in _SPEED_TABLE},
    "table_course_overview": f"""
SELECT course_id, total_enrolled_students, total_videos_watched, total_materials_downloaded,
       {_ZERO} AS total_assignments_submitted, {_ZERO} AS total_quizzes_completed,
       CAST(0 AS DOUBLE) AS avg_assignment_score, CAST(0 AS DOUBLE) AS avg_quiz_score,
       {_ZERO} AS total_interactions, (SELECT as_of FROM now) AS last_updated
FROM v_course_overview""",
    "table_student_overview": f"""
SELECT student_id, total_courses_enrolled, total_videos_watched, total_assignments_submitted,
       {_ZERO} AS total_quizzes_completed, total_logins, {_ZERO} AS total_materials_downloaded,
       avg_assignment_score, CAST(0 AS DOUBLE) AS avg_quiz_score,
       CAST(0 AS DOUBLE) AS total_watch_time_minutes, CAST(NULL AS TIMESTAMP) AS last_login,
       (SELECT as_of FROM now) AS last_updated
FROM v_student_overview""",
    "table_student_course_detailed": f"""
SELECT student_id, course_id, videos_watched,
       coalesce(watch_time_minutes, 0) AS watch_time_minutes, materials_downloaded,
       {_ZERO} AS assignments_submitted, {_ZERO} AS quizzes_completed,
       CAST(0 AS DOUBLE) AS avg_assignment_score, CAST(0 AS DOUBLE) AS avg_quiz_score,
       {_ZERO} AS total_logins, last_activity_date AS last_activity
FROM v_student_course_detailed""",
    "table_auth_daily_active_users": """
SELECT CAST(date AS TIMESTAMP) AS date, daily_active_users, total_sessions,
       CAST(0 AS DOUBLE) AS avg_session_duration_minutes
FROM v_auth_daily_active_users""",
    "table_student_course_enrollment": _ENROLLED,
    "table_course_student_enrollment": _ENROLLED,
    "serve_batch_summary": """
SELECT (SELECT count(*) FROM v_student_overview) AS total_students,
       (SELECT count(*) FROM v_course_overview) AS total_courses,
       CAST(NULL AS TIMESTAMP) AS batch_last_run""",
    "serve_student_engagement_distribution": _DISTRIBUTION,
    "serve_historical_dau": f"""
SELECT strftime(CAST(date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date,
       daily_active_users AS users, 'batch' AS source
FROM v_auth_daily_active_users WHERE CAST(date AS TIMESTAMP) >= {_hours(240)}""",
    "serve_batch_activity_stats": _BATCH_STATS,
    "serve_all_courses": "SELECT * FROM v_course_overview",
    "serve_all_students": "SELECT * FROM v_student_overview",
    "serve_course_details": "SELECT * FROM v_course_overview WHERE course_id = 'COURSE007'",
    "serve_student_details": "SELECT * FROM v_student_overview WHERE student_id = 'SV000041'",
    "serve_course_students": (
        "SELECT * FROM v_student_course_enrollment WHERE course_id = 'COURSE007'"
    ),
    "serve_student_courses": (
        "SELECT * FROM v_student_course_enrollment WHERE student_id = 'SV000041'"
    ),
    "serve_student_course_performance": (
        "SELECT * FROM v_student_course_detailed"
        " WHERE student_id = 'SV000046' AND course_id = 'COURSE010'"
    ),
    "serve_speed_summary": f"""
SELECT coalesce(active_users, 0) AS current_active_users,
       (SELECT count(DISTINCT course_id) FROM course_popularity
        WHERE window_start >= {_hours(1)}) AS total_active_courses,
       CASE WHEN date_diff('second', window_start, (SELECT as_of FROM now)) < 300
            THEN 'healthy' ELSE 'stale' END AS speed_layer_status,
       window_start AS last_update
{_LATEST}""",
    "serve_recent_activity": _recent(24),
    "serve_realtime_active_users": _SERIES,
    "serve_course_popularity": _TOP_COURSES,
    "serve_video_stats": f"""
SELECT video_id, CAST(sum(views) AS BIGINT) AS views, max(window_end) AS window_end
FROM video_engagement WHERE window_start >= {_hours(24)}
GROUP BY video_id ORDER BY views DESC, video_id LIMIT 20""",
    "serve_latest_active_users": f"SELECT active_users, window_start AS timestamp {_LATEST}",
    "serve_system_summary": f"""
SELECT 'main' AS summary_id, active_users AS current_active_users,
       (SELECT count(DISTINCT course_id) FROM course_popularity) AS total_active_courses,
       (SELECT count(*) FROM v_student_overview) AS total_students,
       (SELECT count(*) FROM v_course_overview) AS total_courses,
       (SELECT as_of FROM now) AS batch_last_run, 'healthy' AS speed_layer_status,
       (SELECT as_of FROM now) AS last_updated
{_LATEST}""",
    "serve_active_user_stats": (
        f"SELECT max(users) AS peak_users, avg(users) AS avg_users FROM ({_SERIES})"
    ),
    "serve_activity_comparison": f"""
SELECT 'Videos (1h)' AS Metric, videos_watched AS Count, 'Speed' AS Layer FROM ({_recent(1)})
UNION ALL SELECT 'Interactions (1h)', course_interactions, 'Speed' FROM ({_recent(1)})
UNION ALL SELECT 'Total Videos', total_videos_watched, 'Batch' FROM ({_BATCH_STATS})
UNION ALL SELECT 'Total Materials', total_materials_downloaded, 'Batch' FROM ({_BATCH_STATS})""",
    "serve_engagement_long_form": f"""
SELECT Category, Students,
       coalesce((highly_active + moderately_active)
         / nullif(highly_active + moderately_active + low_activity + inactive, 0) * 100, 0)
         AS active_share
FROM ({_DISTRIBUTION}) d,
     LATERAL (SELECT * FROM (VALUES ('Highly Active', highly_active),
       ('Moderately Active', moderately_active), ('Low Activity', low_activity),
       ('Inactive', inactive)) AS x(Category, Students))""",
    "serve_total_interactions": f"""
SELECT CAST(coalesce(sum(interactions), 0) AS BIGINT) AS total_interactions
FROM ({_TOP_COURSES})""",
    "serve_available_columns": (
        "SELECT course_id, total_enrolled_students, total_videos_watched FROM v_course_overview"
    ),
}

# Each topic's fields.
_DECODED = {
    "auth": [
        "event_category",
        "event_type",
        "user_id",
        "timestamp",
        "role",
        "session_id",
        "email",
        "registration_source",
    ],
    "assessment": [
        "event_category",
        "event_type",
        "user_id",
        "timestamp",
        "role",
        "course_id",
        "assignment_id",
        "quiz_id",
        "student_id",
        "assignment_type",
        "file_url",
        "feedback",
        "score",
        "correct_answers",
        "total_questions",
    ],
    "video": [
        "event_category",
        "event_type",
        "user_id",
        "timestamp",
        "role",
        "course_id",
        "video_id",
        "session_id",
        "watch_duration_seconds",
    ],
    "course": [
        "event_category",
        "event_type",
        "user_id",
        "timestamp",
        "role",
        "course_id",
        "material_id",
        "material_type",
        "resource_id",
        "resource_type",
    ],
    "profile": [
        "event_category",
        "event_type",
        "user_id",
        "timestamp",
        "field_name",
        "new_value",
    ],
    "notification": [
        "event_category",
        "event_type",
        "user_id",
        "timestamp",
        "notification_type",
        "notification_id",
    ],
}


def _decoded(topic: str) -> str:
    columns = []
    for name in _DECODED[topic]:
        if name in _TEXT_FIELDS:
            columns.append(f'"{name}"')
        else:  # declared in the schema, never filled
            kind = "INTEGER" if name == "total_questions" else "VARCHAR"
            columns.append(f"CAST(NULL AS {kind}) AS {name}")
    return f"SELECT {', '.join(columns)}, tp AS timestamp_parsed FROM {topic}"


_QUIZ_FIELDS = ["event_type", "user_id", "course_id", "quiz_id", "correct_answers", "student_id"]

_INGEST = {
    "ingest_master_dataset": "SELECT * FROM raw",
    "ingest_raw_envelope": "SELECT * FROM raw",
    "ingest_topic_read": "SELECT * FROM raw WHERE topic = 'course_topic'",
    "ingest_encode_quizzes": (
        f"SELECT user_id AS key, {_json(_QUIZ_FIELDS)} AS value, topic"
        " FROM assessment WHERE event_type = 'QUIZ_COMPLETED'"
    ),
    "ingest_encode_assessments": (
        f"SELECT user_id AS key, {_json([f for f in _DECODED['assessment'] if f in _TEXT_FIELDS])} AS value,"
        " 'assessment_topic' AS topic, tp AS \"timestamp\" FROM assessment"
    ),
    **{f"ingest_decode_{topic}": _decoded(topic) for topic in _DECODED},
}


def _closed(view: str, counted: str) -> str:
    """Windows that an append-mode stream has emitted when its input is worked off.

    The watermark follows the rows the view counts.
    """
    return f"""
SELECT * FROM ({view})
WHERE window_end <= (SELECT max(tp) - INTERVAL 1 MINUTE FROM typed WHERE {counted})"""


_STREAMED = {
    "lookup_course_students": f"SELECT * FROM ({_ENROLLED}) WHERE course_id = 'COURSE007'",
    "lookup_student_courses": f"SELECT * FROM ({_ENROLLED}) WHERE student_id = 'SV000041'",
    "batch_run_all": "\nUNION ALL ".join(
        f"SELECT '{name}' AS view, count(*) AS n_rows FROM ({sql})" for name, sql in _VIEW.items()
    ),
    **{
        name.replace("table_", "refresh_"): sql
        for name, sql in _SERVE.items()
        if name.startswith("table_") and not name.startswith("table_speed_")
    },
    "batch_run_notifications": _VIEW["notification_user_summary"],
    "batch_run_student_courses": _VIEW["student_course_detailed"],
    "stream_active_users": _closed(
        "SELECT window_start, window_end, true AS within FROM active_users", "event_type = 'LOGIN'"
    ),
    "stream_course_popularity": _closed("SELECT * FROM course_popularity", _IN_COURSE),
    "stream_video_engagement_15min": _closed(
        'SELECT video_id, start AS window_start, "end" AS window_end, views,'
        " CAST(0 AS BIGINT) AS unique_viewers, CAST(0 AS BIGINT) AS total_watch_seconds"
        f" FROM ({_tumbling(15, 'video_id', 'views', _WATCHED)})",
        _WATCHED,
    ),
}

_KEEP = [
    ("auth_topic", 730),
    ("assessment_topic", 1825),
    ("video_topic", 730),
    ("course_topic", 1095),
    ("notification_topic", 30),
]

_DATED = """
SELECT user_id AS student_id, coalesce(strftime(tp, '%Y-%m-%dT%H:%M:%S'), '') AS event_time,
       coalesce(strftime(CAST(CAST(tp AS DATE) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S'), '') AS NgayHoc,
       "timestamp" AS note,
       coalesce(strftime(tp - INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S'), '') AS time_ns
FROM course"""

_RECORDS = {
    "records_dedupe_enrollments": """
SELECT o_custkey AS student_id, o_orderpriority AS class_id, o_orderstatus AS semester,
       o_orderdate AS enroll_date, o_orderkey AS position
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1""",
    "records_normalise_dates": _DATED,
    "records_grade_totals": """
SELECT *, mid_ok AND final_ok AND total_score >= 4 AS passed FROM (
  SELECT student_id, class_id, midterm_score, final_score, weight_mid,
         CAST(round(midterm_score * weight_mid + final_score * (1 - weight_mid), 2)
              AS DECIMAL(6, 2)) AS total_score,
         midterm_score >= 3 AS mid_ok, final_score >= 3 AS final_ok
  FROM (SELECT l_orderkey AS student_id, l_linenumber AS class_id,
               CAST(CAST(l_quantity AS DECIMAL(6, 2)) * CAST(0.2 AS DECIMAL(2, 1)) AS DECIMAL(6, 2))
                 AS midterm_score,
               CAST(CAST(l_discount AS DECIMAL(6, 2)) * 100 AS DECIMAL(6, 2)) AS final_score,
               CAST(CASE WHEN l_linenumber % 2 = 0 THEN 0.3 ELSE 0.4 END AS DECIMAL(4, 3))
                 AS weight_mid
        FROM lineitem))""".replace("SELECT *, mid_ok", "SELECT * EXCLUDE (mid_ok, final_ok), mid_ok"),
    "records_compacted_profiles": """
SELECT * FROM (
  SELECT * FROM raw WHERE topic = 'profile_topic'
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY "timestamp" DESC, value DESC NULLS LAST) = 1)
WHERE value IS NOT NULL""",
    "records_retained": """
SELECT key, topic, "timestamp" FROM raw
WHERE topic = 'profile_topic' OR """
    + " OR ".join(
        f"""(topic = '{t}' AND "timestamp" >= TIMESTAMP '2024-02-15' - INTERVAL {d} DAY)"""
        for t, d in _KEEP
    ),
    **{f"records_export_{fmt}": _DATED for fmt in ("csv", "json", "parquet")},
    "audit_freshness": """
SELECT topic, count(*) AS records, max("timestamp") AS newest,
       count(*) FILTER (date_diff('second', "timestamp", (SELECT max("timestamp") FROM raw)) < 604800)
         AS recent_records
FROM raw GROUP BY topic""",
    "records_event_mix": """
SELECT event_category, count(*) AS events,
       count(*) / (SELECT count(*) FROM typed) * 100 AS percentage
FROM typed GROUP BY event_category""",
}


_SESSIONS = """
SELECT user_id, min(tp) AS window_start, max(tp) + INTERVAL 6 HOUR AS window_end, count(*) AS events,
       count(*) FILTER (event_type = 'LOGIN') AS logins, count(*) FILTER (event_type = 'LOGOUT') AS logouts
FROM (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY tp) AS session
      FROM (SELECT *, coalesce(tp - lag(tp) OVER (PARTITION BY user_id ORDER BY tp) > INTERVAL 6 HOUR, true) AS gap
            FROM typed WHERE event_category = 'AUTH' AND user_id IS NOT NULL AND tp IS NOT NULL))
GROUP BY user_id, session"""


def _concurrent(intervals: str, seconds: int) -> str:
    """Intervals that hold each instant at which one begins or a bucket does, counted one by one."""
    bucket = f"time_bucket(INTERVAL {seconds} SECOND, moment, TIMESTAMP '2000-01-01')"
    return f"""
SELECT w AS window_start, w + INTERVAL {seconds} SECOND AS window_end, max(n) AS peak_concurrent,
       (SELECT count(*) FROM ({intervals}) WHERE starts >= w AND starts < w + INTERVAL {seconds} SECOND) AS started
FROM (
  SELECT {bucket} AS w, moment, count(*) AS n
  FROM (SELECT DISTINCT starts AS moment FROM ({intervals})
        UNION SELECT unnest(generate_series(
          (SELECT time_bucket(INTERVAL {seconds} SECOND, min(starts), TIMESTAMP '2000-01-01') FROM ({intervals})),
          (SELECT max(ends) FROM ({intervals})), INTERVAL {seconds} SECOND))) instants
  JOIN ({intervals}) spans ON spans.starts <= moment AND moment < spans.ends
  GROUP BY moment)
GROUP BY w"""


_WATCHING = """
  SELECT tp AS starts, tp + to_seconds(watch_duration_seconds) AS ends FROM video
  WHERE event_type = 'VIDEO_WATCHED' AND tp IS NOT NULL AND watch_duration_seconds > 0"""
_LOGGED_IN = """
  SELECT min(tp) FILTER (event_type = 'LOGIN') AS starts, max(tp) FILTER (event_type = 'LOGOUT') AS ends
  FROM auth WHERE session_id IS NOT NULL AND event_type IN ('LOGIN', 'LOGOUT')
  GROUP BY session_id HAVING ends > starts"""

_ACCESSED = """
SELECT *, date_diff('second', enrolled_at, accessed_at) / 3600 AS hours_to_access,
       CASE WHEN date_diff('second', enrolled_at, accessed_at) <= 86400 THEN 'on_time'
            WHEN enrolled_at IS NOT NULL AND accessed_at IS NOT NULL THEN 'late' END AS status
FROM (SELECT user_id, course_id, material_id, material_type, tp AS accessed_at,
             (SELECT max(e.tp) FROM course e WHERE e.event_type = 'COURSE_ENROLLED' AND e.user_id = a.user_id
                AND e.course_id = a.course_id AND e.tp <= a.tp) AS enrolled_at
      FROM course a WHERE event_type = 'ACCESS_COURSE_MATERIAL')"""

_OPENED = """
SELECT s.user_id, s.notification_id, s.notification_type, s.tp AS sent_at, o.tp AS opened_at
FROM (SELECT * FROM notification WHERE event_type = 'NOTIFICATION_SENT' AND user_id IS NOT NULL
        AND notification_id IS NOT NULL AND tp IS NOT NULL) s
LEFT JOIN (SELECT * FROM notification WHERE event_type = 'NOTIFICATION_OPENED') o
  ON o.user_id = s.user_id AND o.notification_id = s.notification_id
 AND o.tp >= s.tp AND o.tp <= s.tp + INTERVAL 3 DAY"""

_QUEUED = """
SELECT assignment_id, count(*) FILTER (event_type = 'SUBMIT_ASSIGNMENT') AS submitted,
       count(*) FILTER (event_type = 'GRADE_ASSIGNMENT') AS graded, submitted - graded AS depth
FROM assessment
WHERE event_type IN ('SUBMIT_ASSIGNMENT', 'GRADE_ASSIGNMENT') AND assignment_id IS NOT NULL
GROUP BY assignment_id"""

_REALTIME = {
    "auth_realtime_session_activity": _SESSIONS,
    "auth_peak_concurrent_users": _concurrent(_LOGGED_IN, 3600),
    "video_realtime_concurrent_viewers": _concurrent(_WATCHING, 900),
    "course_material_access_times": _ACCESSED,
    "course_material_access_summary": f"""
SELECT course_id, material_id, count(*) AS accesses, count(*) FILTER (status = 'on_time') AS on_time,
       count(*) FILTER (status = 'late') AS late,
       sum(date_diff('second', enrolled_at, accessed_at)) / (count(enrolled_at) * 3600) AS avg_hours_to_access
FROM ({_ACCESSED}) GROUP BY course_id, material_id""",
    "notification_read_times": _OPENED,
    "notification_reading_summary": f"""
SELECT notification_type, count(opened_at) AS reads, count(*) FILTER (opened_at IS NULL) AS unread,
       sum(date_diff('second', sent_at, opened_at)) / (count(opened_at) * 60) AS avg_time_to_read_minutes
FROM ({_OPENED}) GROUP BY notification_type""",
    "assessment_realtime_grading_queue": f"""
SELECT q.*, coalesce(greatest(peak, 0), 0) AS peak_depth FROM ({_QUEUED}) q LEFT JOIN (
  SELECT assignment_id, CAST(max(total) AS BIGINT) AS peak FROM (
    SELECT assignment_id, sum(CASE event_type WHEN 'SUBMIT_ASSIGNMENT' THEN 1 ELSE -1 END)
             OVER (PARTITION BY assignment_id ORDER BY tp) AS total
    FROM assessment WHERE event_type IN ('SUBMIT_ASSIGNMENT', 'GRADE_ASSIGNMENT') AND tp IS NOT NULL)
  GROUP BY assignment_id) p USING (assignment_id)""",
    "stream_session_activity": f"""
SELECT * FROM ({_SESSIONS}) WHERE window_end <= (
  SELECT max(tp) - INTERVAL 1 MINUTE FROM typed WHERE event_category = 'AUTH' AND user_id IS NOT NULL)""",
    "stream_notification_reads": f"""
SELECT * FROM ({_OPENED}) WHERE opened_at IS NOT NULL OR sent_at + INTERVAL 3 DAY < (
  SELECT min(newest) - INTERVAL 1 MINUTE FROM (
    SELECT max(tp) AS newest FROM notification
    WHERE event_type IN ('NOTIFICATION_SENT', 'NOTIFICATION_OPENED') AND user_id IS NOT NULL
      AND notification_id IS NOT NULL GROUP BY event_type))""",
    "video_realtime_popular_videos": f"""
SELECT start, video_id, views, true AS within FROM (
  SELECT *, sum(views) OVER (PARTITION BY start) AS total
  FROM ({_tumbling(1440, 'video_id', 'views', _WATCHED + " AND video_id IS NOT NULL")}))
WHERE views * 50 >= total""",
    "alert_course_activity": f"""
SELECT course_id, start, interactions, signal = 1 AS raised FROM (
  SELECT *, coalesce(lag(signal) OVER (PARTITION BY course_id ORDER BY start), 0) AS before
  FROM (SELECT *, CASE WHEN interactions >= 3 THEN 1 WHEN interactions <= 1 THEN 0 END AS signal
        FROM ({_tumbling(360, 'course_id', 'interactions', _IN_COURSE)})) WHERE signal IS NOT NULL)
WHERE signal <> before""",
    "ingest_deduplicated": 'SELECT DISTINCT key, value, topic, "timestamp" FROM raw',
    "ingest_compacted": "SELECT * FROM raw",
    "audit_warnings": "SELECT DISTINCT 'master data without speed views' AS warning FROM raw",
    "stream_grading_queue": """
SELECT assignment_id, count(*) FILTER (event_type = 'SUBMIT_ASSIGNMENT') AS submitted,
       count(*) FILTER (event_type = 'GRADE_ASSIGNMENT') AS graded, submitted - graded AS depth,
       max(tp) AS updated
FROM assessment
WHERE event_type IN ('SUBMIT_ASSIGNMENT', 'GRADE_ASSIGNMENT') AND assignment_id IS NOT NULL AND tp IS NOT NULL
GROUP BY assignment_id""",
}

_LAYERED = {
    "batch_run_incremental": "\nUNION ALL ".join(
        f"SELECT '{name}' AS view, count(*) AS n_rows, true AS as_full_run FROM ({sql})"
        for name, sql in _VIEW.items()
        if name.startswith("video_")
    ),
    "merge_daily_users": (
        "SELECT date, event_type, count(*) AS events, true AS within FROM course GROUP BY date, event_type"
    ),
    **{
        f"merge_{name}": _VIEW[name]
        for name in (
            "auth_user_session_metrics",
            "assessment_engagement_timeline",
            "video_student_course_summary",
            "course_activity_summary",
            "profile_update_frequency",
            "notification_user_preferences",
            "course_overview",
            "student_overview",
            "student_course_enrollment",
            "student_course_detailed",
        )
    },
}


def statements() -> dict[str, str]:
    events = f"WITH {_DERIVED},{_RAW},{_TYPED}"
    served = f"{events},{_VIEW_CTES}"
    return {
        **{n: f"{events}{sql}" for n, sql in {**_VIEW, **_WINDOWED, **_REALTIME, **_RECORDS, **_LAYERED}.items()},
        **{n: f"{events}\n{sql}" for n, sql in _INGEST.items()},
        **{n: f"{served}\n{sql}" for n, sql in {**_SERVE, **_STREAMED}.items()},
    }
