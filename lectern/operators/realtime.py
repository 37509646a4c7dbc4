"""Realtime views that look at more than one event of a key: sessions, concurrency, waiting times.

Sessions and reading times run on streams and on batch frames; the others are batch views
over typed events whose running values are cut by time, so no key is held whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.columns import count_if, of_type
from lectern.functions.timeline import bucket_of, last_before, running_total

HOUR = 3600
SENT, OPENED = "NOTIFICATION_SENT", "NOTIFICATION_OPENED"
TIME = "timestamp_parsed"


# ---- sessions -------------------------------------------------------------------


def session_activity(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Logins and logouts of a user that follow each other within `gap`, as one session.

    A late row that falls between two sessions makes them one. The session ends `gap`
    after its last event. Input: decoded stream events, see `operators.speed`.
    """
    auth = events.where((F.col("event_category") == "AUTH") & F.col("user_id").isNotNull())
    kind = F.col("event_type")
    sessions = auth.groupBy(F.session_window("timestamp", gap).alias("_session"), "user_id").agg(
        F.count(F.lit(1)).alias("events"), count_if(kind == "LOGIN").alias("logins"),
        count_if(kind == "LOGOUT").alias("logouts"),
    )
    return sessions.select(
        "user_id", F.col("_session.start").alias("window_start"), F.col("_session.end").alias("window_end"),
        "events", "logins", "logouts",
    )


# ---- concurrency ----------------------------------------------------------------


def watching(video: DataFrame) -> DataFrame:
    """(starts, ends) of each watch event, in whole seconds."""
    start = F.date_trunc("second", TIME)
    length = F.make_dt_interval(secs=F.col("watch_duration_seconds").cast("decimal(18,6)"))
    watched = of_type(video, "VIDEO_WATCHED").where("watch_duration_seconds > 0")
    return watched.where(F.col(TIME).isNotNull()).select(
        "video_id", "course_id", start.alias("starts"), (start + length).alias("ends")
    )


def logged_in(auth: DataFrame) -> DataFrame:
    """(starts, ends) of each session that has both: its first login to its last logout."""
    kind = F.col("event_type")
    first, last = F.min(F.when(kind == "LOGIN", F.col(TIME))), F.max(F.when(kind == "LOGOUT", F.col(TIME)))
    sessions = of_type(auth, "LOGIN", "LOGOUT").where(F.col("session_id").isNotNull())
    ends = sessions.groupBy("session_id").agg(first.alias("starts"), last.alias("ends")).where("ends > starts")
    return ends.select("session_id", *[F.date_trunc("second", c).alias(c) for c in ("starts", "ends")])


def concurrency(intervals: DataFrame, seconds: int = HOUR) -> DataFrame:
    """Per bucket of time in which any interval [starts, ends) lies: the most at one instant,
    and how many began in it.

    A sweep: every start is +1 and every end -1, and the running total is taken inside
    buckets from what the buckets before left, so no interval meets another. At one
    instant ends come before starts. Buckets without a change but with open intervals
    are filled in from the total that runs through them.
    """
    edges = intervals.select(
        F.inline(F.array(
            F.struct(F.col("starts").alias("at"), F.lit(1).alias("delta"), F.lit(1).alias("begun")),
            F.struct(F.col("ends").alias("at"), F.lit(-1).alias("delta"), F.lit(0).alias("begun")),
        ))
    )
    totals = running_total(edges, [], "at", "delta", seconds)
    begun = edges.groupBy(bucket_of("at", seconds).alias("bucket")).agg(F.sum("begun").alias("started"))
    edge = F.unix_seconds("at") % seconds == 0  # a change at the bucket's first instant
    per_bucket = totals.groupBy("bucket").agg(
        F.max("total").alias("peak"), F.max(F.struct("at", "total"))["total"].alias("left"),
        F.max("carried").alias("carried"), F.max(edge.cast("int")).alias("at_edge"),
    )
    peak = F.when(F.col("at_edge") == 1, F.col("peak")).otherwise(F.greatest("peak", "carried"))
    changed = per_bucket.withColumn("peak", peak).join(begun, "bucket")
    later = F.lead("bucket").over(Window.orderBy("bucket"))  # buckets: as many as the calendar has
    still = changed.select("bucket", "left", later.alias("next")).where("left > 0 AND next > bucket + 1")
    filled = still.select(
        F.explode(F.sequence(F.col("bucket") + 1, F.col("next") - 1)).alias("bucket"),
        F.col("left").alias("peak"), F.lit(0).cast("bigint").alias("started"),
    )
    every = changed.select("bucket", "peak", "started").unionByName(filled).where("peak > 0")
    start = F.timestamp_seconds(F.col("bucket") * seconds)
    return every.select(
        start.alias("window_start"), F.timestamp_seconds((F.col("bucket") + 1) * seconds).alias("window_end"),
        F.col("peak").alias("peak_concurrent"), "started",
    )


# ---- waiting times ----------------------------------------------------------------


def access_times(course: DataFrame, on_time_hours: int = 24, seconds: int = 24 * HOUR) -> DataFrame:
    """Each access to material with the student's newest enrolment in the course before it.

    `hours_to_access` runs from that enrolment; the access is on time within
    `on_time_hours` of it, late after, and without one it is neither.
    """
    keys = ["user_id", "course_id"]
    enrolled = of_type(course, "COURSE_ENROLLED").select(*keys, F.col(TIME).alias("enrolled_at"))
    accesses = of_type(course, "ACCESS_COURSE_MATERIAL").select(
        *keys, "material_id", "material_type", F.col(TIME).alias("accessed_at")
    )
    found = last_before(accesses, enrolled, keys, "accessed_at", "enrolled_at", seconds)
    waited = (F.unix_timestamp("accessed_at") - F.unix_timestamp("enrolled_at")) / HOUR
    status = F.when(waited <= on_time_hours, "on_time").when(waited > on_time_hours, "late")
    return found.withColumn("hours_to_access", waited).withColumn("status", status)


def access_summary(course: DataFrame, on_time_hours: int = 24) -> DataFrame:
    """Per material of a course: accesses, those on time and late, and the average hours."""
    timed = access_times(course, on_time_hours)
    seconds = F.unix_timestamp("accessed_at") - F.unix_timestamp("enrolled_at")
    return timed.groupBy("course_id", "material_id").agg(
        F.count(F.lit(1)).alias("accesses"), count_if(F.col("status") == "on_time").alias("on_time"),
        count_if(F.col("status") == "late").alias("late"),
        F.try_divide(F.sum(seconds), F.count(seconds) * HOUR).alias("avg_hours_to_access"),
    )


def reading_sides(events: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    """(sent, opened) notifications, with the columns that tell which belong together."""
    named = events.where(F.col("user_id").isNotNull() & F.col("notification_id").isNotNull())
    keys = ["user_id", "notification_id"]
    sent = of_type(named, SENT).select(*keys, "notification_type", F.col(time).alias("sent_at"))
    opened = of_type(named, OPENED).select(
        *[F.col(k).alias(f"o_{k}") for k in keys], F.col(time).alias("opened_at")
    )
    return sent, opened


def reads(sent: DataFrame, opened: DataFrame, within: Column, how: str = "left") -> DataFrame:
    """Every opening of a sent notification in the time `within` after it; unread ones once, with NULL.

    On streams both sides carry watermarks, and a notification stays unread only once
    the watermark has passed all its time.
    """
    match = (F.col("user_id") == F.col("o_user_id")) & (F.col("notification_id") == F.col("o_notification_id"))
    in_time = (F.col("opened_at") >= F.col("sent_at")) & (F.col("opened_at") <= F.col("sent_at") + within)
    return sent.join(opened, match & in_time, how).drop("o_user_id", "o_notification_id")


def reads_by_time(sent: DataFrame, opened: DataFrame, seconds: int) -> DataFrame:
    """The batch form of `reads`: keys are cut by time, so one that holds many rows is many groups.

    A notification can only be read in its own stretch of time or the next one; openings
    are dealt to stretches, each notification to both of its.
    """
    at = bucket_of("opened_at", seconds)
    parts = F.array(bucket_of("sent_at", seconds), bucket_of("sent_at", seconds) + 1)
    dealt = sent.withColumn("_part", F.explode(parts)).where(F.col("sent_at").isNotNull())
    keys = ["user_id", "notification_id"]
    match = [F.col(k) == F.col(f"o_{k}") for k in keys] + [F.col("_part") == F.col("_at")]
    match.append(F.col("opened_at") >= F.col("sent_at"))
    match.append(F.unix_micros("opened_at") - F.unix_micros("sent_at") <= seconds * 1_000_000)
    columns = [*sent.columns, "opened_at"]
    found = dealt.join(opened.withColumn("_at", at), match).select(*columns)
    read = found.select(*sent.columns).distinct()
    same = [sent[c].eqNullSafe(read[c]) for c in sent.columns]
    unread = sent.join(read, same, "left_anti").withColumn("opened_at", F.lit(None).cast("timestamp"))
    return found.unionByName(unread)


def reading_summary(read: DataFrame) -> DataFrame:
    """Per notification type: openings, notifications nobody read, and the average minutes to read."""
    waited = F.unix_timestamp("opened_at") - F.unix_timestamp("sent_at")
    return read.groupBy("notification_type").agg(
        F.count("opened_at").alias("reads"), count_if(F.col("opened_at").isNull()).alias("unread"),
        F.try_divide(F.sum(waited), F.count(waited) * 60).alias("avg_time_to_read_minutes"),
    )


# ---- popular videos -------------------------------------------------------------------

#: Items a sketch tracks. An estimate is off by less than 3.5 / TRACKED of a window's views.
TRACKED = 4096


def popularity_sketches(events: DataFrame, length: str = "1 minute", tracked: int = TRACKED) -> DataFrame:
    """Per window its views and a sketch of fixed size of the videos viewed most.

    Runs on streams and on batch frames of decoded stream events. Sketches of windows, or
    of parts of one, can be combined (`popular_videos`).
    """
    watched = events.where((F.col("event_type") == "VIDEO_WATCHED") & F.col("video_id").isNotNull())
    sketch = F.call_function("approx_top_k_accumulate", F.col("video_id"), F.lit(tracked))
    found = watched.groupBy(F.window("timestamp", length).alias("_window")).agg(
        F.count(F.lit(1)).alias("views"), sketch.alias("sketch")
    )
    return found.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "views", "sketch"
    )


def popular_videos(sketches: DataFrame, length: str, k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The `k` most viewed videos of longer windows, from the sketches of those within them:
    estimated views, and by how much they may be off."""
    best = F.call_function(
        "approx_top_k_estimate", F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked)), F.lit(k)
    )
    combined = sketches.groupBy(F.window("window_start", length).alias("_window")).agg(
        F.sum("views").alias("_all"), best.alias("_best")
    )
    return combined.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
        F.inline("_best").alias("video_id", "views"), (F.col("_all") * 3.5 / tracked).alias("error"),
    )


# ---- grading ----------------------------------------------------------------------


def grading_queue(assessment: DataFrame, seconds: int = 24 * HOUR) -> DataFrame:
    """Per assignment: works submitted and graded, how many wait, and the most that ever did."""
    kind = F.col("event_type")
    keyed = of_type(assessment, "SUBMIT_ASSIGNMENT", "GRADE_ASSIGNMENT").where(F.col("assignment_id").isNotNull())
    submitted = (kind == "SUBMIT_ASSIGNMENT").cast("bigint")
    changes = keyed.select("assignment_id", F.col(TIME).alias("at"), (2 * submitted - 1).alias("delta"), submitted.alias("one"))
    counts = changes.groupBy("assignment_id").agg(
        F.sum("one").alias("submitted"), F.sum(1 - F.col("one")).alias("graded"), F.sum("delta").alias("depth")
    )
    timed = running_total(changes.where(F.col("at").isNotNull()), ["assignment_id"], "at", "delta", seconds)
    peaks = timed.groupBy("assignment_id").agg(F.greatest(F.max("total"), F.lit(0)).alias("peak_depth"))
    return counts.join(peaks, "assignment_id", "left").na.fill(0, ["peak_depth"])
