import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lectern.functions.timeline import last_before, running_total
from lectern.operators import realtime
from lectern.schemas import RAW
from lectern.sources.batches import read_batches
from lectern.streaming import realtime as streams

DAY0 = dt.datetime(2024, 1, 1)


def _at(minutes):
    return DAY0 + dt.timedelta(minutes=minutes)


def _text(minutes):
    return _at(minutes).strftime("%Y-%m-%d %H:%M:%S")


# ---- running values ---------------------------------------------------------------


def test_running_total_equals_a_plain_sum(spark):
    pick = random.Random(1)
    rows = [(pick.choice("aab"), _at(pick.randrange(3000)), pick.choice((-1, 1, 2))) for _ in range(400)]
    frame = spark.createDataFrame(rows, "k string, at timestamp, d long")
    for seconds in (60, 3600, 10**9):
        got = {(r.k, r.at): r.total for r in running_total(frame, ["k"], "at", "d", seconds).collect()}
        want = {(k, t): sum(d for j, u, d in rows if j == k and u <= t) for k, t, _ in rows}
        assert got == want


def test_last_before_equals_a_search_and_keeps_rows_without_key_or_time(spark):
    pick = random.Random(2)
    left = [(pick.choice("aab"), _at(pick.randrange(2000)), i) for i in range(200)]
    left += [(None, _at(5), 900), ("a", None, 901), ("z", _at(1), 902), ("a", _at(77), 903), ("a", _at(77), 903)]
    right = [(pick.choice("aab"), _at(pick.randrange(2000))) for _ in range(60)] + [("a", _at(77)), (None, _at(1)), ("a", None)]
    one = spark.createDataFrame(left, "k string, at timestamp, i int")
    two = spark.createDataFrame(right, "k string, seen timestamp")
    for seconds in (600, 10**9):
        got = sorted((r.i, r.seen) for r in last_before(one, two, ["k"], "at", "seen", seconds).collect())
        best = lambda k, t: max((s for j, s in right if j == k and k and s and t and s <= t), default=None)
        assert got == sorted((i, best(k, t)) for k, t, i in left)


def test_a_hot_key_is_cut_by_time(spark):
    """A single key is dealt over tasks by its buckets, in both passes."""
    rows = spark.range(20_000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("at"), F.lit(1).alias("d"))
    plan = running_total(rows, ["k"], "at", "d", 3600)._jdf.queryExecution().toString()
    assert "windowspecdefinition(k#" in plan and "bucket#" in plan.split("windowspecdefinition")[1]
    assert running_total(rows, ["k"], "at", "d", 3600).agg(F.max("total"), F.count("*")).first() == (20_000, 20_000)


# ---- concurrency --------------------------------------------------------------------


def test_concurrency_equals_counting(spark):
    pick = random.Random(3)
    spans = [(_at(s), _at(s + pick.choice((1, 5, 60, 700)))) for s in (pick.randrange(3000) for _ in range(80))]
    spans += [(_at(60), _at(120)), (_at(120), _at(180)), (_at(6000), _at(6061))]
    frame = spark.createDataFrame(spans, "starts timestamp, ends timestamp")
    got = {r.window_start: (r.peak_concurrent, r.started) for r in realtime.concurrency(frame, 3600).collect()}
    want = {}
    for hour in range(0, 110):
        minutes = [_at(60 * hour + m) for m in range(60)]
        peak = max(sum(s <= t < e for s, e in spans) for t in minutes)
        if peak:
            want[minutes[0]] = (peak, sum(minutes[0] <= s <= minutes[-1] for s, _ in spans))
    assert got == want


def test_intervals_of_odd_events(typed):
    video = [
        {"event_type": "VIDEO_WATCHED", "timestamp": _text(0), "watch_duration_seconds": 60},
        {"event_type": "VIDEO_WATCHED", "timestamp": _text(0), "watch_duration_seconds": 0},
        {"event_type": "VIDEO_WATCHED", "timestamp": _text(0)},
        {"event_type": "VIDEO_WATCHED", "timestamp": "?", "watch_duration_seconds": 60},
    ]
    assert [(r.starts, r.ends) for r in realtime.watching(typed("video", video)).collect()] == [(_at(0), _at(1))]
    auth = [
        {"event_type": kind, "session_id": s, "timestamp": _text(m)}
        for s, kind, m in [("a", "LOGIN", 0), ("a", "LOGOUT", 9), ("b", "LOGIN", 5), ("c", "LOGOUT", 3), ("d", "LOGOUT", 1), ("d", "LOGIN", 2), (None, "LOGIN", 1)]
    ]
    assert [(r.session_id, r.ends) for r in realtime.logged_in(typed("auth", auth)).collect()] == [("a", _at(9))]
    assert realtime.concurrency(realtime.logged_in(typed("auth", []))).collect() == []


# ---- waiting times --------------------------------------------------------------------


def test_access_is_timed_from_the_newest_enrolment_before_it(typed):
    events = [
        {"event_type": "COURSE_ENROLLED", "user_id": "u", "course_id": "c", "timestamp": _text(m)} for m in (0, 3000)
    ] + [
        {"event_type": "ACCESS_COURSE_MATERIAL", "user_id": u, "course_id": "c", "material_id": "m", "timestamp": _text(m)}
        for u, m in (("u", 60), ("u", 2940), ("u", 3000), ("u", -5), ("v", 60))
    ]
    rows = realtime.access_times(typed("course", events)).collect()
    got = sorted((r.user_id, r.accessed_at, r.hours_to_access, r.status) for r in rows)
    assert got == [
        ("u", _at(-5), None, None), ("u", _at(60), 1.0, "on_time"), ("u", _at(2940), 49.0, "late"),
        ("u", _at(3000), 0.0, "on_time"), ("v", _at(60), None, None),
    ]
    row = realtime.access_summary(typed("course", events)).first()
    assert (row.accesses, row.on_time, row.late) == (5, 2, 1) and row.avg_hours_to_access == pytest.approx(50 / 3)


def _notifications():
    pick = random.Random(4)
    rows = [
        {
            "event_type": pick.choice(["NOTIFICATION_SENT", "NOTIFICATION_OPENED"]), "user_id": pick.choice("uv"),
            "notification_id": pick.choice("xyz"), "notification_type": "t", "timestamp": _text(pick.randrange(4000)),
        }
        for _ in range(120)
    ]
    return rows + [rows[0]] * 2 + [{**rows[0], "user_id": None}, {**rows[0], "timestamp": "?"}]


def test_reads_by_time_equal_the_plain_join(typed, rows):
    events = typed("notification", _notifications()).where("timestamp_parsed IS NOT NULL")
    sent, opened = realtime.reading_sides(events, "timestamp_parsed")
    for hours in (1, 24, 500):
        plain = realtime.reads(sent, opened, F.make_dt_interval(hours=F.lit(hours)))
        assert rows(realtime.reads_by_time(sent, opened, hours * 3600)) == rows(plain)


def test_grading_queue_peaks(typed):
    steps = [("SUBMIT_ASSIGNMENT", 0), ("SUBMIT_ASSIGNMENT", 1), ("GRADE_ASSIGNMENT", 2), ("SUBMIT_ASSIGNMENT", 9000), ("GRADE_ASSIGNMENT", 9001), ("GRADE_ASSIGNMENT", 9002)]
    events = [{"event_type": k, "assignment_id": "a", "timestamp": _text(m)} for k, m in steps]
    events += [{"event_type": "GRADE_ASSIGNMENT", "assignment_id": "b", "timestamp": "?"}, {"event_type": "SUBMIT_ASSIGNMENT"}]
    got = {r.assignment_id: (r.submitted, r.graded, r.depth, r.peak_depth) for r in realtime.grading_queue(typed("assessment", events)).collect()}
    assert got == {"a": (3, 3, 0, 2), "b": (0, 1, -1, 0)}


# ---- streams -----------------------------------------------------------------------------


def _run(spark, raw, tmp_path, start, topic, batches, kinds, **options):
    """Feed batches of events to a stream, one file each, and read what it wrote."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for events in batches:
        raw(topic, events, DAY0).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RAW).parquet(source)
        start(stream, out, str(tmp_path / "checkpoint"), interval=None, **options).awaitTermination()
    return read_batches(spark, out, kinds)


def _login(minute, kind="LOGIN", user="u"):
    return {"event_category": "AUTH", "event_type": kind, "user_id": user, "timestamp": _text(minute)}


def test_a_late_row_makes_two_sessions_one(spark, raw, tmp_path):
    batches = [[_login(0), _login(50)], [_login(25, "LOGOUT")], [_login(500, user="v")]]
    options = {"gap": "30 minutes", "watermark": "2 hours"}
    found = _run(spark, raw, tmp_path, streams.start_sessions, "auth", batches, streams.SESSIONS, **options).collect()
    assert [(r.user_id, r.window_start, r.window_end, r.events, r.logins, r.logouts) for r in found] == [
        ("u", _at(0), _at(80), 3, 2, 1)
    ]


def test_streamed_reads_are_paired_or_at_last_unread(spark, raw, tmp_path):
    one = lambda kind, n, m: {"event_type": f"NOTIFICATION_{kind}", "user_id": "u", "notification_id": n, "notification_type": "t", "timestamp": _text(m)}
    batches = [
        [one("SENT", "x", 0), one("SENT", "y", 1), one("OPENED", "q", 0)], [one("OPENED", "x", 30)],
        [one("SENT", "z", 5000), one("OPENED", "q", 5000)],
    ]
    found = _run(spark, raw, tmp_path, streams.start_reads, "notification", batches, streams.READS, within="60 minutes")
    assert sorted((r.notification_id, r.sent_at, r.opened_at) for r in found.collect()) == [
        ("x", _at(0), _at(30)), ("y", _at(1), None)
    ]


def test_queue_depth_over_batches_and_what_is_forgotten(spark, raw, tmp_path):
    one = lambda kind, a, m: {"event_type": f"{kind}_ASSIGNMENT", "assignment_id": a, "timestamp": _text(m)}
    batches = [
        [one("SUBMIT", "a", 0), one("SUBMIT", "a", 1), one("SUBMIT", "b", 1)], [one("GRADE", "a", 5)],
        [one("SUBMIT", "c", 9000)], [one("GRADE", "b", 9001)],
    ]
    _run(spark, raw, tmp_path, streams.start_grading_queue, "assessment", batches, streams.QUEUE, ttl_hours=24)
    got = {r.assignment_id: (r.submitted, r.graded, r.depth, r.updated) for r in streams.read_queue(spark, str(tmp_path / "out")).collect()}
    # b was forgotten in between: its queue begins anew
    assert got == {"a": (2, 1, 1, _at(5)), "b": (0, 1, -1, _at(9001)), "c": (1, 0, 1, _at(9000))}


def test_sketches_of_a_stream_name_the_heavy_videos(spark, raw, tmp_path):
    pick = random.Random(6)
    names = [f"v{i}" for i in range(300)]
    one = lambda m: {"event_category": "VIDEO", "event_type": "VIDEO_WATCHED", "video_id": pick.choice([*names, *["hot"] * 60, "warm", "warm", *["warm"] * 20]), "timestamp": _text(m)}
    batches = [[one(m) for m in range(low, low + 500)] for low in (0, 500)] + [[one(5000)], [one(9000)]]
    truth = {}
    for event in batches[0] + batches[1]:
        truth[event["video_id"]] = truth.get(event["video_id"], 0) + 1
    kinds = realtime.popularity_sketches(
        spark.createDataFrame([], "event_type string, video_id string, timestamp timestamp"), "1 hour"
    ).schema
    found = _run(spark, raw, tmp_path, streams.start_popular_videos, "video", batches, kinds, length="1 hour")
    found = found.where(F.col("window_start") < _at(1000))
    assert found.agg(F.sum("views")).first()[0] == sum(truth.values())
    best = realtime.popular_videos(found, "1000 days", 2).collect()
    assert [r.video_id for r in best] == ["hot", "warm"]
    assert all(abs(r.views - truth[r.video_id]) <= r.error for r in best)
