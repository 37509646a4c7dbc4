"""Windowed views on batch frames and as real streams."""

import datetime as dt
import json
import os
import re
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lectern.operators import speed
from lectern.schemas import RAW, SERVING
from lectern.sources import keyed, streams
from lectern.sources.batches import day_number, read_batches, write_batch
from lectern.sources.events import read_topic
from lectern.sources.sample import SOURCE_SCHEMA, derive, raw_events
from lectern.streaming import progress
from lectern.streaming import speed as layer


def at(text):
    return dt.datetime.fromisoformat(f"2024-01-01 {text}")


def login(user, time):
    return {"event_type": "LOGIN", "user_id": user, "timestamp": f"2024-01-01 {time}"}


def settings(root, **more):
    return layer.Settings(
        root=f"{root}/out", checkpoints=f"{root}/checkpoints", interval=None, **more
    )


@pytest.fixture(autouse=True)
def few_state_partitions(conf):
    conf(spark__sql__shuffle__partitions="2")


@pytest.fixture
def feed(spark, tmp_path):
    """Files of raw records, one per call, read in that order one per batch."""
    folder = str(tmp_path / "feed")
    os.makedirs(folder)
    schema = pa.schema([(n, pa.string()) for n in ("key", "value", "topic")] + [("timestamp", pa.timestamp("us", "UTC"))])
    count = iter(range(100))

    def add(topic, values):
        n = next(count)
        texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
        records = [
            {"key": None, "value": t, "topic": f"{topic}_topic", "timestamp": None} for t in texts
        ]
        pq.write_table(pa.Table.from_pylist(records, schema), f"{folder}/{n:03}.parquet")
        os.utime(f"{folder}/{n:03}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))

    add.stream = lambda: streams.read_files(spark, folder, max_files_per_trigger=1)
    return add


def windows(spark, root, name):
    stored = keyed.read_keyed(spark, f"{root}/out/keyed/{name}", name)
    return sorted(tuple(r) for r in stored.collect())


def test_sliding_windows_hold_each_login_twice(raw):
    events = speed.decode_stream(raw("auth", [login("a", "10:00:10"), login("b", "10:00:40"),
                                              login("a", "10:00:50"), login("c", "bad")]))
    exact = sorted(speed.active_users(events, exact=True).collect())
    got = [(r.start.time(), r.active_users) for r in exact]
    assert got == [(dt.time(9, 59, 30), 1), (dt.time(10, 0), 2), (dt.time(10, 0, 30), 2)]
    assert sorted(speed.active_users(events).collect()) == exact


def test_window_lengths_are_parameters(raw, rows):
    values = [
        {"event_category": "VIDEO", "event_type": "VIDEO_WATCHED", "video_id": "v",
         "course_id": "c", "timestamp": f"2024-01-01 10:0{m}:00"}
        for m in range(6)
    ]
    events = speed.decode_stream(raw("video", values))
    by_five = rows(speed.video_engagement(events, speed.WINDOWS["short"]))
    assert [r["views"] for r in by_five] == [5, 1]
    assert len(rows(speed.course_popularity(events))) == 6


def test_approximation_is_within_tolerance(spark, sf_dir):
    events = speed.decode_stream(raw_events(spark, sf_dir))
    day = dict(length="1 day", slide="1 day")
    exact = {r.start: r.active_users for r in speed.active_users(events, exact=True, **day).collect()}
    near = {r.start: r.active_users for r in speed.active_users(events, **day).collect()}
    assert exact.keys() == near.keys()
    assert all(abs(near[d] - exact[d]) <= max(1, 0.15 * exact[d]) for d in exact)


def test_late_events_are_dropped_and_open_windows_wait(spark, feed, tmp_path):
    # the lateness limit of a batch is the watermark the batch before it ran with
    feed("auth", [login("a", "10:00:10"), login("b", "10:02:00")])
    feed("auth", [login("b", "10:02:10")])
    feed("auth", [login("late", "10:00:20"), login("in time", "10:01:10"),
                  {**login("x", "10:00:00"), "timestamp": None}])
    feed("auth", [login("c", "10:05:00")])
    one = settings(tmp_path, slide="1 minute")
    layer.start("active_users", feed.stream(), one).awaitTermination()
    got = [(r[0], r[2]) for r in windows(spark, tmp_path, "active_users")]
    assert got == [(at("10:00:00"), 1), (at("10:01:00"), 1), (at("10:02:00"), 1)]


def test_restart_continues_from_the_checkpoint(spark, feed, tmp_path):
    one = settings(tmp_path)
    values = [{"course_id": "c", "timestamp": f"2024-01-01 10:{m:02}:00"} for m in range(10)]
    feed("course", values)
    layer.start("course_popularity", feed.stream(), one).awaitTermination()
    first = windows(spark, tmp_path, "course_popularity")
    layer.start("course_popularity", feed.stream(), one).awaitTermination()
    assert windows(spark, tmp_path, "course_popularity") == first
    feed("course", [{"course_id": "c", "timestamp": "2024-01-01 11:00:00"}])
    layer.start("course_popularity", feed.stream(), one).awaitTermination()
    after = windows(spark, tmp_path, "course_popularity")
    assert len(after) == 10 and after[: len(first)] == first
    assert all(r[3] == 1 for r in after)


def test_streams_equal_their_batch_twins(spark, sf_dir, tmp_path):
    events = spark.readStream.schema(SOURCE_SCHEMA).parquet(f"{sf_dir}/events*.parquet")
    layer.run(spark, derive(events), settings(tmp_path, length="15 minutes", slide="5 minutes"))
    batch = speed.decode_stream(raw_events(spark, sf_dir)).drop("processing_time")
    kept = {
        "active_users": F.col("event_type") == "LOGIN",
        "course_popularity": F.col("course_id").isNotNull(),
        "video_engagement": F.col("event_type") == "VIDEO_WATCHED",
    }
    for name, condition in kept.items():
        view = (
            speed.active_users(batch, "15 minutes", "5 minutes")
            if name == "active_users"
            else layer.VIEWS[name](batch, "15 minutes")
        )
        expected = speed.closed_windows(view, batch.where(condition))
        got = spark.read.parquet(f"{tmp_path}/out/views/{name}").drop("day", "batch_id")
        assert got.count() > 0
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_replayed_batch_replaces_itself(spark, tmp_path, rows):
    def window_rows(n):
        frame = spark.createDataFrame([(at("10:00:00"), at("10:01:00"), n)], "start timestamp, end timestamp, active_users bigint")
        return keyed.conform_speed(frame, "active_users")

    path = str(tmp_path / "keyed")
    for batch, value in [(0, 1), (1, 5), (1, 6), (2, 9), (2, 9)]:
        keyed.upsert(window_rows(value), path, "active_users", batch)
    stored = read_batches(spark, path, SERVING["active_users"])
    assert sorted((r.batch_id, r.active_users) for r in stored.collect()) == [(0, 1), (1, 6), (2, 9)]
    assert [r.active_users for r in keyed.read_keyed(spark, path, "active_users").collect()] == [9]
    late = keyed.read_keyed(spark, path, "active_users", F.lit(at("10:00:01")))
    assert late.count() == 0
    assert "day#" in re.search(r"PartitionFilters: \[([^]]*)", late._jdf.queryExecution().toString())[1]


def test_failing_sink_fails_the_query_and_the_batch_is_run_again(spark, feed, tmp_path):
    feed("course", [{"course_id": "c", "timestamp": f"2024-01-01 10:{m:02}:00"} for m in range(5)])
    one = settings(tmp_path)
    good = layer.sinks("course_popularity", one)

    def broken(rows, batch):
        raise OSError("sink is down")

    query = layer.start("course_popularity", feed.stream(), one, [good[0], broken])
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination()
    layer.start("course_popularity", feed.stream(), one).awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/out/views/course_popularity")
    assert stored.count() == 3 == len(windows(spark, tmp_path, "course_popularity"))


def test_master_dataset_sink(spark, feed, tmp_path):
    feed("auth", [login("a", "10:00:00")])
    feed("course", [{"course_id": "c"}, "{bad"])
    root = str(tmp_path / "master")
    sink = streams.master_sink(feed.stream(), root, str(tmp_path / "cp"), interval=None)
    query = sink.start()
    query.awaitTermination()
    assert sorted(d for d in os.listdir(root) if "=" in d) == ["topic=auth_topic", "topic=course_topic"]
    assert spark.read.schema(RAW).parquet(root).count() == 3
    assert read_topic(spark, root, "course_topic").count() == 2
    again = raw_events(spark, "/root/testdata/sf0.001").where("topic = 'auth_topic'")
    for _ in range(2):  # a batch that is run again
        write_batch(again, root, 7, "timestamp", "topic")
    assert read_topic(spark, root, "auth_topic").count() == 1 + again.count()
    files = [f for f in read_topic(spark, root, "auth_topic").inputFiles() if "batch_id=7" in f]
    assert len(files) == again.select(day_number(F.col("timestamp"))).distinct().count()
    assert progress.is_running(query)[0] is False


def test_progress_listener(spark, feed, tmp_path):
    reported = []
    listener = progress.ProgressListener(spark, str(tmp_path / "log"), report=reported.append)
    assert listener.frame().count() == 0
    spark.streams.addListener(listener)
    try:
        feed("course", [{"course_id": "c", "timestamp": "2024-01-01 10:00:00"}])
        layer.start("course_popularity", feed.stream(), settings(tmp_path)).awaitTermination()
        for _ in range(100):
            if listener.ended().count():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.ended().first()["error"] is None
    assert [tuple(r) for r in listener.frame().orderBy("batch_id").collect()] == sorted(reported, key=lambda r: r[1])


def test_all_progress_rows_are_kept(spark, tmp_path):
    listener = progress.ProgressListener(spark, str(tmp_path), every=100)
    for n in range(1550):
        listener._add("progress", dict(zip(progress.SCHEMA.names, ("q", n, 1, 0, None, "s"))))
    frame = listener.frame()
    assert frame.count() == 1550 and frame.selectExpr("max(batch_id)").first()[0] == 1549


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path, conf):
    path = str(tmp_path / "keyed")
    at_utc = dt.datetime(2024, 1, 1, 20)
    frame = spark.createDataFrame([(at_utc, at_utc + dt.timedelta(minutes=1), 5)], "start timestamp, end timestamp, active_users bigint")
    assert keyed.upsert(keyed.conform_speed(frame, "active_users"), path, "active_users", 0) == 0
    conf(spark__sql__session__timeZone="Asia/Ho_Chi_Minh")
    since = F.timestamp_seconds(F.lit(1704138000))  # 19:40 UTC
    assert keyed.read_keyed(spark, path, "active_users", since).count() == 1


def test_rows_without_a_key_are_counted(spark, tmp_path):
    frame = spark.createDataFrame(
        [(at("10:00:00"), at("10:01:00"), "c", 5), (at("10:00:00"), at("10:01:00"), None, 2)],
        "start timestamp, end timestamp, course_id string, interactions bigint",
    )
    rows = keyed.conform_speed(frame, "course_popularity")
    assert keyed.upsert(rows, str(tmp_path / "k"), "course_popularity", 0) == 1
    assert keyed.read_keyed(spark, str(tmp_path / "k"), "course_popularity").count() == 1


def test_kafka_options():
    assert streams.kafka_options("host:9092", ["a", "b"], "earliest", 10_000) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "10000",
    }
    assert streams.kafka_options("h", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert streams.kafka_options("h")["subscribe"].count(",") == 5


def test_the_stream_counts_users_exactly(spark, feed, tmp_path):
    """Over several batches, users seen again and a login without a user included."""
    for m in range(2):
        feed("auth", [login(f"u{m}-{i}", f"10:0{m}:{i % 60:02}") for i in range(600 * (m + 1))])
    feed("auth", [login(f"u0-{i}", f"10:01:{i % 60:02}") for i in range(30)] + [login(None, "10:02:00")])
    feed("auth", [login("z", "10:09:00")])
    one = settings(tmp_path, slide="1 minute")
    layer.start("active_users", feed.stream(), one).awaitTermination()
    got = [(r[0], r[2]) for r in windows(spark, tmp_path, "active_users")]
    assert got == [(at("10:00:00"), 600), (at("10:01:00"), 1230), (at("10:02:00"), 0)]
