import datetime
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from lectern.operators.rollups import ROLLUPS, daily_users, merge, roll, rollup_schema, sketch
from lectern.plans import catalog, runner
from lectern.plans.registry import VIEWS, build_rolled, build_view
from lectern.schemas import TOPICS
from lectern.sources import rollups, versions
from lectern.sources.batches import write_batch
from lectern.sources.sample import raw_events, typed_topics
from lectern.sources.typed import read_days, update_typed
from lectern.sources.views import read_view
from lectern.streaming import rollups as stream_rollups


def _equal(left, right):
    assert left.dtypes == right.dtypes
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.fixture(scope="module")
def parted(spark, tmp_path_factory):
    """Rollups of the topics, each rolled up in three parts that have nothing to do with time."""
    root = str(tmp_path_factory.mktemp("parts"))
    topics = typed_topics(spark, "/root/testdata/sf0.001")
    for name in ROLLUPS:
        part = F.pmod(F.xxhash64("user_id", "timestamp"), F.lit(3))
        roll(topics(name).withColumn("part", part), name, ["part"]).write.parquet(f"{root}/{name}")
    return lambda name: spark.read.parquet(f"{root}/{name}").drop("part")


@pytest.mark.parametrize("name", list(VIEWS))
def test_view_from_rollups_equals_view_from_events(spark, sf_dir, parted, name):
    direct = build_view(name, typed_topics(spark, sf_dir), ordered=False)
    assert _equal(build_rolled(name, parted), direct)


def test_views_of_no_events(spark):
    empty = lambda name: spark.createDataFrame([], rollup_schema(name))
    assert not [name for name in VIEWS if build_rolled(name, empty).count()]


@pytest.mark.parametrize("topic", list(ROLLUPS))
def test_merged_parts_are_the_rollup_of_the_whole(spark, sf_dir, parted, topic):
    whole = roll(typed_topics(spark, sf_dir)(topic), topic)
    assert whole.dtypes == [(f.name, f.dataType.simpleString()) for f in rollup_schema(topic).fields]
    assert _equal(merge(parted(topic), topic), whole)


def test_sketches_of_parts_count_users_within_their_error(spark, parted):
    course = parted("course")
    parts = sketch(course.where("rows % 2 = 0")).unionByName(sketch(course.where("rows % 2 = 1")))
    keys = ["date", "event_type"]
    exact = course.groupBy(*keys).agg(F.countDistinct("user_id").alias("exact"), F.sum("rows").alias("n"))
    left, right = daily_users(parts).alias("a"), exact.alias("b")
    both = left.join(right, F.col("a.date").eqNullSafe(F.col("b.date")) & F.col("a.event_type").eqNullSafe(F.col("b.event_type")), "full")
    assert both.where("users IS NULL OR events <> n OR abs(users - exact) > 1 + 0.05 * exact").isEmpty()


TEN = [{"user_id": f"u{i}", "event_type": "LOGIN", "timestamp": "2024-01-01 10:00:00"} for i in range(10)]


def _arrive(raw, day, values, topic="auth"):
    return raw(topic, values, datetime.datetime(2024, 1, day, 12))


def test_a_batch_that_is_written_again_counts_once(spark, raw, tmp_path):
    root, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    write_batch(_arrive(raw, 1, TEN), root, 0, "timestamp", "topic")
    assert update_typed(spark, root, typed, "auth") == 10
    write_batch(_arrive(raw, 1, TEN), root, 0, "timestamp", "topic")
    assert update_typed(spark, root, typed, "auth") == 10
    assert read_days(spark, typed, "auth").count() == 10
    write_batch(_arrive(raw, 1, TEN[:4]), root, 1, "timestamp", "topic")
    assert update_typed(spark, root, typed, "auth") == 4
    assert update_typed(spark, root, typed, "auth") == 0
    assert read_days(spark, typed, "auth").count() == 14


def test_a_day_that_the_master_lost_goes(spark, raw, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "views")
    both = _arrive(raw, 1, TEN).unionByName(_arrive(raw, 2, TEN[:3]))
    write_batch(both, root, 0, "timestamp", "topic")
    assert runner.run(spark, root, out, ["auth"], incremental=True).ok
    total = lambda: read_view(spark, out, "auth_hourly_login_patterns").agg(F.sum("login_count")).first()[0]
    assert total() == 13
    shutil.rmtree(tmp_path / "raw" / "topic=auth_topic" / "day=19724")
    report = runner.run(spark, root, out, ["auth"], incremental=True)
    assert report.ok and report.events == {"auth": 0} and total() == 10


def test_records_without_a_broker_time_and_a_master_without_days(spark, raw, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "views")
    write_batch(raw("auth", TEN), root, 0, "timestamp", "topic")
    assert runner.run(spark, root, out, ["auth"], incremental=True).ok
    assert read_view(spark, out, "auth_hourly_login_patterns").first()["login_count"] == 10
    flat, other = str(tmp_path / "flat"), str(tmp_path / "other")
    _arrive(raw, 1, TEN).write.partitionBy("topic").parquet(flat)
    assert runner.run(spark, flat, other, ["auth"], incremental=True).events == {"auth": 10}
    assert runner.run(spark, flat, other, ["auth"], incremental=True).events == {"auth": 0}
    assert read_view(spark, other, "auth_hourly_login_patterns").first()["login_count"] == 10


def test_a_run_that_died_is_made_up_for(spark, raw, tmp_path, monkeypatch):
    root, typed, out = (str(tmp_path / n) for n in ("raw", "typed", "rolled"))
    write_batch(_arrive(raw, 1, TEN), root, 0, "timestamp", "topic")
    update_typed(spark, root, typed, "auth")
    write = rollups.manifest.write
    monkeypatch.setattr(rollups.manifest, "write", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        rollups.update(spark, typed, out, "auth")
    monkeypatch.setattr(rollups.manifest, "write", write)
    assert rollups.update(spark, typed, out, "auth") == [19723]
    assert rollups.read(spark, out, "auth").agg(F.sum("rows")).first()[0] == 10
    assert rollups.update(spark, typed, out, "auth") == []


def test_only_changed_days_are_rolled_up(spark, raw, tmp_path):
    root, typed, out = (str(tmp_path / n) for n in ("raw", "typed", "rolled"))
    for day in (1, 2, 3):
        write_batch(_arrive(raw, day, TEN), root, day, "timestamp", "topic")
    update_typed(spark, root, typed, "auth")
    assert sorted(rollups.update(spark, typed, out, "auth")) == [19723, 19724, 19725]
    late = [{**TEN[0], "timestamp": "2023-12-01 00:00:00"}]
    write_batch(_arrive(raw, 2, late), root, 9, "timestamp", "topic")
    update_typed(spark, root, typed, "auth")
    kept = {f: f.stat().st_mtime_ns for f in (tmp_path / "rolled").rglob("*.parquet") if "day=19724" not in str(f) and "/days/" not in str(f)}
    assert rollups.update(spark, typed, out, "auth") == [19724]
    assert all(f.exists() and f.stat().st_mtime_ns == then for f, then in kept.items()) and kept
    plan = read_days(spark, typed, "auth").where(rollups.manifest.on_days([19724]))
    assert all("day=19724" in f for f in plan.inputFiles()) or "day#" in plan._jdf.queryExecution().toString().split("PartitionFilters")[1]


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    """Batch rollups of a master dataset and stream rollups of the same records."""
    root = tmp_path_factory.mktemp("layers")
    source, master, views, stream = (str(root / n) for n in ("source", "master", "views", "stream"))
    events = raw_events(spark, "/root/testdata/sf0.001")
    for part in range(3):
        some = events.where(F.pmod(F.xxhash64("key", "timestamp"), F.lit(3)) == part)
        some.coalesce(1).write.mode("append").parquet(source)
        write_batch(some, master, part, "timestamp", "topic")
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream_rollups.start(raw, stream, str(root / "checkpoint"), None).awaitTermination()
    assert runner.run(spark, master, views, incremental=True).ok
    return runner.rollup_path(views), stream


@pytest.mark.parametrize("cut", ["1970-01-01", "2024-01-09", "2024-01-20", "2100-01-01", None])
def test_batch_and_stream_merged_equal_one_batch_for_any_cut(spark, sf_dir, layers, cut):
    batch, stream = layers
    day = cut and datetime.date.fromisoformat(cut)
    for name in ("auth_user_session_metrics", "video_popularity", "student_overview", "student_course_enrollment"):
        found = build_rolled(name, lambda t: rollups.merged(spark, batch, stream, t, day))
        assert _equal(found, build_view(name, typed_topics(spark, sf_dir), ordered=False)), name


def test_horizon_is_the_newest_day_and_trimming_keeps_the_merge(spark, sf_dir, layers, tmp_path):
    batch, stream = layers
    newest = raw_events(spark, sf_dir).agg(F.max("timestamp")).first()[0].date()
    assert rollups.horizon(spark, batch) == (newest - datetime.date(1970, 1, 1)).days
    assert rollups.horizon(spark, str(tmp_path / "none")) is None
    copy = str(tmp_path / "stream")
    shutil.copytree(stream, copy)
    rollups.trim(spark, copy, rollups.horizon(spark, batch))
    left = rollups.read_stream(spark, copy, "video").select("day").distinct().collect()
    assert [r["day"] for r in left] == [rollups.horizon(spark, batch)]
    name = "video_total_watch_time"
    found = build_rolled(name, lambda t: rollups.merged(spark, batch, copy, t))
    assert _equal(found, build_view(name, typed_topics(spark, sf_dir), ordered=False))


def test_a_repeated_micro_batch_counts_once(spark, raw, tmp_path):
    rows = _arrive(raw, 1, TEN).unionByName(raw("auth", TEN[:2]))
    for _ in range(2):
        rollups.write_stream_batch(rows, str(tmp_path), 4)
    found = rollups.read_stream(spark, str(tmp_path), "auth")
    assert found.agg(F.sum("rows")).first()[0] == 10  # two without an arrival are the batch's
    assert rollups.read_stream(spark, str(tmp_path), "video").isEmpty()


def test_sides_skip_each_others_days(spark, layers):
    batch, stream = layers
    plan = rollups.merged(spark, batch, stream, "video", 19731)._jdf.queryExecution().toString()
    assert "day#" in plan and plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan
    assert set(TOPICS) == set(ROLLUPS)


def test_a_merged_query_waits_for_its_topics_alone(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalog, "_LAYERED", {})
    found = catalog.queries()["merge_video_student_course_summary"](spark, sf_dir)
    whole = build_view("video_student_course_summary", typed_topics(spark, sf_dir), ordered=False)
    assert _equal(found, catalog.as_ntz(whole))
    ((root, _),) = catalog._LAYERED.values()
    stored = {t for t in TOPICS if versions.exists(spark, f"{root}/master/topic={TOPICS[t]}")}
    assert stored == {"video"} and not versions.exists(spark, f"{root}/views")


def test_a_merged_overview_stores_no_other_topic(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalog, "_LAYERED", {})
    found = catalog.queries()["merge_student_overview"](spark, sf_dir)
    assert _equal(found, catalog.as_ntz(build_view("student_overview", typed_topics(spark, sf_dir), ordered=False)))
    ((root, done),) = catalog._LAYERED.values()
    assert done == set(VIEWS["student_overview"].topics) and not versions.exists(spark, f"{root}/views")


def test_layers_of_a_query_s_topics_are_stored_side_by_side(spark, sf_dir, monkeypatch):
    writes, together, update = [], threading.Barrier(4, timeout=120), runner.update_rollups
    monkeypatch.setattr(catalog, "_LAYERED", {})
    monkeypatch.setattr(catalog, "write_batch", lambda *a: (writes.append(a[1]), write_batch(*a)))
    monkeypatch.setattr(runner, "update_rollups", lambda *a: (together.wait(), update(*a)))
    found = catalog.queries()["merge_student_overview"](spark, sf_dir)
    assert _equal(found, catalog.as_ntz(build_view("student_overview", typed_topics(spark, sf_dir), ordered=False)))
    assert len(writes) == 1
