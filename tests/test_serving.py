import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lectern.operators import records, serving
from lectern.plans import catalog, runner
from lectern.schemas import SERVING
from lectern.sources import keyed, versions
from lectern.sources.sample import raw_events, spread_events

NOW = dt.datetime(2024, 1, 2, 12)


def table(spark, name, *dicts):
    schema = SERVING[name]
    return spark.createDataFrame([tuple(d.get(c) for c in schema.names) for d in dicts], schema)


def users(spark, *minutes_ago_and_count):
    return table(
        spark,
        "active_users",
        *[
            {
                "window_start": NOW - dt.timedelta(minutes=m),
                "window_end": NOW - dt.timedelta(minutes=m - 1),
                "active_users": n,
            }
            for m, n in minutes_ago_and_count
        ],
    )


def popularity(spark, *entries):
    return table(
        spark,
        "course_popularity",
        *[
            {"course_id": c, "window_start": NOW - dt.timedelta(hours=h), "interactions": n}
            for c, h, n in entries
        ],
    )


def students(spark, *totals):
    schema = "student_id string, total_videos_watched bigint, total_assignments_submitted bigint, total_logins bigint"
    return spark.createDataFrame([(f"s{n}", n, 0, 0) for n in totals], schema)


def test_engagement_bands(spark):
    found = serving.student_engagement_distribution(students(spark, 0, 1, 9, 10, 50, 51))
    assert found.first().asDict() == {
        "highly_active": 1,
        "moderately_active": 2,
        "low_activity": 2,
        "inactive": 1,
    }
    long = serving.engagement_long_form(found).collect()
    assert [(r.Category, r.Students) for r in long] == [
        ("Highly Active", 1),
        ("Moderately Active", 2),
        ("Low Activity", 2),
        ("Inactive", 1),
    ]
    assert long[0].active_share == 50.0
    empty = serving.student_engagement_distribution(students(spark))
    assert serving.engagement_long_form(empty).first().active_share == 0.0


def test_summary_counts_rows_and_reads_the_last_run(spark):
    courses = table(spark, "course_overview", {"course_id": "a", "last_updated": NOW})
    got = serving.batch_summary(students(spark, 1, 2), courses).first()
    assert tuple(got) == (2, 1, NOW)
    without = serving.batch_summary(students(spark), courses.drop("last_updated")).first()
    assert tuple(without) == (0, 1, None)


def test_dau_since_cutoff(spark):
    dau = spark.createDataFrame(
        [("2024-01-02", 3), ("2024-01-01", 2), (None, 9)], "date string, daily_active_users bigint"
    )
    got = serving.historical_dau(dau, NOW, hours=24).collect()
    assert [tuple(r) for r in got] == [("2024-01-02 00:00:00", 3, "batch")]
    assert serving.historical_dau(dau, "2024-01-02 12:00:00", hours=48).count() == 2


def test_speed_status(spark):
    courses = popularity(spark, ("a", 0, 1), ("a", 1, 1), ("b", 2, 1))
    for minutes, status in ((1, "healthy"), (5, "stale")):
        got = serving.speed_summary(users(spark, (minutes, 7), (60, 9)), courses, NOW).first()
        assert (got.current_active_users, got.total_active_courses) == (7, 1)
        assert got.speed_layer_status == status
    none = serving.speed_summary(users(spark), courses, NOW).first()
    assert (none.current_active_users, none.speed_layer_status) == (0, "unknown")
    assert none.last_update is None
    assert tuple(serving.latest_active_users(users(spark)).first()) == (0, None)


def test_recent_activity_of_nothing_is_zero(spark):
    got = serving.recent_activity(
        table(spark, "video_engagement"), popularity(spark, ("a", 3, 5)), NOW, hours=2
    )
    assert tuple(got.first()) == (0, 0, 2)


def test_series_is_in_local_time(spark):
    got = serving.realtime_active_users(users(spark, (60, 2), (30, None), (600, 5)), NOW)
    assert [tuple(r) for r in got.collect()] == [
        ("2024-01-02 18:00:00", 2, "speed"),
        ("2024-01-02 18:30:00", 0, "speed"),
    ]
    assert tuple(serving.active_user_stats(got).first()) == (2, 1.0)


def test_top_courses_break_ties_by_name(spark):
    rows = popularity(spark, ("c", 1, 5), ("b", 1, 5), ("a", 1, 2), ("a", 2, 1), ("z", 30, 99))
    top = serving.course_popularity(rows, NOW, limit=2)
    assert [tuple(r) for r in top.collect()] == [("b", 5), ("c", 5)]
    assert serving.total_interactions(top).first()[0] == 10
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_activity_comparison(spark):
    recent = spark.createDataFrame([(1, 2)], "videos_watched bigint, course_interactions bigint")
    total = spark.createDataFrame(
        [(3, 4)], "total_videos_watched bigint, total_materials_downloaded bigint"
    )
    got = [tuple(r) for r in serving.activity_comparison(recent, total).collect()]
    assert got == [
        ("Videos (1h)", 1, "Speed"),
        ("Interactions (1h)", 2, "Speed"),
        ("Total Videos", 3, "Batch"),
        ("Total Materials", 4, "Batch"),
    ]


def test_available_columns(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert serving.available_columns(df, ["a", "x", "b"]).columns == ["a", "b"]


def test_conformance_copies_renamed_columns_and_fills(spark):
    view = spark.createDataFrame(
        [("s", "c", 4, 2, NOW, None)],
        "student_id string, course_id string, videos_watched bigint, materials_downloaded bigint,"
        " last_activity_date timestamp, watch_time_minutes double",
    )
    got = keyed.conform_batch(view, "student_course_detailed", F.lit(NOW)).first()
    assert got.last_activity == NOW and got.watch_time_minutes == 0.0 and got.total_logins == 0


def test_enrolment_lookup_tables(spark, tmp_path):
    schema = "student_id string, course_id string, enrollment_date timestamp, total_videos_watched bigint"
    view = spark.createDataFrame(
        [
            ("s", "c", NOW, 3),
            ("s", "c", NOW - dt.timedelta(days=1), 3),
            ("s", "d", None, 0),
            (None, "d", NOW, 0),
        ],
        schema,
    )
    keyed.write_enrollment_tables(view, str(tmp_path))
    forward = keyed.read_lookup(spark, f"{tmp_path}/student_course_enrollment", "student_course_enrollment")
    reverse = keyed.read_lookup(spark, f"{tmp_path}/course_student_enrollment", "course_student_enrollment")
    assert {(r.student_id, r.course_id, r.enrollment_date, r.videos_watched) for r in forward.collect()} == {
        ("s", "c", NOW, 3),
        ("s", "d", None, 0),
    }
    assert reverse.columns[:2] == ["course_id", "student_id"] and reverse.count() == 2


def test_first_enrolment_is_kept(spark):
    df = spark.createDataFrame([("s", "c", 2, "b"), ("s", "c", 1, "a")], "student_id string, class_id string, n int, v string")
    assert [r.v for r in records.dedupe_enrollments(df, ["n"]).collect()] == ["a"]


def test_grades(spark):
    cases = [
        (6.0, 6.0, 0.3, Decimal("6.00"), True),
        (2.9, 9.0, 0.3, Decimal("7.17"), False),
        (9.0, 2.9, 0.3, Decimal("4.73"), False),
        (3.0, 4.0, 0.4, Decimal("3.60"), False),
        (3.05, 4.25, 0.5, Decimal("3.65"), False),
        (5.35, 5.0, 0.1, Decimal("5.04"), True),
        (5.05, 5.0, 0.1, Decimal("5.01"), True),  # 5.005: the tie rounds up
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "midterm_score double, final_score double, weight_mid double")
    got = records.grade_totals(df).collect()
    assert [(r.total_score, r.passed) for r in got] == [c[3:] for c in cases]


def test_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "2000-05-06 07:08:09", "2024-01-02", 1_700_000_000_000_000_000),
         (None, "soon", "x", None)],
        "enroll_date string, DOB string, note string, gio bigint",
    )
    assert [tuple(r) for r in records.normalise_dates(df).collect()] == [
        ("2024-01-02T00:00:00", "2000-05-06T07:08:09", "2024-01-02", "2023-11-14T22:13:20"),
        ("", "", "x", ""),
    ]


def test_export_in_three_formats(spark, tmp_path):
    df = spark.createDataFrame([("é,\"x\"", 1), ("b", 2)], "s string, n int")
    records.export(df, str(tmp_path))
    want = sorted(map(tuple, df.collect()))
    csv = spark.read.schema(df.schema).option("header", True).option("escape", "\\").csv(f"{tmp_path}/csv")
    for again in (csv, spark.read.schema(df.schema).json(f"{tmp_path}/json"), spark.read.parquet(f"{tmp_path}/parquet")):
        assert sorted(map(tuple, again.collect())) == want


def test_compaction(raw):
    def version(hour, *values):
        return raw("profile", list(values), NOW + dt.timedelta(hours=hour))

    old = version(0, {"user_id": "a", "v": 1}, {"user_id": "b", "v": 1})
    new = version(1, {"user_id": "a", "v": 2})
    gone = new.sparkSession.createDataFrame(
        [("b", None, "profile_topic", NOW + dt.timedelta(hours=2)), (None, "x", "profile_topic", NOW)],
        new.schema,
    )
    kept = records.compacted(old.union(new).union(gone)).collect()
    assert [(r.key, r.timestamp) for r in kept] == [("a", NOW + dt.timedelta(hours=1))]


def test_retention_prunes_and_keeps_what_has_no_limit(spark, raw):
    old = raw("notification", [{"user_id": "a"}], NOW - dt.timedelta(days=31))
    edge = raw("notification", [{"user_id": "b"}], NOW - dt.timedelta(days=30))
    ever = raw("profile", [{"user_id": "c"}], NOW - dt.timedelta(days=9999))
    kept = records.retained(old.union(edge).union(ever), NOW)
    assert sorted(r.key for r in kept.collect()) == ["b", "c"]


def test_retention_keeps_what_has_no_topic_or_time(spark, raw):
    rows = [("x", "v", None, NOW), ("y", "v", "notification_topic", None)]
    odd = spark.createDataFrame(rows, raw("auth", []).schema)
    assert records.retained(odd, NOW).count() == 2


def test_dates_from_numbers_are_exact(spark):
    rows = [(1704067199999999999,), (-1,), (0,), (None,)]
    df = records.normalise_dates(spark.createDataFrame(rows, "time_ns bigint"))
    assert [r.time_ns for r in df.collect()] == [
        "2023-12-31T23:59:59", "1969-12-31T23:59:59", "1970-01-01T00:00:00", "",
    ]


def test_event_mix(raw):
    df = raw("auth", [{"event_category": "AUTH"}] * 3 + ["{bad"])
    assert [tuple(r) for r in records.event_mix(df).collect()] == [("AUTH", 3, 75.0), (None, 1, 25.0)]


def test_freshness_and_warnings(spark, raw, tmp_path):
    roots = {name: str(tmp_path / name) for name in ("master", "batch", "speed")}
    raw("auth", [{"user_id": "a"}]).coalesce(1).write.partitionBy("topic").parquet(roots["master"])
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    fresh = records.freshness(spark, roots, now)
    assert {(r.dataset, r.files, r.recent_files) for r in fresh.collect()} == {
        ("master", 1, 1),
        ("batch", 0, 0),
        ("speed", 0, 0),
    }
    found = [r.warning for r in records.consistency_warnings(fresh).collect()]
    assert found == ["master data without any view", "master data without speed views"]
    later = records.freshness(spark, roots, now + dt.timedelta(hours=1))
    assert "no recent master data or speed view" in [
        r.warning for r in records.consistency_warnings(later).collect()
    ]
    for name in ("batch", "speed"):
        raw("auth", [{"user_id": "a"}]).write.parquet(roots[name])
    assert records.consistency_warnings(records.freshness(spark, roots, now)).isEmpty()


@pytest.fixture
def stored_anew(spark, sf_dir, monkeypatch):
    """The serving queries over tables of their own, and the jobs that they ran."""
    jobs, run = [], runner.run

    def seen(spark, raw_root, view_root, wanted=None, **more):
        jobs.extend(runner.JOBS if wanted is None else wanted)
        return run(spark, raw_root, view_root, wanted, **more)

    monkeypatch.setattr(catalog, "_STORED", {})
    monkeypatch.setattr(runner, "run", seen)
    return lambda name: (catalog.queries()[name](spark, sf_dir).collect(), jobs)


def test_active_user_stats_wait_for_no_batch_view(spark, sf_dir, stored_anew):
    unstored = catalog._query(catalog.SERVE["serve_active_user_stats"])(spark, sf_dir).collect()
    rows, jobs = stored_anew("serve_active_user_stats")
    assert rows == unstored and jobs == []


def test_system_summary_waits_for_the_overviews_alone(spark, sf_dir, stored_anew):
    unstored = catalog._query(catalog.SERVE["serve_system_summary"])(spark, sf_dir).collect()
    rows, jobs = stored_anew("serve_system_summary")
    assert rows == unstored and jobs == ["student_course_analytics"]


def test_system_summary_stores_no_view_but_the_overviews(spark, stored_anew):
    stored_anew("serve_system_summary")
    ((root, done),) = catalog._STORED.values()
    assert versions.names(spark, f"{root}/views") == ["course_overview", "student_overview"]
    assert sum(what in done for what in ("master", "stream_events", "now")) == 3
    _, jobs = stored_anew("serve_student_course_performance")
    runs = versions.names(spark, f"{root}/views_typed/course")
    assert len(jobs) == 2 and [r for r in runs if r.startswith("run-000000002")] == []


def test_records_are_derived_by_more_tasks_than_the_file_has_row_groups(spark, sf_dir, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    tasks = lambda raw: raw.select(F.spark_partition_id()).distinct().count()
    assert tasks(raw_events(spark, sf_dir)) == 1 and tasks(spread_events(spark, sf_dir)) == 4
    assert spread_events(spark, sf_dir).exceptAll(raw_events(spark, sf_dir)).isEmpty()
