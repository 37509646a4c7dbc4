import shutil

import pytest

from lectern.plans import catalog, oracle, refresh, runner
from lectern.plans.registry import JOBS, VIEWS, build_view
from lectern.schemas import SERVING
from lectern.sources.batches import write_batch
from lectern.sources.keyed import read_lookup
from lectern.sources.sample import raw_events, typed_topics
from lectern.sources.views import read_view


@pytest.fixture(scope="module")
def master(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("master") / "raw")
    raw_events(spark, "/root/testdata/sf0.001").write.partitionBy("topic").parquet(root)
    return root


def test_all_jobs(spark, master, sf_dir, tmp_path):
    out = str(tmp_path / "views")
    report = runner.run(spark, master, out)
    assert report.ok and set(report.jobs) == set(JOBS)
    topics = typed_topics(spark, sf_dir)
    assert report.events == {t: topics(t).count() for t in report.events}
    for name in VIEWS:
        stored, direct = read_view(spark, out, name), build_view(name, topics, ordered=False)
        assert stored.dtypes == direct.dtypes, name
        assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty(), name


def test_one_job_decodes_only_its_topics(spark, master, tmp_path):
    report = runner.run(spark, master, str(tmp_path / "v"), ["profile_notification"])
    assert set(report.events) == {"profile", "notification"} and report.jobs == {"profile_notification": None}


def test_a_failed_topic_fails_only_its_jobs(spark, master, tmp_path):
    broken = str(tmp_path / "raw")
    shutil.copytree(master, broken)
    for old in (tmp_path / "raw" / "topic=course_topic").iterdir():
        old.unlink()
    (tmp_path / "raw" / "topic=course_topic" / "part-0.parquet").write_text("not parquet")
    report = runner.run(spark, broken, str(tmp_path / "views"))
    failed = {job for job, error in report.jobs.items() if error}
    assert failed == {"course", "student_course_analytics"} and not report.ok


def test_missing_master_dataset_leaves_the_views(spark, master, tmp_path):
    out = str(tmp_path / "views")
    assert runner.run(spark, master, out, ["auth"]).ok
    before = read_view(spark, out, "auth_daily_active_users").collect()
    with pytest.raises(FileNotFoundError):
        runner.run(spark, str(tmp_path / "none"), out, ["auth"])
    assert before and read_view(spark, out, "auth_daily_active_users").collect() == before


def test_incremental_run_decodes_only_new_files(spark, sf_dir, tmp_path):
    root, out, full = (str(tmp_path / n) for n in ("raw", "views", "full"))
    events = raw_events(spark, sf_dir)
    first, later = events.where("day(timestamp) < 20"), events.where("day(timestamp) >= 20")
    topics = ["video", "course"]
    write_batch(first, root, 0, "timestamp", "topic")
    count = lambda df, t: df.where(f"topic = '{t}_topic'").count()
    one = runner.run(spark, root, out, ["video", "course"], incremental=True)
    assert one.ok and one.events == {t: count(first, t) for t in topics}
    write_batch(later, root, 1, "timestamp", "topic")
    two = runner.run(spark, root, out, ["video", "course"], incremental=True)
    assert two.ok and two.events == {t: count(later, t) for t in topics}
    assert runner.run(spark, root, out, ["video"], incremental=True).events == {"video": 0}
    assert runner.run(spark, root, full, ["video", "course"]).ok
    for view in VIEWS.values():
        if view.job in topics:
            a, b = read_view(spark, out, view.name), read_view(spark, full, view.name)
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), view.name


def test_unknown_job(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown jobs"):
        runner.run(spark, "x", "y", ["nope"])


def test_usage():
    assert runner.main([]) == 2


def test_every_sql_twin_has_a_query():
    assert set(oracle.statements()) <= set(catalog.queries())
    assert set(VIEWS) <= set(oracle.statements())


def test_serving_tables_from_stored_views(spark, master, tmp_path):
    views, tables = str(tmp_path / "views"), str(tmp_path / "tables")
    assert runner.run(spark, master, views, ["auth", "student_course_analytics"]).ok
    refresh.refresh_tables(spark, views, tables, "2024-02-01 00:00:00")
    for name in refresh.COPIED:
        stored = read_lookup(spark, f"{tables}/{name}", name)
        assert stored.count() == read_view(spark, views, name).count() > 0
        assert stored.columns == SERVING[name].names
    pairs = read_view(spark, views, "student_course_enrollment").select("student_id", "course_id")
    for name in ("student_course_enrollment", "course_student_enrollment"):
        assert read_lookup(spark, f"{tables}/{name}", name).count() == pairs.distinct().count()
    row = refresh.system_summary(spark, views, str(tmp_path / "speed"), "2024-02-01").first()
    assert row.current_active_users == 0 and row.speed_layer_status == "healthy"
    assert row.total_students == read_lookup(spark, f"{tables}/student_overview", "student_overview").count()


def test_views_are_ordered_when_read(spark, master, tmp_path):
    views = str(tmp_path / "views")
    assert runner.run(spark, master, views, ["video"]).ok
    rows = read_view(spark, views, "video_drop_off_indicators", ordered=True).collect()
    keys = [(r.avg_watch_duration, r.video_id, r.course_id) for r in rows]
    assert keys == sorted(keys) and len(keys) > 100
