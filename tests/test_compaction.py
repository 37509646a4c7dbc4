import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import alerts
from lectern.schemas import RAW, SERVING
from lectern.sources import compaction, keyed
from lectern.sources.batches import read_batches, write_batch
from lectern.sources.events import read_topic
from lectern.sources.streams import compact_master, deduplicated, master_sink
from lectern.sources.typed import read_days, update_typed

DAY = 19723  # 2024-01-01


def _record(raw, day, *users):
    values = [{"user_id": u, "event_type": "LOGIN"} for u in users]
    return raw("auth", values, dt.datetime(2024, 1, 1 + day, 12))


@pytest.fixture
def master(spark, raw, tmp_path):
    """A master dataset of four batches over two days, and its stream's checkpoint."""
    root, source = str(tmp_path / "raw"), str(tmp_path / "in")
    for batch, (day, users) in enumerate([(0, "ab"), (0, "c"), (1, "de"), (0, "a")]):
        _record(raw, day, *users).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RAW).parquet(source)
        master_sink(stream, root, str(tmp_path / "checkpoint"), None).start().awaitTermination()
    return root, str(tmp_path / "checkpoint")


def _keys(spark, root):
    return sorted(r["key"] for r in read_topic(spark, root, "auth_topic").collect())


def _directories(spark, root):
    return sorted(tuple(r)[:2] for r in compaction_directories(spark, root))


def compaction_directories(spark, root):
    from lectern.sources.manifest import directories

    return directories(spark, f"{root}/topic=auth_topic").collect()


def test_closed_days_are_put_together_and_read_the_same(spark, raw, master):
    root, checkpoint = master
    assert compaction.committed_batch(spark, checkpoint) == 3
    assert compact_master(spark, root, checkpoint, DAY + 1)["auth_topic"] == [DAY]
    assert _keys(spark, root) == list("aabcde")
    assert compact_master(spark, root, checkpoint, DAY + 1)["auth_topic"] == []
    assert _directories(spark, root) == [(DAY, -4), (DAY + 1, 2)]  # what was put together is gone
    assert _keys(spark, root) == list("aabcde")
    write_batch(_record(raw, 0, "z"), root, 4, "timestamp", "topic")
    assert _keys(spark, root) == list("aabcdez")
    done = compaction.compact(spark, f"{root}/topic=auth_topic", read_topic(spark, root, "auth_topic").drop("topic").schema, DAY + 9, 4)
    assert done == [DAY] and _keys(spark, root) == list("aabcdez")


def test_batches_that_may_run_again_are_left(spark, raw, master):
    root, _ = master
    schema = read_topic(spark, root, "auth_topic").drop("topic").schema
    assert compaction.compact(spark, f"{root}/topic=auth_topic", schema, DAY + 1, 1) == [DAY]
    write_batch(_record(raw, 0, "a"), root, 3, "timestamp", "topic")  # batch 3 again
    assert _keys(spark, root) == list("aabcde")
    assert compaction.committed_batch(spark, "/nowhere") == -1
    assert compaction.compact(spark, f"{root}/topic=none", schema, DAY, 5) == []


def test_a_compaction_that_dies_is_not_seen(spark, master, monkeypatch):
    root, checkpoint = master
    replace = compaction.versions.replace
    calls = []

    def second_dies(*arguments):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("dies")
        replace(*arguments)

    monkeypatch.setattr(compaction.versions, "replace", second_dies)
    with pytest.raises(RuntimeError, match="dies"):
        compact_master(spark, root, checkpoint, DAY + 1)
    monkeypatch.undo()
    assert (DAY, -4) in _directories(spark, root) and _keys(spark, root) == list("aabcde")
    assert compact_master(spark, root, checkpoint, DAY + 1)["auth_topic"] == [DAY]
    assert _keys(spark, root) == list("aabcde")


def test_the_typed_layer_follows_a_compaction(spark, master, tmp_path):
    root, checkpoint = master
    typed = str(tmp_path / "typed")
    assert update_typed(spark, root, typed, "auth") == 6
    compact_master(spark, root, checkpoint, DAY + 1)
    for rows in (4, 0):  # the day is decoded once more, from its new directory
        assert update_typed(spark, root, typed, "auth") == rows
        assert sorted(r["user_id"] for r in read_days(spark, typed, "auth").collect()) == list("aabcde")


def test_keyed_tables_keep_their_newest_rows(spark, tmp_path):
    path, kinds = str(tmp_path / "t"), SERVING["course_popularity"]
    at = dt.datetime(2024, 1, 1)
    for batch, n in enumerate((1, 2, 3)):
        rows = spark.createDataFrame([("c", at, at, n, 0), (f"c{batch}", at, at, n, 0)], kinds)
        keyed.upsert(rows, path, "course_popularity", batch)
    assert keyed.compact_keyed(spark, path, "course_popularity", DAY + 1, 2) == [DAY]
    assert read_batches(spark, path, kinds).count() == 4
    found = {r["course_id"]: r["interactions"] for r in keyed.read_keyed(spark, path, "course_popularity").collect()}
    assert found == {"c": 3, "c0": 1, "c1": 2, "c2": 3}
    keyed.upsert(spark.createDataFrame([("c", at, at, 9, 0)], kinds), path, "course_popularity", 3)
    assert keyed.read_keyed(spark, path, "course_popularity").where("course_id = 'c'").first()["interactions"] == 9


def test_records_sent_again_are_kept_once(spark, raw, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "raw")
    for users in ("ab", "bc", "c"):
        _record(raw, 0, *users).coalesce(1).write.mode("append").parquet(source)
        stream = deduplicated(spark.readStream.schema(RAW).parquet(source))
        master_sink(stream, root, str(tmp_path / "checkpoint"), None).start().awaitTermination()
    assert _keys(spark, root) == list("abc")


# ---- alerts -----------------------------------------------------------------------


def _brute(rows, high, low, state):
    out = []
    for k, t, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        new = 1 if v >= high else 0 if v <= low else state.get(k, 0)
        if new != state.get(k, 0):
            out.append((k, t, v, new == 1))
        state[k] = new
    return sorted(out)


def _measures(spark, seed, count=300):
    pick = random.Random(seed)
    times = {(k, m) for k in "ab" for m in pick.sample(range(6000), count // 2)}
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), pick.randrange(12)) for k, m in sorted(times)]
    return rows, spark.createDataFrame(rows, "k string, at timestamp, n int")


@pytest.mark.parametrize("seconds", [600, 86400, 10**9])
def test_crossings_equal_a_state_machine(spark, seconds):
    rows, frame = _measures(spark, 1)
    got = alerts.crossings(frame, ["k"], "at", "n", 9, 3, seconds)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 9, 3, {})


def test_alerts_of_micro_batches_go_on_from_the_state_before(spark, tmp_path):
    rows, frame = _measures(spark, 2)
    middle = dt.datetime(2024, 1, 3)
    parts = [frame.where(F.col("at") < middle), frame.where(F.col("at") >= middle)]
    for batch in (0, 1, 1):  # the second runs again
        alerts.write_alerts(parts[batch], batch, str(tmp_path), ["k"], "at", "n", 9, 3)
    kinds = alerts.crossings(frame, ["k"], "at", "n", 9, 3).schema
    found = read_batches(spark, f"{tmp_path}/alerts", kinds).select("k", "at", "n", "raised")
    assert sorted(map(tuple, found.collect())) == _brute(rows, 9, 3, {})


def test_limits_are_known():
    assert alerts.HIGH["failed_logins_per_minute"] == 10 and all(v > 0 for v in alerts.HIGH.values())
