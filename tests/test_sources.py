import datetime as dt

import pytest
from pyspark.sql import functions as F

from lectern.operators.records import data_files
from lectern.plans.registry import VIEWS, view_path
from lectern.schemas import EVENT, RAW, TOPICS
from lectern.sources.events import (
    decode_topic,
    encode,
    raw_envelope,
    read_or_empty,
    read_topic,
)
from lectern.sources.sample import raw_events, typed_topics
from lectern.sources.typed import read_typed, typed_schema, write_typed
from lectern.sources.views import read_view, view_schema, write_view


def test_bad_records_keep_their_row(typed):
    events = typed(
        "assessment",
        [
            "{bad",
            None,
            {"user_id": "a", "timestamp": "not-a-time", "score": 3},
            {"user_id": "b", "timestamp": "2024-01-01 10:00:00", "score": "seven"},
        ],
    ).collect()
    assert len(events) == 4
    by_user = {e["user_id"]: e for e in events}
    assert by_user[None]["event_type"] is None
    assert by_user["a"]["timestamp"] == "not-a-time" and by_user["a"]["timestamp_parsed"] is None
    assert by_user["a"]["score"] == 3
    assert by_user["b"]["score"] is None
    assert by_user["b"]["timestamp_parsed"] == dt.datetime(2024, 1, 1, 10)


def test_decode_equals_plain_projection(spark, sf_dir):
    """One decode node per topic gives what a plain from_json projection gives."""
    raw = raw_events(spark, sf_dir)
    for name, topic in TOPICS.items():
        part = raw.where(F.col("topic") == topic)
        plain = part.select(F.from_json("value", EVENT[name]).alias("d")).select("d.*")
        ours = decode_topic(part, name).drop("timestamp_parsed")
        assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_missing_topic_and_missing_root(spark, raw, tmp_path):
    root = str(tmp_path / "master")
    raw("auth", [{"user_id": "a"}]).write.partitionBy("topic").parquet(root)
    assert read_topic(spark, root, TOPICS["auth"]).count() == 1
    assert read_topic(spark, root, TOPICS["video"]).count() == 0
    nothing = read_topic(spark, str(tmp_path / "nowhere"), TOPICS["auth"])
    assert nothing.count() == 0 and nothing.columns == RAW.names


def test_unreadable_root_is_an_error(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path), RAW).collect()


def test_topic_read_lists_only_its_directory(spark, raw, tmp_path):
    root = str(tmp_path / "master")
    for topic in ("auth", "video"):
        raw(topic, [{"user_id": "a"}]).write.mode("append").partitionBy("topic").parquet(root)
    auth = read_topic(spark, root, TOPICS["auth"])
    assert len(auth.inputFiles()) and all("topic=auth_topic" in f for f in auth.inputFiles())
    assert [r.topic for r in auth.collect()] == ["auth_topic"]


def test_encode_then_decode(spark, typed):
    events = typed("course", [{"event_type": "COURSE_ENROLLED", "user_id": "a", "course_id": "c"}])
    fields = events.drop("timestamp_parsed")
    again = encode(fields, "user_id", F.lit("course_topic"), F.lit(None).cast("timestamp"))
    record = again.first()
    assert record["key"] == "a" and "material_id" not in record["value"]
    assert decode_topic(again, "course").drop("timestamp_parsed").collect() == fields.collect()


def test_envelope_of_binary_records(spark):
    broker = spark.createDataFrame([(b"k", b"v", "t", None, 3)], "key binary, value binary, topic string, timestamp timestamp, partition int")
    assert raw_envelope(broker).first().asDict() == {
        "key": "k", "value": "v", "topic": "t", "timestamp": None,
    }


def test_typed_layer_holds_the_same_events(spark, sf_dir, tmp_path):
    root = str(tmp_path / "master")
    raw_events(spark, sf_dir).write.partitionBy("topic").parquet(root)
    written = write_typed(spark, root, str(tmp_path / "typed"), "course")
    stored = read_typed(spark, str(tmp_path / "typed"), "course")
    direct = typed_topics(spark, sf_dir)("course")
    assert written == stored.count() == direct.count()
    assert stored.exceptAll(direct).isEmpty()
    assert stored.schema == typed_schema("course")
    plan = stored.where(F.col("event_type") == "COURSE_ENROLLED")._jdf.queryExecution().toString()
    assert "EqualTo(event_type,COURSE_ENROLLED)" in plan


def test_views_are_replaced_and_missing_ones_are_empty(spark, tmp_path):
    root = str(tmp_path)
    schema = view_schema(spark, "notification_engagement")
    assert read_view(spark, root, "notification_engagement").collect() == []
    for user in ("a", "b"):
        one = spark.createDataFrame([(user, "t", 1)], schema)
        write_view(one, root, "notification_engagement")
    assert [r.user_id for r in read_view(spark, root, "notification_engagement").collect()] == ["b"]


def test_a_write_that_dies_leaves_the_view_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    name = "notification_engagement"
    schema = view_schema(spark, name)
    write_view(spark.createDataFrame([("a", "t", 1)], schema), root, name)
    bad = spark.createDataFrame([("b", "t", 1)], schema)
    dying = bad.withColumn(schema.names[0], F.raise_error(F.lit("dies")).cast("string"))
    with pytest.raises(Exception, match="dies"):
        write_view(dying, root, name)
    assert [r.user_id for r in read_view(spark, root, name).collect()] == ["a"]
    for user in "cde":
        write_view(spark.createDataFrame([(user, "t", 1)], schema), root, name)
    assert [r.user_id for r in read_view(spark, root, name).collect()] == ["e"]
    folder = tmp_path / view_path("", name).strip("/")
    assert len([d for d in folder.iterdir() if (d / "_SUCCESS").exists()]) == 2


def test_every_view_has_a_schema_over_no_events(spark):
    for name in VIEWS:
        assert view_schema(spark, name).names


def test_file_listing_reads_no_content(spark, raw, tmp_path):
    root = str(tmp_path / "m")
    raw("auth", [{"user_id": "a"}]).coalesce(1).write.partitionBy("topic").parquet(root)
    files = data_files(spark, root)
    assert files.count() == 1
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert data_files(spark, str(tmp_path / "none")).count() == 0
