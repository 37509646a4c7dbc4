"""Physical plans: what is scanned, shuffled and split."""

import re

import pytest
from pyspark.sql import functions as F

from lectern.functions.keyed import lookup_join, newest, oldest
from lectern.plans import catalog
from lectern.plans.registry import VIEWS, build_view
from lectern.sources.typed import read_typed, typed_path, write_typed
from lectern.sources.sample import typed_topics


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Typed topics as the runner stores them."""
    root = str(tmp_path_factory.mktemp("typed"))
    topics = typed_topics(spark, "/root/testdata/sf0.001")
    for name in ("auth", "assessment", "video", "course", "profile", "notification"):
        topics(name).sortWithinPartitions("event_type").write.parquet(typed_path(root, name))
    return lambda name: read_typed(spark, root, name)


def test_views_use_no_python_and_no_cross_join(stored):
    for name in VIEWS:
        plan = plan_of(build_view(name, stored))
        assert "Python" not in plan and "Arrow" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_queries_have_no_cross_join_or_python(spark, sf_dir):
    for name, query in catalog.queries().items():
        if name.startswith("stream_"):
            continue
        plan = plan_of(query(spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "EvalPython" not in plan, name


def test_only_lookup_views_join(stored):
    joins = {n for n in VIEWS if "Join" in plan_of(build_view(n, stored))}
    assert joins == {
        "auth_user_session_metrics",
        "assessment_engagement_timeline",
        "video_student_course_summary",
        "student_course_enrollment",
    }


def test_event_type_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(build_view("assessment_quiz_performance", stored))
    assert "EqualTo(event_type,QUIZ_COMPLETED)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "event_type",
        "user_id",
        "course_id",
        "quiz_id",
        "correct_answers",
    }


def test_each_record_is_decoded_once(spark, sf_dir):
    plan = plan_of(build_view("auth_hourly_login_patterns", typed_topics(spark, sf_dir)))
    assert plan.count("from_json") == 1


def test_student_overview_scans_each_topic_once(stored):
    plan = plan_of(build_view("student_overview", stored, ordered=False))
    assert plan.count("FileScan") == 4
    # one shuffle for the distinct courses, one for the user
    assert plan.count("Exchange") == 2


def skewed(spark, n=200_000):
    """Enrolments of which a third belong to one pair."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
    return spark.range(n).select(
        F.concat(F.lit("u"), key).alias("user_id"),
        F.lit("c").alias("course_id"),
        F.xxhash64("id").alias("payload"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )




def test_hot_keys_of_a_lookup_join_are_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="300KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="300KB",
    )
    left = skewed(spark)
    right = left.groupBy("user_id", "course_id").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup_join(left, right, ["user_id", "course_id"], "left")
    joined.collect()
    assert "skew=true" in plan_of(joined)
    assert joined.count() == left.count()
    assert joined.where(F.col("n").isNull()).isEmpty()


def test_lookup_join_broadcasts_a_measured_small_side(spark, conf):
    # static estimates may not decide; the measured size of the shuffle does
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="10MB")
    left = skewed(spark, 20_000)
    right = left.groupBy("user_id", "course_id").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup_join(left, right, ["user_id", "course_id"], "left")
    joined.collect()
    assert "BroadcastHashJoin" in plan_of(joined)


def test_lookup_join_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    got = {(r.k, r.v, r.w) for r in lookup_join(left, right, ["k"], "left").collect()}
    assert got == {("a", 1, 10), (None, 2, None), ("b", 3, None)}


def test_newest_and_oldest_combine_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")], "k string, o int, v string"
    )
    last = newest(df, ["k"], ["o"])
    assert {(r.k, r.o, r.v) for r in last.collect()} == {("a", 2, "z"), ("b", None, "w")}
    assert {(r.k, r.v) for r in oldest(df, ["k"], ["o"]).collect()} == {("a", "x"), ("b", "w")}
    assert "partial_max" in plan_of(last) and "Window" not in plan_of(last)


def scanned_rows(df):
    """Rows the file scans of an executed frame produced."""
    df.collect()
    total = 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "Scan" in name:
            total += node.metrics().apply("numOutputRows").value()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_typed_layer_skips_other_event_types(spark, tmp_path):
    kinds = [f"'KIND_{i}'" for i in range(10)]
    json = f"""concat('{{"user_id":"u', id, '","event_type":"', elt(CAST(id % 10 AS INT) + 1, {', '.join(kinds)}), '"}}')"""
    raw = spark.range(0, 400_000, 1, 1).selectExpr(
        "CAST(id AS STRING) AS key",
        f"{json} AS value",
        "'auth_topic' AS topic",
        "CAST(NULL AS TIMESTAMP) AS timestamp",
    )
    raw.write.partitionBy("topic").parquet(f"{tmp_path}/raw")
    assert write_typed(spark, f"{tmp_path}/raw", f"{tmp_path}/typed", "auth") == 400_000
    events = read_typed(spark, f"{tmp_path}/typed", "auth")
    one = events.where("event_type = 'KIND_4'").agg(F.count_distinct("user_id"))
    assert scanned_rows(one) <= 100_000
    assert one.first()[0] == 40_000


def test_lookups_read_stored_tables(spark, sf_dir):
    """No lookup parses JSON; time-bounded ones skip days and key lookups push the key down."""
    found = catalog.queries()

    def plan(name):
        return found[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()

    for name in ("serve_course_details", "serve_student_courses", "serve_video_stats", "serve_system_summary"):
        assert "from_json" not in plan(name), name
    assert re.search(r"PartitionFilters: \[[^]]*day", plan("serve_video_stats"))
    assert "EqualTo(course_id,COURSE007)" in plan("serve_course_details")
