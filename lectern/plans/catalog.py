"""Every operator as a named query over the given tables.

A query is called with the session and a directory of Parquet tables. Learning
events are derived from `events` (see lectern.sources.sample); `as_of` is the
newest event time in the data.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.columns import as_ntz, event_time
from lectern.operators import alerts, realtime, records, serving, speed
from lectern.operators.rollups import daily_users
from lectern.plans import refresh, runner
from lectern.plans.registry import VIEWS, build_rolled, build_view, views_of
from lectern.schemas import RAW, TOPICS
from lectern.sources import keyed, rollups, versions
from lectern.sources.batches import read_batches, write_batch
from lectern.sources.events import encode, raw_envelope, read_topic
from lectern.sources.listing import read_or_empty
from lectern.sources.sample import SOURCE_SCHEMA, derive, raw_events, spread, spread_events, typed_topics
from lectern.sources.scratch import shared_folder
from lectern.sources.compaction import compact
from lectern.sources.streams import deduplicated, master_sink
from lectern.sources.views import read_view
from lectern.streaming import realtime as realtime_streams
from lectern.streaming import rollups as stream_rollups
from lectern.streaming import speed as streams

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """The frames queries start from, for one session and table directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self) -> DataFrame:
        return raw_events(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def topic(self, name: str) -> DataFrame:
        return typed_topics(self.spark, self.sf_dir)(name)

    def view(self, name: str) -> DataFrame:
        return build_view(name, typed_topics(self.spark, self.sf_dir), ordered=False)

    def views(self, *names: str) -> list[DataFrame]:
        return [self.view(name) for name in names]

    def stream_events(self) -> DataFrame:
        return speed.decode_stream(self.raw())

    def speed_view(self, name: str, hours: int | None = None) -> DataFrame:
        events = self.stream_events()
        view = (
            speed.active_users(events, exact=True)
            if name == "active_users"
            else streams.VIEWS[name](events)
        )
        return keyed.conform_speed(view, name)

    def as_of(self) -> Column:
        return self.stream_events().agg(F.max("timestamp")).scalar()


#: Where each session stores the tables of a directory, and what is there so far.
_STORED: dict[tuple[str, str], tuple[str, dict[str, object]]] = {}


class StoredInputs(Inputs):
    """What serving reads: views, keyed speed tables and `as_of`, all stored before.

    A session stores each of them once for a directory, when a query first reads it: the
    master dataset, from which everything else is made; a view in its order, with the typed
    layer of its topics; the columns that the speed views read, decoded once for all of
    them; and each speed view as a keyed table. A query waits for what it reads and for
    nothing else.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _STORED:
            _STORED[key] = shared_folder(spark, "serving"), {}
        self.root, self.done = _STORED[key]

    def _once(self, what: str, store: Callable[[], object]) -> object:
        if what not in self.done:
            self.done[what] = store()
        return self.done[what]

    def _master(self) -> str:
        path = f"{self.root}/master"
        raw = spread_events(self.spark, self.sf_dir)
        self._once("master", lambda: raw.write.partitionBy("topic").mode("overwrite").parquet(path))
        return path

    def _upsert(self, name: str) -> None:
        keyed.upsert(super().speed_view(name), f"{self.root}/keyed/{name}", name, 0)

    def view(self, name: str) -> DataFrame:
        return self.views(name)[0]

    def views(self, *names: str) -> list[DataFrame]:
        """Stored views. Those that are not there yet are stored by one run."""
        root = f"{self.root}/views"
        missing = [name for name in names if f"view {name}" not in self.done]
        if missing:
            jobs = dict.fromkeys(VIEWS[name].job for name in missing)
            typed = [t for t in TOPICS if f"typed {t}" in self.done]
            report = runner.run(
                self.spark, self._master(), root, list(jobs), ordered=True, views=missing, decoded=typed
            )
            if not report.ok:
                raise RuntimeError(report.jobs)
            self.done |= {f"view {name}": None for name in missing}
            self.done |= {f"typed {t}": None for t in report.events}
        return [read_view(self.spark, root, name) for name in names]

    def stream_events(self) -> DataFrame:
        """The decoded columns of all topics, as stored."""
        path = f"{self.root}/stream_events"
        events = speed.decode_stream(read_or_empty(self.spark, self._master(), RAW))
        self._once("stream_events", lambda: versions.replace(self.spark, path, events.write.parquet))
        return versions.read(self.spark, path, events.schema)

    def speed_view(self, name: str, hours: int | None = None) -> DataFrame:
        """The keyed table; with `hours`, only the days that hold the last so many hours."""
        self._once(f"keyed {name}", lambda: self._upsert(name))
        since = self.as_of() - F.make_dt_interval(hours=F.lit(hours)) if hours else None
        return keyed.read_keyed(self.spark, f"{self.root}/keyed/{name}", name, since)

    def table_of(self, name: str) -> DataFrame:
        """A batch-fed serving table; the first call of a session refreshes all of them."""
        tables = f"{self.root}/tables"
        if not versions.exists(self.spark, tables):
            self.views(*refresh.COPIED, "student_course_enrollment")
            refresh.refresh_tables(self.spark, f"{self.root}/views", tables, self.as_of())
        return keyed.read_lookup(self.spark, f"{tables}/{name}", name)

    def as_of(self) -> Column:
        return F.lit(self._once("now", lambda: self.stream_events().agg(F.max("timestamp")).first()[0]))


#: Where each session stores the layers of a directory, and what is there so far.
_LAYERED: dict[tuple[str, str], tuple[str, set[str]]] = {}

#: In the merged queries the batch counts what arrived before, the stream the rest.
CUT = datetime.date(2024, 1, 28)


def _in_bulk(raw: DataFrame) -> DataFrame:
    """The records as if they had reached the broker together, on the next tenth day."""
    seconds = 10 * 86400
    arrival = F.timestamp_seconds(F.ceil(F.unix_seconds("timestamp") / seconds) * seconds)
    return raw.withColumn("timestamp", arrival)


class LayeredInputs(Inputs):
    """Batch and stream rollups of the same records.

    A session stores a topic's once for a directory, when a query first reads them: the
    layers of all topics that the query reads at the same time, as none waits for another.
    The batch views are stored when a query first asks for them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _LAYERED:
            _LAYERED[key] = shared_folder(spark, "layers"), set()
        self.root, self.done = _LAYERED[key]

    def store(self, *topics: str) -> None:
        """Store what is missing of the topics' layers, side by side from one master dataset."""
        missing = [topic for topic in topics if topic not in self.done]
        if not missing:
            return
        ours = F.col("topic").isin([TOPICS[topic] for topic in missing])
        raw = spread_events(self.spark, self.sf_dir).where(ours)
        write_batch(_in_bulk(raw), f"{self.root}/master", 0, "timestamp", "topic")
        steps = [(step, topic) for step in (self._stream, self._batch) for topic in missing]
        with ThreadPoolExecutor(max_workers=len(steps)) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(lambda step: step[0](step[1])), steps))
        self.done.update(missing)

    def _batch(self, topic: str) -> None:
        runner.update_rollups(self.spark, f"{self.root}/master", f"{self.root}/views", topic)

    def _stream(self, topic: str) -> None:
        events = self.spark.readStream.schema(SOURCE_SCHEMA).parquet(f"{self.sf_dir}/events*.parquet")
        arriving = _in_bulk(derive(spread(events)).where(F.col("topic") == TOPICS[topic]))
        checkpoint = f"{self.root}/checkpoint/{topic}"
        stream_rollups.start(arriving, f"{self.root}/stream", checkpoint, None, [topic]).awaitTermination()

    def store_views(self) -> None:
        """All batch views, from the rollups of all topics."""
        if "views" in self.done:
            return
        self.store(*TOPICS)
        report = runner.run(self.spark, f"{self.root}/master", f"{self.root}/views", incremental=True)
        if not report.ok:
            raise RuntimeError(report.jobs)
        self.done.add("views")

    def view(self, name: str) -> DataFrame:
        """A view of all events, made from the merged rollups of its topics."""
        self.store(*VIEWS[name].topics)
        return build_rolled(name, self.rollup)

    def rollup(self, name: str) -> DataFrame:
        self.store(name)
        batch = runner.rollup_path(f"{self.root}/views")
        return rollups.merged(self.spark, batch, f"{self.root}/stream", name, CUT)

    def sketches(self, name: str) -> DataFrame:
        self.store(name)
        batch = runner.rollup_path(f"{self.root}/views")
        return rollups.merged_sketches(self.spark, batch, f"{self.root}/stream", name, CUT)


def _query(build: Callable[[Inputs], DataFrame], inputs: type[Inputs] = Inputs) -> Query:
    return lambda spark, sf_dir: as_ntz(build(inputs(spark, sf_dir)))


def _view_query(name: str) -> Query:
    return lambda spark, sf_dir: as_ntz(build_view(name, typed_topics(spark, sf_dir)))


# ---- merged layers and incremental runs ------------------------------------------


#: The jobs of the incremental query; the tests run all.
INCREMENTAL = ("video",)


def _incremental(i: Inputs) -> DataFrame:
    """Each view as incremental runs left it: its rows, and whether they are those of a full run.

    The master dataset comes in two batches of users; the second run sees the second batch,
    and the first one written anew.
    """
    root = shared_folder(i.spark, "incremental")
    views = [v for job in INCREMENTAL for v in views_of(job)]
    topics = [TOPICS[t] for t in dict.fromkeys(t for v in views for t in v.topics)]
    raw = _in_bulk(i.raw()).where(F.col("topic").isin(topics)).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(2)))
    for parts in ([0], [0, 1]):
        for part in parts:
            write_batch(raw.where(F.col("part") == part).drop("part"), f"{root}/master", part, "timestamp", "topic")
        for views_root, incremental in ((f"{root}/views", True), (f"{root}/full", False)):
            if incremental or parts == [0, 1]:
                report = runner.run(i.spark, f"{root}/master", views_root, INCREMENTAL, incremental=incremental)
                if not report.ok:
                    raise RuntimeError(report.jobs)

    def said(root: str, name: str) -> DataFrame:
        view = read_view(i.spark, root, name)
        row = F.xxhash64(*[F.col(c).cast("string") for c in sorted(view.columns)])
        return view.agg(
            F.lit(name).alias("view"), F.count(F.lit(1)).alias("n_rows"), F.sum(row.cast("decimal(38,0)")).alias("total")
        )

    both = reduce(
        DataFrame.unionByName, [said(r, v.name) for v in views for r in (f"{root}/views", f"{root}/full")]
    )
    same = (F.min("n_rows") == F.max("n_rows")) & F.min("total").eqNullSafe(F.max("total"))
    return both.groupBy("view").agg(F.max("n_rows").alias("n_rows"), same.alias("as_full_run"))


def _daily_users(i: LayeredInputs) -> DataFrame:
    """Course events and users per day from merged sketches, and whether the users are
    within three standard errors, or one user, of the exact number."""
    keys = ["date", "event_type"]
    near = daily_users(i.sketches("course"))
    exact = i.rollup("course").groupBy(*keys).agg(F.countDistinct("user_id").alias("exact"))
    a, b = near.alias("a"), exact.alias("b")
    match = F.col("a.date").eqNullSafe(F.col("b.date")) & F.col("a.event_type").eqNullSafe(F.col("b.event_type"))
    off = F.abs(F.col("users") - F.col("exact"))
    within = off <= F.greatest(F.lit(1.0), 3 * 0.01625 * F.col("exact"))
    return a.join(b, match).select(
        F.col("a.date").cast("string").alias("date"), F.col("a.event_type").alias("event_type"), "events",
        within.alias("within"),
    )


#: Views shown from merged layers: each topic's, and those of several topics.
MERGED = (
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

LAYERED: dict[str, Callable[[LayeredInputs], DataFrame]] = {
    "merge_daily_users": _daily_users,
    **{f"merge_{name}": (lambda i, name=name: i.view(name)) for name in MERGED},
}

# ---- sources and ingestion ---------------------------------------------------


def _broker_rows(i: Inputs) -> DataFrame:
    binary = i.raw().withColumn("key", F.encode("key", "UTF-8"))
    return raw_envelope(binary.withColumn("value", F.encode("value", "UTF-8")))


def _encoded_quizzes(i: Inputs) -> DataFrame:
    quizzes = i.topic("assessment").where(F.col("event_type") == "QUIZ_COMPLETED")
    fields = ["event_type", "user_id", "course_id", "quiz_id", "correct_answers", "student_id"]
    return encode(
        quizzes.select(*fields), "user_id", F.lit("assessment_topic"), F.lit(None).cast("timestamp")
    ).select("key", "value", "topic")


def _encoded_assessments(i: Inputs) -> DataFrame:
    """All events of the topic with all their fields; the event time is the broker's."""
    events = i.topic("assessment").drop("timestamp_parsed")
    return encode(events, "user_id", F.lit(TOPICS["assessment"]), event_time())


INGEST: dict[str, Callable[[Inputs], DataFrame]] = {
    "ingest_raw_envelope": _broker_rows,
    "ingest_encode_quizzes": _encoded_quizzes,
    "ingest_encode_assessments": _encoded_assessments,
    **{
        f"ingest_decode_{name}": (lambda i, name=name: i.topic(name))
        for name in ("auth", "assessment", "video", "course", "profile", "notification")
    },
}

# ---- windows -----------------------------------------------------------------

WINDOWED: dict[str, Callable[[Inputs], DataFrame]] = {
    "speed_active_users": lambda i: speed.active_users(i.stream_events(), exact=True),
    "speed_active_users_5min": lambda i: speed.active_users(
        i.stream_events(), speed.WINDOWS["short"], "1 minute", exact=True
    ),
    "speed_course_popularity": lambda i: speed.course_popularity(i.stream_events()),
    "speed_course_popularity_15min": lambda i: speed.course_popularity(
        i.stream_events(), speed.WINDOWS["medium"]
    ),
    "speed_video_engagement": lambda i: speed.video_engagement(i.stream_events()),
    "speed_video_engagement_1h": lambda i: speed.video_engagement(
        i.stream_events(), speed.WINDOWS["long"]
    ),
}


def _streamed(name: str, length: str, slide: str = "30 seconds") -> Query:
    """Run the streaming view itself over the events table, until it is worked off."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark, f"stream-{name}")
        settings = streams.Settings(
            root=f"{root}/out",
            checkpoints=f"{root}/checkpoints",
            length=length,
            slide=slide,
            interval=None,
        )
        events = spark.readStream.schema(SOURCE_SCHEMA).parquet(f"{sf_dir}/events*.parquet")
        streams.start(name, derive(events), settings).awaitTermination()
        return as_ntz(keyed.read_keyed(spark, f"{settings.root}/keyed/{name}", name))

    return query


def _master(spark: SparkSession, sf_dir: str) -> str:
    """Stream the derived raw records into a master dataset; returns its root."""
    root = shared_folder(spark, "master")
    events = spark.readStream.schema(SOURCE_SCHEMA).parquet(f"{sf_dir}/events*.parquet")
    master_sink(derive(events), f"{root}/data", f"{root}/checkpoint", None).start().awaitTermination()
    return f"{root}/data"


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _master(spark, sf_dir)
    parts = [read_topic(spark, root, topic) for topic in TOPICS.values()]
    return as_ntz(reduce(DataFrame.unionByName, parts))


def _run_job(job: str, view: str) -> Query:
    """A batch job from the master dataset to stored views, and one of its views read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = shared_folder(spark, "views")
        report = runner.run(spark, _master(spark, sf_dir), views, [job])
        if not report.ok:
            raise RuntimeError(report.jobs[job])
        return as_ntz(read_view(spark, views, view))

    return query


def _run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs from the master dataset to stored views: the rows of each view read back."""
    views = shared_folder(spark, "views")
    report = runner.run(spark, _master(spark, sf_dir), views)
    if not report.ok:
        raise RuntimeError(report.jobs)
    counts = [
        read_view(spark, views, name).agg(F.lit(name).alias("view"), F.count(F.lit(1)).alias("n_rows"))
        for name in VIEWS
    ]
    return reduce(DataFrame.unionByName, counts)


def _refreshed(table: str) -> Query:
    """A serving table as the refresh from stored views leaves it."""
    return lambda spark, sf_dir: as_ntz(StoredInputs(spark, sf_dir).table_of(table))


def _exported(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark, "export")
        dated = records.normalise_dates(_dated_rows(Inputs(spark, sf_dir)))
        records.export(dated, root)
        reader = spark.read.schema(dated.schema).option("header", True)
        return reader.option("emptyValue", "").option("nullValue", "\\N").format(fmt).load(f"{root}/{fmt}")

    return query


def _streamed_within(length: str) -> Query:
    """The stream beside its exact batch form: a row per window of either, with whether the
    count is within three standard errors of a sketch, or one user; the stream's is exact."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = ["window_start", "window_end"]
        stored = _streamed("active_users", length)(spark, sf_dir).select(
            *keys, F.col("active_users").alias("near")
        )
        events = Inputs(spark, sf_dir).stream_events()
        exact = speed.closed_windows(
            speed.active_users(events, length, exact=True), events.where(F.col("event_type") == "LOGIN")
        )
        exact = as_ntz(exact).select(F.col("start").alias("window_start"), F.col("end").alias("window_end"), "active_users")
        off = F.abs(F.col("near") - F.col("active_users"))
        within = off <= F.greatest(F.lit(1.0), 3 * 0.05 * F.col("active_users"))
        return stored.join(exact, keys, "full").select(
            *keys, F.coalesce(within, F.lit(False)).alias("within")
        )

    return query


def _topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark.readStream.schema(SOURCE_SCHEMA).parquet(f"{sf_dir}/events*.parquet"))


def _streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "sessions")
    raw = _topic_stream(spark, sf_dir)
    streaming = realtime_streams.start_sessions(raw, f"{root}/out", f"{root}/checkpoint", SESSION_GAP, interval=None)
    streaming.awaitTermination()
    kinds = realtime_streams.SESSIONS
    return as_ntz(read_batches(spark, f"{root}/out", kinds).select(*kinds.names))


def _streamed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "reads")
    raw = _topic_stream(spark, sf_dir)
    streaming = realtime_streams.start_reads(raw, f"{root}/out", f"{root}/checkpoint", READ_WITHIN, interval=None)
    streaming.awaitTermination()
    kinds = realtime_streams.READS
    return as_ntz(read_batches(spark, f"{root}/out", kinds).select(*kinds.names))


def _streamed_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "queue")
    raw = _topic_stream(spark, sf_dir)
    realtime_streams.start_grading_queue(raw, f"{root}/out", f"{root}/checkpoint", interval=None).awaitTermination()
    return as_ntz(realtime_streams.read_queue(spark, f"{root}/out"))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a stream that is sent twice, as the master dataset keeps them."""
    root = shared_folder(spark, "replayed")
    twice = _topic_stream(spark, sf_dir).unionByName(_topic_stream(spark, sf_dir))
    master_sink(deduplicated(twice), f"{root}/data", f"{root}/checkpoint", None).start().awaitTermination()
    parts = [read_topic(spark, f"{root}/data", topic) for topic in TOPICS.values()]
    return as_ntz(reduce(DataFrame.unionByName, parts))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a master dataset whose closed days have been put together."""
    root = shared_folder(spark, "compacted")
    raw = raw_events(spark, sf_dir).withColumn("arrived", F.col("timestamp")).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(2)))
    raw = _in_bulk(raw)
    fields = T.StructType([RAW["key"], RAW["value"], RAW["timestamp"], T.StructField("arrived", T.TimestampType())])
    for part in (0, 1):
        write_batch(raw.where(F.col("part") == part).drop("part"), root, part, "timestamp", "topic")
    before = (CUT - datetime.date(1970, 1, 1)).days
    parts = []
    for topic in TOPICS.values():
        compact(spark, f"{root}/topic={topic}", fields, before, 1)
        rows = read_batches(spark, f"{root}/topic={topic}", fields).withColumn("topic", F.lit(topic))
        parts.append(rows.select("key", "value", "topic", F.col("arrived").alias("timestamp")))
    return as_ntz(reduce(DataFrame.unionByName, parts))


def _popular(i: Inputs) -> DataFrame:
    """Videos with a fiftieth of a day's views or more, by exact counts, and whether the
    sketches of the day's hours name them with a number within their error."""
    events = i.stream_events()
    near = realtime.popular_videos(realtime.popularity_sketches(events, "1 hour"), "1 day", 100)
    exact = speed.video_engagement(events.where(F.col("video_id").isNotNull()), "1 day")
    whole = F.sum("views").over(Window.partitionBy("start"))
    heavy = exact.withColumn("_all", whole).where(F.col("views") * 50 >= F.col("_all"))
    a, b = heavy.alias("a"), near.alias("b")
    match = (F.col("a.start") == F.col("b.window_start")) & (F.col("a.video_id") == F.col("b.video_id"))
    within = F.abs(F.col("a.views") - F.col("b.views")) <= F.col("error")
    return a.join(b, match, "left").select(
        "start", F.col("a.video_id").alias("video_id"), F.col("a.views").alias("views"),
        F.coalesce(within, F.lit(False)).alias("within"),
    )


def _alerts(i: Inputs) -> DataFrame:
    """Courses whose interactions in six hours rise to three, until they fall to one."""
    windows = speed.course_popularity(i.stream_events(), "6 hours")
    return alerts.crossings(windows, ["course_id"], "start", "interactions", 3, 1)


def _warnings(i: LayeredInputs) -> DataFrame:
    """What the audit says of the stored layers where the speed views are missing."""
    i.store_views()
    roots = {"master": f"{i.root}/master", "batch": f"{i.root}/views", "speed": f"{i.root}/none"}
    return records.consistency_warnings(records.freshness(i.spark, roots, F.current_timestamp()))


SESSION_GAP, READ_WITHIN = "6 hours", "3 days"

REALTIME: dict[str, Callable[[Inputs], DataFrame]] = {
    "auth_realtime_session_activity": lambda i: realtime.session_activity(i.stream_events(), SESSION_GAP),
    "auth_peak_concurrent_users": lambda i: realtime.concurrency(realtime.logged_in(i.topic("auth"))),
    "video_realtime_concurrent_viewers": lambda i: realtime.concurrency(
        realtime.watching(i.topic("video")), 15 * 60
    ),
    "course_material_access_times": lambda i: realtime.access_times(i.topic("course")),
    "course_material_access_summary": lambda i: realtime.access_summary(i.topic("course")),
    "notification_read_times": lambda i: realtime.reads_by_time(
        *realtime.reading_sides(i.topic("notification").where("timestamp_parsed IS NOT NULL"), "timestamp_parsed"), 3 * 86400
    ),
    "notification_reading_summary": lambda i: realtime.reading_summary(
        realtime.reads_by_time(
            *realtime.reading_sides(i.topic("notification").where("timestamp_parsed IS NOT NULL"), "timestamp_parsed"), 3 * 86400
        )
    ),
    "video_realtime_popular_videos": _popular,
    "alert_course_activity": _alerts,
    "assessment_realtime_grading_queue": lambda i: realtime.grading_queue(i.topic("assessment")),
}

STREAMED: dict[str, Query] = {
    "ingest_deduplicated": _replayed,
    "ingest_compacted": _compacted,
    "stream_session_activity": _streamed_sessions,
    "stream_notification_reads": _streamed_reads,
    "stream_grading_queue": _streamed_queue,
    "ingest_master_dataset": _ingested,
    "batch_run_all": _run_all,
    **{
        f"refresh_{table}": _refreshed(table)
        for table in (*refresh.COPIED, "student_course_enrollment", "course_student_enrollment")
    },
    "batch_run_notifications": _run_job("profile_notification", "notification_user_summary"),
    "batch_run_student_courses": _run_job("student_course_analytics", "student_course_detailed"),
    "records_export_json": _exported("json"),
    "records_export_parquet": _exported("parquet"),
    "records_export_csv": _exported("csv"),
    "ingest_topic_read": lambda spark, sf_dir: as_ntz(
        read_topic(spark, _master(spark, sf_dir), TOPICS["course"])
    ),
    "stream_active_users": _streamed_within("1 minute"),
    "stream_course_popularity": _streamed("course_popularity", "1 minute"),
    "stream_video_engagement_15min": _streamed("video_engagement", "15 minutes"),
}

# ---- serving -----------------------------------------------------------------


def _enrollment(i: Inputs) -> DataFrame:
    return keyed.enrollment_table(i.view("student_course_enrollment"))


SERVE: dict[str, Callable[[Inputs], DataFrame]] = {
    **{
        f"table_speed_{name}": (lambda i, name=name: i.speed_view(name))
        for name in ("active_users", "course_popularity", "video_engagement")
    },
    **{
        f"table_{name}": (lambda i, name=name: keyed.conform_batch(i.view(name), name, i.as_of()))
        for name in (
            "course_overview",
            "student_overview",
            "student_course_detailed",
            "auth_daily_active_users",
        )
    },
    "table_student_course_enrollment": lambda i: keyed.by_student(_enrollment(i)),
    "table_course_student_enrollment": lambda i: keyed.by_course(_enrollment(i)),
    "serve_batch_summary": lambda i: serving.batch_summary(
        *i.views("student_overview", "course_overview")
    ),
    "serve_student_engagement_distribution": lambda i: serving.student_engagement_distribution(
        i.view("student_overview")
    ),
    "serve_historical_dau": lambda i: serving.historical_dau(
        i.view("auth_daily_active_users"), i.as_of(), hours=24 * 10
    ),
    "serve_batch_activity_stats": lambda i: serving.batch_activity_stats(
        i.view("course_overview")
    ),
    "serve_all_courses": lambda i: serving.all_courses(i.view("course_overview")),
    "serve_all_students": lambda i: serving.all_students(i.view("student_overview")),
    "serve_course_details": lambda i: serving.course_details(
        i.view("course_overview"), "COURSE007"
    ),
    "serve_student_details": lambda i: serving.student_details(
        i.view("student_overview"), "SV000041"
    ),
    "serve_course_students": lambda i: serving.course_students(
        i.view("student_course_enrollment"), "COURSE007"
    ),
    "serve_student_courses": lambda i: serving.student_courses(
        i.view("student_course_enrollment"), "SV000041"
    ),
    "serve_student_course_performance": lambda i: serving.student_course_performance(
        i.view("student_course_detailed"), "SV000046", "COURSE010"
    ),
    "serve_speed_summary": lambda i: serving.speed_summary(
        i.speed_view("active_users"), i.speed_view("course_popularity", 1), i.as_of()
    ),
    "serve_recent_activity": lambda i: serving.recent_activity(
        i.speed_view("video_engagement", 24), i.speed_view("course_popularity", 24), i.as_of(), hours=24
    ),
    "serve_realtime_active_users": lambda i: serving.realtime_active_users(
        i.speed_view("active_users", 48), i.as_of(), hours=48
    ),
    "serve_course_popularity": lambda i: serving.course_popularity(
        i.speed_view("course_popularity", 24), i.as_of(), hours=24
    ),
    "serve_video_stats": lambda i: serving.video_stats(
        i.speed_view("video_engagement", 24), i.as_of(), hours=24
    ),
    "serve_latest_active_users": lambda i: serving.latest_active_users(
        i.speed_view("active_users")
    ),
    "serve_system_summary": lambda i: serving.system_summary(
        i.speed_view("active_users"),
        i.speed_view("course_popularity"),
        *i.views("student_overview", "course_overview"),
        i.as_of(),
    ),
    "serve_active_user_stats": lambda i: serving.active_user_stats(
        serving.realtime_active_users(i.speed_view("active_users", 48), i.as_of(), hours=48)
    ),
    "serve_activity_comparison": lambda i: serving.activity_comparison(
        serving.recent_activity(
            i.speed_view("video_engagement", 1), i.speed_view("course_popularity", 1), i.as_of()
        ),
        serving.batch_activity_stats(i.view("course_overview")),
    ),
    "serve_engagement_long_form": lambda i: serving.engagement_long_form(
        serving.student_engagement_distribution(i.view("student_overview"))
    ),
    "serve_total_interactions": lambda i: serving.total_interactions(
        serving.course_popularity(i.speed_view("course_popularity", 24), i.as_of(), hours=24)
    ),
    "serve_available_columns": lambda i: serving.available_columns(
        i.view("course_overview"),
        [
            "course_id",
            "total_enrolled_students",
            "total_videos_watched",
            "total_assignments_submitted",
        ],
    ),
}

# ---- record-level jobs ---------------------------------------------------------


def _enrolment_rows(i: Inputs) -> DataFrame:
    return i.table("orders").select(
        F.col("o_custkey").alias("student_id"),
        F.col("o_orderpriority").alias("class_id"),
        F.col("o_orderstatus").alias("semester"),
        F.col("o_orderdate").cast("timestamp").alias("enroll_date"),
        F.col("o_orderkey").alias("position"),
    )


def _dated_rows(i: Inputs) -> DataFrame:
    return i.topic("course").select(
        F.col("user_id").alias("student_id"),
        F.col("timestamp").alias("event_time"),
        F.col("timestamp_parsed").cast("date").alias("NgayHoc"),
        F.col("timestamp").alias("note"),
        (F.unix_micros("timestamp_parsed") * 1000 - 1).alias("time_ns"),
    )


def _grades(i: Inputs) -> DataFrame:
    return i.table("lineitem").select(
        F.col("l_orderkey").alias("student_id"),
        F.col("l_linenumber").alias("class_id"),
        (F.col("l_quantity").cast("decimal(6,2)") / 5).cast("decimal(6,2)").alias("midterm_score"),
        (F.col("l_discount").cast("decimal(6,2)") * 100).cast("decimal(6,2)").alias("final_score"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("0.3"))
        .otherwise(F.lit("0.4"))
        .cast("decimal(4,3)")
        .alias("weight_mid"),
    )


RECORDS: dict[str, Callable[[Inputs], DataFrame]] = {
    "records_dedupe_enrollments": lambda i: records.dedupe_enrollments(
        _enrolment_rows(i), ["position"]
    ),
    "records_normalise_dates": lambda i: records.normalise_dates(_dated_rows(i)),
    "records_grade_totals": lambda i: records.grade_totals(_grades(i)),
    "records_compacted_profiles": lambda i: records.compacted(
        i.raw().where(F.col("topic") == "profile_topic")
    ),
    "records_retained": lambda i: records.retained(i.raw(), "2024-02-15 00:00:00").select(
        "key", "topic", "timestamp"
    ),
    "audit_freshness": lambda i: records.topic_freshness(
        i.raw(), i.raw().agg(F.max("timestamp")).scalar(), recent_seconds=7 * 86400
    ),
    "records_event_mix": lambda i: records.event_mix(i.raw()),
}


def queries() -> dict[str, Query]:
    built = {**INGEST, **WINDOWED, **REALTIME, **SERVE, **RECORDS}
    reads = {name: StoredInputs for name in SERVE if name.startswith("serve_")}
    return {
        **{name: _view_query(name) for name in VIEWS},
        **{name: _query(build, reads.get(name, Inputs)) for name, build in built.items()},
        **{name: _query(build, LayeredInputs) for name, build in LAYERED.items()},
        "batch_run_incremental": _query(_incremental),
        "audit_warnings": _query(_warnings, LayeredInputs),
        "lookup_course_students": _query(
            lambda i: serving.course_students(i.table_of("course_student_enrollment"), "COURSE007"), StoredInputs
        ),
        "lookup_student_courses": _query(
            lambda i: serving.student_courses(i.table_of("student_course_enrollment"), "SV000041"), StoredInputs
        ),
        **STREAMED,
    }
