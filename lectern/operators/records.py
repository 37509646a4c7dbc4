"""Record-level jobs: de-duplication, normalising, compaction, retention, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.keyed import newest, oldest
from lectern.operators.serving import AsOf, moment
from lectern.schemas import STREAM_EVENT, TOPICS
from lectern.sources.events import decode
from lectern.sources.listing import data_files

# Name parts that mark a column as a date, in English and Vietnamese.
DATE_NAME_PARTS = ("date", "time", "dob", "ngay", "gio")

# Days a topic keeps its records; a topic not listed keeps all.
RETENTION_DAYS = {
    TOPICS["auth"]: 730,
    TOPICS["assessment"]: 1825,
    TOPICS["video"]: 730,
    TOPICS["course"]: 1095,
    TOPICS["notification"]: 30,
}

# Seconds within which a data set counts as recently written.
RECENT_SECONDS = {"master": 300, "batch": 3600, "speed": 300}


def dedupe_enrollments(enrollments: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row, by `order`, of every student and class."""
    return oldest(enrollments, ["student_id", "class_id"], order)


def normalise_dates(df: DataFrame) -> DataFrame:
    """Date-like columns as text yyyy-MM-ddTHH:mm:ss; NULL or unreadable gives ''."""

    def column(field: T.StructField) -> Column:
        if not any(part in field.name.lower() for part in DATE_NAME_PARTS):
            return F.col(field.name)
        value = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):  # nanoseconds since 1970
            below = F.when(F.pmod(value, F.lit(1000)) != value % 1000, 1).otherwise(0)
            whole = F.call_function("div", value, F.lit(1000)) - below
            value = F.timestamp_micros(whole)
        elif isinstance(field.dataType, T.NumericType):
            value = F.timestamp_micros(F.floor(value / 1000).cast("bigint"))
        text = F.date_format(value.try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
        return F.coalesce(text, F.lit("")).alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def grade_totals(grades: DataFrame) -> DataFrame:
    """Weighted total, rounded half up to 2 places in decimal, and the pass rule."""
    mid = F.col("midterm_score").cast("decimal(6,2)")
    final = F.col("final_score").cast("decimal(6,2)")
    weight = F.col("weight_mid").cast("decimal(4,3)")
    total = F.round(mid * weight + final * (1 - weight), 2).cast("decimal(6,2)")
    return grades.withColumn("total_score", total).withColumn(
        "passed", (mid >= 3) & (final >= 3) & (F.col("total_score") >= 4)
    )


def export(df: DataFrame, root: str, formats: Sequence[str] = ("csv", "json", "parquet")) -> None:
    """The same rows in several formats, one directory each.

    Parquet is written first when asked for, and the others are made from it, so
    the input is computed once.
    """
    root = root.rstrip("/")
    source = df
    for fmt in sorted(formats, key=lambda f: f != "parquet"):
        writer = source.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("encoding", "UTF-8")
        writer.save(f"{root}/{fmt}")
        if fmt == "parquet":
            source = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{fmt}")


def compacted(raw: DataFrame) -> DataFrame:
    """Newest record per key, without keys whose newest record is a deletion (NULL)."""
    keyed = raw.where(F.col("key").isNotNull())
    return newest(keyed, ["key"], ["timestamp"]).where(F.col("value").isNotNull())


def retained(raw: DataFrame, as_of: AsOf) -> DataFrame:
    """Records young enough for their topic, by broker time.

    Plain comparisons on the partition column and the broker time, so whole
    directories and row groups are skipped. A record without a topic is of no listed
    topic, and one without a broker time is not known to be old: both stay.
    """
    now = moment(as_of)
    keep = F.col("topic").isNull() | F.col("timestamp").isNull()
    keep = keep | ~F.col("topic").isin(*RETENTION_DAYS)
    for topic, days in RETENTION_DAYS.items():
        cutoff = now - F.make_dt_interval(days=F.lit(days))
        keep = keep | ((F.col("topic") == topic) & (F.col("timestamp") >= cutoff))
    return raw.where(keep)


def event_mix(raw: DataFrame) -> DataFrame:
    """Events per category and their share, largest first.

    Decoding keeps every row, so the total is a row count of the raw records,
    which reads no column.
    """
    total = raw.agg(F.count(F.lit(1))).scalar()
    return (
        decode(raw, STREAM_EVENT)
        .groupBy("event_category")
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("percentage", F.col("events") / total * 100)
        .orderBy(F.desc("events"), "event_category")
    )


def topic_freshness(
    raw: DataFrame, as_of: AsOf, recent_seconds: int = RECENT_SECONDS["master"]
) -> DataFrame:
    """Per topic its records, the newest broker time, and how many records are recent."""
    age = F.unix_timestamp(moment(as_of)) - F.unix_timestamp("timestamp")
    return raw.groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"),
        F.max("timestamp").alias("newest"),
        F.count(F.when(age < recent_seconds, 1)).alias("recent_records"),
    )


def freshness(spark: SparkSession, roots: dict[str, str], as_of: AsOf) -> DataFrame:
    """Per data set (master, batch, speed): its files and how many are recent."""
    now = F.unix_timestamp(moment(as_of))
    rows = None
    for dataset, root in roots.items():
        age = now - F.unix_timestamp("modificationTime")
        counted = data_files(spark, root).agg(
            F.lit(dataset).alias("dataset"),
            F.count(F.lit(1)).alias("files"),
            F.count(F.when(age < RECENT_SECONDS[dataset], 1)).alias("recent_files"),
        )
        rows = counted if rows is None else rows.unionByName(counted)
    return rows


def consistency_warnings(fresh: DataFrame) -> DataFrame:
    """Warnings that follow from a `freshness` result; no rows when all is well."""

    def of(dataset, column):
        return F.coalesce(F.max(F.when(F.col("dataset") == dataset, F.col(column))), F.lit(0))

    facts = fresh.agg(
        of("master", "files").alias("master"),
        of("master", "recent_files").alias("master_recent"),
        of("batch", "files").alias("batch"),
        of("speed", "files").alias("speed"),
        of("speed", "recent_files").alias("speed_recent"),
    )
    has_master = F.col("master") > 0
    checks = [
        (has_master & (F.col("batch") == 0) & (F.col("speed") == 0), "master data without any view"),
        (
            has_master & (F.col("master_recent") == 0) & (F.col("speed_recent") == 0),
            "no recent master data or speed view",
        ),
        (has_master & (F.col("speed") == 0), "master data without speed views"),
    ]
    found = F.array(*[F.when(bad, F.lit(text)) for bad, text in checks])
    return facts.select(F.explode(F.array_compact(found)).alias("warning"))
