"""Serving tables: conformance to their schemas, and keyed (last write wins) storage."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.keyed import newest
from lectern.schemas import SERVING, SERVING_KEYS
from lectern.sources import versions
from lectern.sources.batches import day_number, read_batches, write_batch
from lectern.sources.compaction import compact

log = logging.getLogger(__name__)

# Serving column <- view column, where their names differ.
ALIASES: dict[str, dict[str, str]] = {
    "active_users": {"window_start": "start", "window_end": "end"},
    "course_popularity": {"window_start": "start", "window_end": "end"},
    "video_engagement": {"window_start": "start", "window_end": "end"},
    "student_course_enrollment": {"videos_watched": "total_videos_watched"},
    "student_course_detailed": {"last_activity": "last_activity_date"},
}


def conform(
    view: DataFrame, table: str, constants: Mapping[str, Column] | None = None
) -> DataFrame:
    """A view in the schema of serving table `table`.

    Values missing from the view, or NULL in it, become 0 in numeric columns and
    stay NULL elsewhere.
    """
    constants = constants or {}
    names = ALIASES.get(table, {})

    def column(field: T.StructField) -> Column:
        source = names.get(field.name, field.name)
        if field.name in constants:
            value = constants[field.name]
        elif source in view.columns:
            value = F.col(source)
        else:
            value = F.lit(None)
        value = value.cast(field.dataType)
        if isinstance(field.dataType, T.NumericType):
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        return value.alias(field.name)

    return view.select(*[column(f) for f in SERVING[table].fields])


def conform_speed(view: DataFrame, table: str) -> DataFrame:
    return conform(view, table, {"source": F.lit("speed")} if table == "active_users" else None)


def conform_batch(view: DataFrame, table: str, as_of: Column) -> DataFrame:
    stamp = {"last_updated": as_of} if "last_updated" in SERVING[table].names else None
    return conform(view, table, stamp)


def enrollment_table(view: DataFrame) -> DataFrame:
    """`student_course_enrollment` rows, one per (student, course): the newest enrolment."""
    rows = conform(view, "student_course_enrollment")
    keys = SERVING_KEYS["student_course_enrollment"]
    return newest(rows.where(_keys_present(keys)), keys, ["enrollment_date"])


def _keys_present(keys) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def by_student(enrollment: DataFrame) -> DataFrame:
    return enrollment.select(*SERVING["student_course_enrollment"].names)


def by_course(enrollment: DataFrame) -> DataFrame:
    """The reverse lookup: the same rows with the course first."""
    first = ["course_id", "student_id"]
    return enrollment.select(*first, *[c for c in enrollment.columns if c not in first])


def write_lookup(table: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    """Full refresh of a lookup table laid out so that a key's row groups can be skipped.

    Range partitioning over all keys, so one hot leading key spans several files.
    """
    laid_out = table.repartitionByRange(*keys).sortWithinPartitions(*keys)
    versions.replace(table.sparkSession, path, laid_out.write.parquet)


def read_lookup(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A lookup table as it was last written."""
    if table == "course_student_enrollment":
        return by_course(versions.read(spark, path, SERVING["student_course_enrollment"]))
    return versions.read(spark, path, SERVING[table])


def write_enrollment_tables(view: DataFrame, root: str) -> None:
    """Both lookup directions. The second is made from the first as written, so
    the reduction to newest rows runs once."""
    spark = view.sparkSession
    forward = f"{root.rstrip('/')}/student_course_enrollment"
    write_lookup(enrollment_table(view), forward, ("student_id", "course_id"))
    stored = read_lookup(spark, forward, "student_course_enrollment")
    write_lookup(
        by_course(stored),
        f"{root.rstrip('/')}/course_student_enrollment",
        ("course_id", "student_id"),
    )


def upsert(rows: DataFrame, path: str, table: str, batch_id: int) -> int:
    """Insert speed rows under their primary key; `read_keyed` lets the newest batch win.

    Rows without a key cannot be stored under it. How many there were is returned, and
    logged if there were any.
    """
    present = _keys_present(SERVING_KEYS[table])
    seen = Observation(f"upsert_{table}_{batch_id}")
    counted = rows.observe(seen, F.count(F.when(~present, 1)).alias("without_key"))
    write_batch(counted.where(present), path, batch_id, "window_start")
    missing = seen.get["without_key"]
    if missing:
        log.warning("%s, batch %s: %s rows without a key", table, batch_id, missing)
    return missing


def read_keyed(
    spark: SparkSession, path: str, table: str, since: Column | None = None
) -> DataFrame:
    """The table's rows, one per key. `since` reads only the days from that time on."""
    schema, keys = SERVING[table], SERVING_KEYS[table]
    stored = read_batches(spark, path, schema)
    if since is not None:
        stored = stored.where(
            (F.col("day") >= day_number(since)) & (F.col("window_start") >= since)
        )
    return newest(stored.drop("day"), keys, ["batch_id"]).select(*schema.names)


def compact_keyed(spark: SparkSession, path: str, table: str, before_day: int, committed: int) -> list[int]:
    """Put the batches of a keyed table's closed days together, one row per key."""
    keys = SERVING_KEYS[table]
    one = lambda rows: newest(rows, keys, ["batch_id"])
    return compact(spark, path, SERVING[table], before_day, committed, one)
