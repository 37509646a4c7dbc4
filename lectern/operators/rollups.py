"""Mergeable states: the events of a topic, counted per combination of what the views group by.

A rollup row holds its keys, how many events it stands for, and sums, smallest and
largest values of what the views measure. Rollups of any parts of a topic, put together,
say the same as the rollup of the whole: the views take sums of counts and sums,
extremes of extremes, and distinct counts over the keys, so nothing depends on how
the events were dealt to rollups. A day's rollup is made once; a view over years is an
aggregate of rollups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.schemas import EVENT

TIME = "timestamp_parsed"
DAY = {"date": f"to_date({TIME})"}
ROWS = {"rows": ("count", "1")}
EXTENT = {"first": ("min", TIME), "last": ("max", TIME)}
SKETCHED = ("date", "event_type")
#: A sketch has 2^12 registers: a relative standard error of 1.04 / 2^6, 1.6 %.
SKETCH_BITS = 12
#: Sums of seconds since 1970 leave 64 bits for a hot key.
SECONDS = {"timed": ("count", TIME), "seconds": ("sum", f"CAST(unix_timestamp({TIME}) AS DECIMAL(12,0))")}


def _numbers(name: str, column: str) -> dict[str, tuple[str, str]]:
    return {f"{name}_{kind}": (kind, column) for kind in ("count", "sum", "min", "max")}


@dataclass(frozen=True)
class Rollup:
    """What a topic's events are grouped by and what is measured, as SQL expressions."""

    topic: str
    columns: tuple[str, ...]
    derived: dict[str, str] = field(default_factory=dict)
    measures: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return [*self.columns, *self.derived]


ROLLUPS: dict[str, Rollup] = {
    r.topic: r
    for r in (
        Rollup(
            "auth",
            ("event_type", "user_id", "role", "session_id", "registration_source"),
            {"hour_start": f"date_trunc('HOUR', {TIME})"},
            {**ROWS, **SECONDS, **EXTENT},
        ),
        Rollup(
            "assessment",
            (
                "event_type", "user_id", "role", "student_id", "course_id", "assignment_id",
                "assignment_type", "quiz_id",
            ),
            DAY,
            {**ROWS, **SECONDS, **EXTENT, **_numbers("score", "score"), **_numbers("answers", "correct_answers")},
        ),
        Rollup(
            "video",
            ("event_type", "user_id", "role", "video_id", "course_id"),
            DAY,
            {**ROWS, "sessions": ("count", "session_id"), **_numbers("watch", "watch_duration_seconds")},
        ),
        Rollup(
            "course",
            ("event_type", "user_id", "role", "course_id", "material_id", "material_type", "resource_id"),
            {**DAY, "enrolled_at": f"CASE WHEN event_type = 'COURSE_ENROLLED' THEN {TIME} END"},
            {**ROWS, **EXTENT},
        ),
        Rollup("profile", ("event_type", "user_id", "field_name"), DAY, {**ROWS, **EXTENT}),
        Rollup(
            "notification",
            ("event_type", "user_id", "notification_type"),
            DAY,
            {**ROWS, "ids": ("count", "notification_id")},
        ),
    )
}


def roll(events: DataFrame, topic: str, also: Sequence[str] = ()) -> DataFrame:
    """The rollup of typed events, per value of the columns in `also` too."""
    rollup = ROLLUPS[topic]
    keys = [F.col(c) for c in (*also, *rollup.columns)]
    keys += [F.expr(rule).alias(name) for name, rule in rollup.derived.items()]
    measures = [F.expr(f"{kind}({rule})").alias(name) for name, (kind, rule) in rollup.measures.items()]
    return events.groupBy(*keys).agg(*measures)


def merge(rollups: DataFrame, topic: str, also: Sequence[str] = ()) -> DataFrame:
    """One row per key of rollups of several parts: a rollup of their union."""
    rollup = ROLLUPS[topic]
    kinds = dict(rollups.dtypes)
    combine = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    measures = [
        combine[kind](name).cast(kinds[name]).alias(name) for name, (kind, _) in rollup.measures.items()
    ]
    return rollups.groupBy(*also, *rollup.keys).agg(*measures)


def rollup_schema(topic: str) -> T.StructType:
    """The columns of a topic's rollup."""
    rollup = ROLLUPS[topic]
    fields = {f.name: f.dataType for f in EVENT[topic].fields}
    fields |= {"date": T.DateType(), "hour_start": T.TimestampType(), "enrolled_at": T.TimestampType()}
    kinds = {"count": T.LongType(), "first": T.TimestampType(), "last": T.TimestampType()}

    def kind(name: str, how: str, rule: str) -> T.DataType:
        if name == "seconds":
            return T.DecimalType(22, 0)
        return kinds.get(how) or kinds.get(name) or (T.LongType() if how == "sum" else fields[rule])

    return T.StructType(
        [T.StructField(k, fields[k]) for k in rollup.keys]
        + [T.StructField(n, kind(n, how, rule)) for n, (how, rule) in rollup.measures.items()]
    )


def sketch(rollup: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Users per day and event type as sketches of fixed size, whatever their number."""
    return rollup.groupBy(*also, *SKETCHED).agg(
        F.hll_sketch_agg("user_id", SKETCH_BITS).alias("users"), F.sum("rows").alias("rows")
    )


def daily_users(sketches: DataFrame) -> DataFrame:
    """Events and about how many users, per day and event type, from sketches of any parts."""
    users = F.hll_sketch_estimate(F.hll_union_agg("users"))
    return sketches.groupBy(*SKETCHED).agg(users.alias("users"), F.sum("rows").alias("events"))


# ---- expressions over rollup rows ---------------------------------------------


def events_where(condition: Column | None = None, of: str = "rows") -> Column:
    """How many events the rows that meet `condition` stand for."""
    counted = F.col(of) if condition is None else F.when(condition, F.col(of))
    return F.coalesce(F.sum(counted), F.lit(0))


def known(column: str, condition: Column | None = None) -> Column:
    """How many events have a value in a key column: what `count(column)` is over events."""
    present = F.col(column).isNotNull()
    return events_where(present if condition is None else present & condition)


def mean(name: str, condition: Column | None = None) -> Column:
    """The average of a measured number; NULL without any."""
    part = lambda c: F.col(c) if condition is None else F.when(condition, F.col(c))
    return F.try_divide(F.sum(part(f"{name}_sum")), F.sum(part(f"{name}_count")))


def pair_sides(prefix: str) -> list[Column]:
    """`lectern.functions.keyed.pair_stats` of the events behind rollup rows."""
    return [
        F.sum("rows").alias(f"{prefix}_rows"),
        F.sum("timed").alias(f"{prefix}_timed"),
        F.sum("seconds").cast("decimal(22,0)").alias(f"{prefix}_sum"),
        F.min(F.unix_timestamp("first")).alias(f"{prefix}_min"),
        F.max(F.unix_timestamp("last")).alias(f"{prefix}_max"),
    ]
