"""Alerts on measures per key and time, with hysteresis: one row per crossing.

A key is raised when its measure reaches `high` and cleared when it has come down to
`low`; between the two it stays as it is, so a measure that trembles at a limit does not
alert again and again. Times without a row say nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.keyed import lookup_join, newest
from lectern.functions.timeline import bucket_of
from lectern.sources.batches import read_batches, write_batch

# Limits of the monitored measures.
HIGH = {
    "failed_logins_per_minute": 10,
    "concurrent_sessions": 1000,
    "submissions_per_minute": 50,
    "grading_queue": 100,
    "concurrent_viewers": 500,
    "enrollments_per_minute": 20,
    "material_accesses": 100,
}


def signals(measures: DataFrame, keys: Sequence[str], time: str, value: str, high: float, low: float) -> DataFrame:
    """The rows that decide a key's state: 1 at `high` and above, 0 at `low` and below."""
    decided = F.when(F.col(value) >= high, 1).when(F.col(value) <= low, 0)
    return measures.select(*keys, time, value, decided.alias("signal")).where(
        F.col("signal").isNotNull() & F.col(time).isNotNull()
    )


def crossings(
    measures: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    high: float,
    low: float,
    seconds: int = 86400,
    before: DataFrame | None = None,
) -> DataFrame:
    """(keys, time, value, raised) where a key's state changes. `before` has (keys, signal)
    of states from earlier on; a key begins cleared.

    The row before is found inside buckets of time, and across them among their last rows,
    so a key with a long history is no group of its own. Measures at one time count from
    the smallest.
    """
    decided = signals(measures, keys, time, value, high, low).withColumn("_bucket", bucket_of(time, seconds))
    last = decided.groupBy(*keys, "_bucket").agg(F.max(F.struct(time, value, "signal"))["signal"].alias("_last"))
    earlier = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))
    carried = last.select(*keys, "_bucket", earlier.alias("_carried"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(time, value)
    near = lookup_join(decided.withColumn("_near", F.lag("signal").over(inside)), carried, [*keys, "_bucket"], "left")
    known = F.coalesce("_near", "_carried")
    if before is not None:
        near = lookup_join(near, before.select(*keys, F.col("signal").alias("_before")), list(keys), "left")
        known = F.coalesce(known, "_before")
    changed = near.where(F.col("signal") != F.coalesce(known, F.lit(0)))
    return changed.select(*keys, time, value, (F.col("signal") == 1).alias("raised"))


def write_alerts(
    measures: DataFrame, batch_id: int, root: str, keys: Sequence[str], time: str, value: str, high: float, low: float
) -> None:
    """The alerts of one micro-batch of closed windows, after the states that earlier ones left.

    Alerts and states are directories of the batch, so it can run again: it reads the
    states of the batches before it and replaces its own.
    """
    spark, root = measures.sparkSession, root.rstrip("/")
    state = measures.select(*keys, time).limit(0).withColumn("signal", F.lit(0)).schema
    stored = read_batches(spark, f"{root}/states", state).where(F.col("batch_id") < batch_id)
    before = newest(stored.select(*keys, "batch_id", "signal"), list(keys), ["batch_id"])
    write_batch(crossings(measures, keys, time, value, high, low, before=before), f"{root}/alerts", batch_id, time)
    decided = signals(measures, keys, time, value, high, low)
    after = decided.groupBy(*keys).agg(F.max(F.struct(time, value, "signal")).alias("s"))
    write_batch(after.select(*keys, F.col(f"s.{time}").alias(time), "s.signal"), f"{root}/states", batch_id, time)
