"""Running values over time that no single task has to hold whole.

A running sum, or the last value so far, over the whole history of one key would put all
of that key's rows in one task. Here time is cut into buckets: each bucket is summed up on
its own, the bucket totals run over the few buckets, and a second pass runs inside each
bucket from what the buckets before it left. No group is larger than one bucket of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.keyed import lookup_join


def bucket_of(time: str, seconds: int) -> Column:
    """The number of the bucket that a timestamp column falls in."""
    return F.floor(F.unix_seconds(time) / seconds).cast("bigint")


def running_total(changes: DataFrame, keys: Sequence[str], time: str, delta: str, seconds: int) -> DataFrame:
    """(keys, time, bucket, carried, total): the sum of `delta` up to each instant, per key.

    One row per key and instant that has a change; `carried` is the total before the
    bucket's first change. Changes at the same instant count together.
    """
    instants = changes.groupBy(*keys, time).agg(F.sum(delta).alias("_change"))
    instants = instants.withColumn("bucket", bucket_of(time, seconds))
    sums = instants.groupBy(*keys, "bucket").agg(F.sum("_change").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumn("carried", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "bucket").orderBy(time)
    return (
        lookup_join(instants, carried, [*keys, "bucket"], "inner")
        .withColumn("total", F.col("carried") + F.sum("_change").over(inside))
        .drop("_change")
    )


def last_before(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, value_time: str, seconds: int
) -> DataFrame:
    """`left` with the largest `value_time` of `right` up to `time`, per key; NULL without one.

    An as-of join without a join: both sides are one sequence in which the last value
    runs on. Rows of `left` with a NULL key or time match nothing; they stay.
    """
    usable = F.col(time).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    marks = right.select(*keys, F.col(value_time).alias("_at")).dropna().distinct()
    rows = left.withColumn("_row", F.struct(*left.columns))
    both = rows.where(usable).select(*keys, F.col(time).alias("_time"), "_row").unionByName(
        marks.select(*keys, F.col("_at").alias("_time"), "_at"), allowMissingColumns=True
    )
    both = both.withColumn("_bucket", bucket_of("_time", seconds))
    newest = both.groupBy(*keys, "_bucket").agg(F.max("_at").alias("_at"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select(*keys, "_bucket", F.max("_at").over(before).alias("_carried"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_time").rangeBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_at", F.max("_at").over(inside)).where(F.col("_row").isNotNull())
    matched = lookup_join(within, carried, [*keys, "_bucket"], "left").select(
        "_row.*", F.coalesce("_at", "_carried").alias(value_time)
    )
    rest = left.where(~usable).withColumn(value_time, F.lit(None).cast(right.schema[value_time].dataType))
    return matched.unionByName(rest)
