"""Few directories instead of many: closed days of a table of micro-batches, rewritten as one.

The batches of a day up to a committed one, which no stream runs again, are written
together below a negative batch id. A log, replaced whole, then says up to which batch
each day has been rewritten, and from that moment readers take the one directory for the
many. Before it they ignore it, so a compaction that dies is not seen and can be
repeated. The many are removed by the next compaction, when no reader is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.sources import manifest, versions
from lectern.sources.batches import replace_directories
from lectern.sources.layout import LOG, PARTITIONS, live, log_path


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The newest batch that a stream has finished, from its checkpoint; -1 before the first."""
    path = f"{checkpoint.rstrip('/')}/commits"
    if not versions.exists(spark, path):
        return -1
    return max((int(n) for n in versions.names(spark, path) if n.isdigit()), default=-1)


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    before_day: int,
    committed: int,
    combine: Callable[[DataFrame], DataFrame] | None = None,
) -> list[int]:
    """Rewrite the days before `before_day` that have several live directories; returns them.

    `combine` may merge rows (with day and batch_id) of a day, such as to the newest per key.
    """
    if committed < 0 or not versions.exists(spark, path):
        return []
    old = versions.read(spark, log_path(path), LOG).collect()
    log = spark.createDataFrame(old, LOG)
    versions.replace(spark, log_path(path), log.coalesce(1).write.parquet)  # from now on readers look here
    every = manifest.directories(spark, path).where("day IS NOT NULL")
    kept = live(spark, path, every)
    closed = (F.col("day") < before_day) & (F.col("batch_id") <= committed)
    many = kept.where(closed).groupBy("day").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    days = sorted(r["day"] for r in many.select("day").collect())
    superseded = every.join(log.select(F.col("day").alias("_day")).distinct(), F.col("day") == F.col("_day"))
    superseded = superseded.select(*every.columns).join(kept, manifest.same(every, kept, ["day", "batch_id"]), "left_anti")
    manifest.drop_directories(spark, path, superseded)
    if not days:
        return []
    parts = T.StructType([*schema.fields, *PARTITIONS.fields])
    rows = live(spark, path, spark.read.schema(parts).parquet(path).where(F.col("day").isin(days)))
    rows = rows.where(F.col("batch_id") <= committed)
    rows = (combine(rows) if combine else rows).withColumn("batch_id", F.lit(-committed - 1).cast("bigint"))
    replace_directories(rows.select(*parts.names).hint("rebalance", "day"), path, "day", "batch_id")
    now = [(r["day"], r["up_to"]) for r in old if r["day"] not in set(days)] + [(d, committed) for d in days]
    versions.replace(spark, log_path(path), spark.createDataFrame(now, LOG).coalesce(1).write.parquet)
    return days
