"""Micro-batches as directories: day= (of a time column) and batch_id=, each replaceable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.sources.layout import PARTITIONS, live
from lectern.sources.listing import read_or_empty


def day_number(time: Column) -> Column:
    """Days since 1970 in UTC: the same for writers and readers of any session zone."""
    return F.floor(F.unix_seconds(time.cast("timestamp")) / 86400).cast("bigint")


def write_batch(rows: DataFrame, path: str, batch_id: int, time: str, *first: str) -> None:
    """Write one micro-batch below `first`, `day=` (of its `time` column) and `batch_id=`.

    Only those directories are replaced, so a batch that is run again after a
    failure overwrites its first attempt instead of adding to it. Rows are dealt to
    tasks by directory, and by size where one is large, so that a batch leaves a
    file or so per day and not one per task and day. A stream repeats a batch with the
    same records, so the second attempt has the days of the first.
    """
    dated = rows.withColumn("day", day_number(F.col(time))).withColumn(
        "batch_id", F.lit(batch_id).cast("bigint")
    )
    replace_directories(dated.hint("rebalance", *first, "day"), path, *first, "day", "batch_id")


def replace_directories(rows: DataFrame, path: str, *by: str) -> None:
    """Write rows below directories named by columns, replacing those that the rows have."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches below `path`, with their `day` and `batch_id`.

    Those that a compaction put together count once, below their new batch_id.
    """
    return live(spark, path, read_or_empty(spark, path, T.StructType([*schema.fields, *PARTITIONS.fields])))
