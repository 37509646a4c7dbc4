"""Which directories of a table of micro-batches count, after some were put together.

`lectern.sources.compaction` writes the log that is read here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.schemas import ddl
from lectern.sources import versions

LOG = ddl("day BIGINT, up_to BIGINT")
PARTITIONS = T.StructType([T.StructField("day", T.LongType()), T.StructField("batch_id", T.LongType())])


def log_path(path: str) -> str:
    """Beside the table and hidden from readers of what is above it."""
    above, _, name = path.rstrip("/").rpartition("/")
    return f"{above}/_compacted/{name}"


def live(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """The rows (or directories) of `rows` that count, by their day and batch_id."""
    if not versions.exists(spark, log_path(path)):
        return rows
    log = versions.read(spark, log_path(path), LOG).select(F.col("day").alias("_day"), "up_to")
    marked = rows.join(F.broadcast(log), F.col("day") == F.col("_day"), "left")
    return marked.where(_counts()).select(*rows.columns)


def _counts() -> Column:
    own = F.col("batch_id")
    fresh = F.col("up_to").isNull() & (own.isNull() | (own >= 0))
    return fresh | (own > F.col("up_to")) | (own == -F.col("up_to") - 1)
