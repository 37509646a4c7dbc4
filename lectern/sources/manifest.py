"""What a derived table was made from: directories of a source and a mark of their files.

A source's directories are `day=/batch_id=`. Their files have names of their own, so a
directory that a batch wrote again has another mark than the first attempt. The manifest
is a table beside the derived one, replaced whole once the derived one stands: a run that
dies in between finds the same directories changed and makes them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.schemas import ddl
from lectern.sources import versions
from lectern.sources.layout import PARTITIONS
from lectern.sources.listing import data_files

DIRECTORIES = T.StructType([*PARTITIONS.fields, *ddl("mark BIGINT").fields])
DAYS = ddl("day BIGINT, mark BIGINT")


def _number(name: str) -> Column:
    """The number in a directory name; NULL for other names or none."""
    return F.regexp_extract("path", f"/{name}=([^/]+)/", 1).try_cast("bigint")


def directories(spark: SparkSession, root: str) -> DataFrame:
    """(day, batch_id, mark) of the directories below `root` that hold data files."""
    name = F.element_at(F.split("path", "/"), -1)
    files = data_files(spark, root).select(
        _number("day").alias("day"), _number("batch_id").alias("batch_id"),
        F.xxhash64(name, "length", "modificationTime").alias("file"),
    )
    return files.groupBy("day", "batch_id").agg(F.bit_xor("file").alias("mark"))


def days(directories: DataFrame, *also: Column) -> DataFrame:
    """(day, mark) of whole days. What is in `also` changes the marks too."""
    one = F.bit_xor(F.xxhash64("batch_id", "mark"))
    return directories.groupBy("day").agg(F.xxhash64(one, *also).alias("mark"))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return versions.read(spark, path, schema)


def write(manifest: DataFrame, path: str) -> None:
    versions.replace(manifest.sparkSession, path, manifest.write.parquet)


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """The entries of `now` that are new or have another mark than in `before`."""
    return now.join(before, same(now, before, now.columns), "left_anti")


def gone(now: DataFrame, before: DataFrame) -> DataFrame:
    """The entries of `before` that `now` has no longer."""
    keys = [c for c in now.columns if c != "mark"]
    return before.join(now, same(before, now, keys), "left_anti")


def on_days(days: list[int | None]) -> Column:
    """Rows of these days, as a condition that prunes directories."""
    condition = F.col("day").isin([d for d in days if d is not None])
    return condition | F.col("day").isNull() if None in days else condition


def drop_directories(spark: SparkSession, root: str, entries: DataFrame) -> None:
    """Delete the directories of `entries`: (day) or (day, batch_id)."""
    names = [c for c in entries.columns if c != "mark"]
    for row in entries.select(*names).coalesce(1).toLocalIterator():
        at = "/".join(f"{n}={'__HIVE_DEFAULT_PARTITION__' if row[n] is None else row[n]}" for n in names)
        versions.delete(spark, f"{root.rstrip('/')}/{at}")
