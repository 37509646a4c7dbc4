"""Tables that are replaced whole: each write is a run of its own below the table's path.

Readers take the newest run that Spark has marked as complete, so a write that dies
half-way leaves the table as it was. The run before the newest stays for readers that
have begun with it; what died before that one is removed with the older runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lectern.sources.listing import read_or_empty

PREFIX, DONE = "run-", "_SUCCESS"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a directory."""
    files, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at))


def _runs(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names of the runs, oldest first, and whether each is complete."""
    files, at = _files(spark, path)
    if not files.exists(at):
        return []
    make = spark._jvm.org.apache.hadoop.fs.Path
    return [(n, files.exists(make(f"{path}/{n}/{DONE}"))) for n in names(spark, path) if n.startswith(PREFIX)]


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Give `write` a new run's path; once it has written, the table is that run."""
    path = path.rstrip("/")
    before = _runs(spark, path)
    number = 1 + max((int(n[len(PREFIX) :].split("-")[0]) for n, _ in before), default=0)
    write(f"{path}/{PREFIX}{number:09d}-{uuid.uuid4().hex[:8]}")
    complete = [n for n, done in before if done]
    dead = [n for n, done in before if not done and complete and n < complete[-1]]
    for old in [*complete[:-1], *dead]:
        delete(spark, f"{path}/{old}")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of its newest complete run; empty if there is none.

    A path without runs is read as it is.
    """
    path = path.rstrip("/")
    runs = _runs(spark, path)
    complete = [n for n, done in runs if done]
    if complete:
        return read_or_empty(spark, f"{path}/{complete[-1]}", schema)
    return spark.createDataFrame([], schema) if runs else read_or_empty(spark, path, schema)
