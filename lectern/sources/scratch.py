"""Folders that the driver and all executors share, for what is written and read again."""

from __future__ import annotations

import tempfile
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession

#: Rows of a few numbers for which a file is worth while.
ROWS = 100_000


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's `spark.checkpoint.dir`, removed when the session ends.

    A local session without that setting gets a temporary folder. On a cluster each
    machine would write to a disk of its own there, so the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lectern-")
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def stored(df: DataFrame, purpose: str, most: int | None = None) -> DataFrame:
    """The same rows, written to a shared folder and read again: a cut in the lineage.

    `most`, for small rows that come from a shuffle, is about the number that they do not
    exceed. A few of them go to a few files, however many shuffle partitions there are:
    Hadoop starts processes for each file that it writes to a local disk.
    """
    if most is not None:
        df = df.coalesce(max(1, ceil(most / ROWS)))
    path = f"{shared_folder(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
