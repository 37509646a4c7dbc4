"""What lies at a path: tables that may be missing, and data files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lectern.schemas import ddl


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, base: str | None = None
) -> DataFrame:
    """Parquet at `path`, or an empty frame where nothing has been written yet.

    Only a missing path counts as empty; every other failure is raised.
    """
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and modification time of the data files under `root`.

    A listing: the file contents are never opened.
    """
    columns = ["path", "modificationTime", "length"]
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = ddl("path STRING, modificationTime TIMESTAMP, length BIGINT")
        return spark.createDataFrame([], schema)
    return files.select(*columns)
