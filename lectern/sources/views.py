"""Stored batch views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lectern.plans.registry import VIEWS, build_view, sort_columns, view_path
from lectern.schemas import EVENT
from lectern.sources import versions
from lectern.sources.typed import typed_schema


def write_view(view: DataFrame, root: str, name: str) -> None:
    """Replace the stored view, once it is written whole."""
    writer = view.write.option("compression", "snappy")
    versions.replace(view.sparkSession, view_path(root, name), writer.parquet)


def view_schema(spark: SparkSession, name: str) -> T.StructType:
    """The view's output schema, taken from its plan over empty topics."""
    empty = {t: spark.createDataFrame([], typed_schema(t)) for t in EVENT}
    return build_view(name, empty.__getitem__, ordered=False).schema


def read_view(spark: SparkSession, root: str, name: str, ordered: bool = False) -> DataFrame:
    """A stored view, in the view's order on request; empty if it was never written."""
    stored = versions.read(spark, view_path(root, name), view_schema(spark, name))
    order = VIEWS[name].order
    return stored.orderBy(*sort_columns(order)) if ordered and order else stored
