"""Refresh the serving tables from the stored batch views.

    python -m lectern.plans.refresh VIEW_ROOT SPEED_ROOT TABLE_ROOT
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import serving
from lectern.schemas import SERVING_KEYS
from lectern.session import session
from lectern.sources import versions
from lectern.sources.keyed import (
    conform,
    conform_batch,
    read_keyed,
    write_enrollment_tables,
    write_lookup,
)
from lectern.sources.views import read_view

COPIED = (
    "course_overview",
    "student_overview",
    "student_course_detailed",
    "auth_daily_active_users",
)


def refresh_tables(
    spark: SparkSession, view_root: str, table_root: str, as_of: serving.AsOf
) -> None:
    """Replace the batch-fed serving tables, each laid out by its key."""
    now = serving.moment(as_of)
    for name in COPIED:
        table = conform_batch(read_view(spark, view_root, name), name, now)
        write_lookup(table, f"{table_root.rstrip('/')}/{name}", SERVING_KEYS[name])
    write_enrollment_tables(read_view(spark, view_root, "student_course_enrollment"), table_root)


def system_summary(
    spark: SparkSession, view_root: str, speed_root: str, as_of: serving.AsOf
) -> DataFrame:
    """The dashboard row, from stored batch views and keyed speed tables."""
    keyed = f"{speed_root.rstrip('/')}/keyed"
    row = serving.system_summary(
        read_keyed(spark, f"{keyed}/active_users", "active_users"),
        read_keyed(spark, f"{keyed}/course_popularity", "course_popularity"),
        read_view(spark, view_root, "student_overview"),
        read_view(spark, view_root, "course_overview"),
        as_of,
    )
    return conform(row, "system_summary")


def main(arguments: list[str]) -> int:
    if len(arguments) != 3:
        print(__doc__)
        return 2
    view_root, speed_root, table_root = arguments
    spark = session("lectern serving tables")
    now = F.current_timestamp()
    refresh_tables(spark, view_root, table_root, now)
    summary = system_summary(spark, view_root, speed_root, now)
    versions.replace(spark, f"{table_root.rstrip('/')}/system_summary", summary.write.parquet)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
