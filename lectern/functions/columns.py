"""Column expressions shared by batch views, streams and serving queries.

ANSI mode stays on; wherever bad input must give NULL rather than an error the
`try_` form is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_time(name: str = "timestamp") -> Column:
    return F.col(name).try_cast("timestamp")


def day(name: str = "timestamp_parsed") -> Column:
    """Grouping column `date`: a 4-byte day number; `day_as_text` makes it text."""
    return F.to_date(name).alias("date")


def day_as_text(view: DataFrame) -> DataFrame:
    """`date` as yyyy-MM-dd text, formatted per result row rather than per event."""
    return view.withColumn("date", F.col("date").cast("string"))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 as decimal(5,2); NULL for a zero whole or a rate >= 1000."""
    return (F.try_divide(part, whole) * 100).try_cast("decimal(5,2)")


def hours(seconds: Column) -> Column:
    return seconds / 3600


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def side(cond: Column, aggregate: Column) -> Column:
    """`aggregate`, or NULL for a group in which no row meets `cond`.

    This is what the missing side of an outer join gives, without the join.
    """
    return F.when(count_if(cond) > 0, aggregate)


def unmatched_null(keys: list[str], label: Column) -> Column:
    """Grouping column that keeps rows of different labels apart where a key is NULL.

    An equi-join never matches NULL keys. One GROUP BY standing in for such a
    join must therefore not merge the sides inside a NULL-key group.
    """
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    return F.when(any_null, label).alias("_null_side")


def of_type(df: DataFrame, *event_types: str) -> DataFrame:
    return df.where(F.col("event_type").isin(*event_types))


def as_ntz(df: DataFrame) -> DataFrame:
    """Zone-free timestamps, for comparing with engines that have no session zone."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
