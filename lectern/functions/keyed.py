"""Key-wise helpers that stay whole when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the largest `order`.

    An aggregate rather than `row_number()`: it combines on the map side, so a
    hot key reaches the reducer as one row per map task, not as all its rows.
    The other columns break ties, which makes the result deterministic.
    """
    return _pick(df, keys, order, F.max)


def oldest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the smallest `order`."""
    return _pick(df, keys, order, F.min)


def _pick(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_best"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to a side that has one row per key, tolerating hot keys on the left.

    Spark's adaptive skew handling splits an oversized partition of a sort-merge
    join only when both inputs come straight from a shuffle. An aggregated right
    side is already partitioned by `keys` and would skip its shuffle, so the join
    also carries a hash of the keys: that makes both sides shuffle on the same
    expressions, and a hot left partition is then split while only its few right
    rows are repeated. A right side that turns out small is broadcast by AQE,
    which knows its measured size.
    """
    route = F.xxhash64(*[F.col(k) for k in keys])
    return left.withColumn("_route", route).join(
        right.withColumn("_route", route), [*keys, "_route"], how
    ).drop("_route")


# Statistics of every (left time, right time) pair of a key follow from per-side
# aggregates, so no pair is ever built: with n rows and sum S on each side,
#   sum(right - left) = n_left * S_right - n_right * S_left
#   min(right - left) = min_right - max_left,  max likewise.
# Sums are decimals: seconds since 1970 times a hot key's row count leaves 64 bits.


def pair_stats(prefix: str, time: str) -> list[Column]:
    """Per-side aggregates; `prefix` is "l" or "r"."""
    seconds = F.unix_timestamp(time)
    return [
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.count(seconds).alias(f"{prefix}_timed"),
        F.sum(seconds.cast("decimal(12,0)")).alias(f"{prefix}_sum"),
        F.min(seconds).alias(f"{prefix}_min"),
        F.max(seconds).alias(f"{prefix}_max"),
    ]


def _times(count: str, total: str) -> Column:
    return F.col(count).cast("decimal(16,0)") * F.col(total)


def pair_count() -> Column:
    return F.sum(F.col("l_rows") * F.col("r_rows"))


def pair_timed() -> Column:
    return F.sum(F.col("l_timed") * F.col("r_timed"))


def pair_seconds() -> Column:
    return F.sum(_times("l_timed", "r_sum") - _times("r_timed", "l_sum"))


def pair_min() -> Column:
    return F.min(F.col("r_min") - F.col("l_max"))


def pair_max() -> Column:
    return F.max(F.col("r_max") - F.col("l_min"))
