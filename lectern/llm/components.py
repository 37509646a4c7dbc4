"""Connected components of a link table, by alternating star contraction.

Each round hangs every node's larger neighbours on the node's smallest neighbour, then
does the same with its smaller neighbours. The number of links never grows, and chains
shorten by a constant factor; the rounds end when nothing changes. Each round's links
are written to the shared folder, so a lost executor costs one round's tasks at most,
and to as many files as their number calls for.
Smallest neighbours are combined before the shuffle, and a node with a great many links
is a skewed join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.sources.scratch import stored

MAX_ROUNDS = 100


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
    if large:
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(near, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = both.filter("v < u")
        near = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = down.join(near, "u")
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.toDF("u", "v"))
    return moved.filter("u > v").distinct()


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """(node, component) for every node of `links` (u, v); component is the smallest node.

    Links of a node to itself and links with a null end count for nothing. `most` is about
    the number that the links do not exceed, if known; files are sized by it.
    """
    now = stored(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
        most,
    )
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        now = stored(_star(_star(now, large=True), large=False), "links", mark[0])
        before, mark = mark, _mark(now)
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
    raise RuntimeError("components did not settle")


def _mark(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(links.agg(F.count(F.lit(1)), total).first())
