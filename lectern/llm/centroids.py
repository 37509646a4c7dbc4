"""Centroid clustering with a table of distances to pivots (LAESA).

Vectors become integer vectors. The distances from each vector to a few fixed pivots are
worked out once and stored beside it. By the triangle inequality a vector and a centroid
are at least as far apart as their distances to any pivot differ, so each round bounds
every centroid from below by the largest of these differences, measures the centroid with
the least bound, and measures exactly, in integers, only those whose bound does not exceed
that distance. The bound is lowered by more than its rounding error, so centroids at equal
distances are always measured and the smaller number wins.

A pivot is a vector far from the pivots before it, taken from a sample of PIVOT_ROWS
vectors of lowest hash. Pivots decide how much is measured, never the result.

Large data: a round is one scan of the stored table; a task sends on a sum per cluster and
component. The driver holds the centroids and their sums: clusters times components. No
vector is shuffled, so a vector that many rows share puts no load on one task.

Defined cases: vectors that are null, of another length, or with a null or non-finite
component are left out, and so are those with a component whose integer does not fit 64
bits. Repeated rows and repeated or null ids are rows of their own; starts come by the
hash of the id, then by the vector, rows without an id last. Fewer rows than clusters:
every row is a start. Distances and sums are exact beyond 64 bits and shown as at most
2^63 - 1. An empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.scratch import stored

CLUSTERS, ROUNDS, SCALE, DIMENSION = 16, 3, 64, 64
PIVOTS, PIVOT_ROWS = 8, 1_024
#: Below this size of components all products and sums below are exact in doubles.
SMALL = 1 << 20
TOP = 2**63 - 1


def matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of one integer matrix to each of another."""
    if max(np.abs(left).max(initial=0), np.abs(right).max(initial=0)) >= SMALL:
        left, right = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (left, right))
        return np.stack([((left - row) ** 2).sum(axis=1) for row in right], axis=1)
    left, right = left.astype(np.float64), right.astype(np.float64)
    return (left**2).sum(1)[:, None] - 2 * (left @ right.T) + (right**2).sum(1)[None, :]


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows at the same place."""
    if max(np.abs(left).max(initial=0), np.abs(right).max(initial=0)) >= SMALL:
        return np.array([sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for x, y in zip(left, right)], object)
    return ((left - right) ** 2).sum(axis=1)


def roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Centroids:
    """Centroids of a round with their distances to the pivots."""

    def __init__(self, centroids: list[list[int]], pivots: np.ndarray):
        self.exact = centroids
        self.rows = np.array(centroids, np.int64).reshape(len(centroids), pivots.shape[1])
        self.to_pivots = roots(distances(self.rows, pivots))

    def assign(self, vectors: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of each vector's nearest centroid, and how many were measured."""
        bound = np.zeros((len(vectors), len(self.rows)))
        for pivot in range(to_pivots.shape[1]):
            mine, theirs = to_pivots[:, pivot, None], self.to_pivots[None, :, pivot]
            np.maximum(bound, np.abs(mine - theirs) - 1e-12 * (mine + theirs), out=bound)
        number = bound.argmin(axis=1)
        best = paired(vectors, self.rows[number])
        measured = len(vectors)
        reach = roots(best) * (1 + 1e-12)
        for k in range(len(self.rows)):
            left = np.nonzero((bound[:, k] <= reach) & (number != k))[0]
            measured += len(left)
            found = paired(vectors[left], self.rows[None, k].repeat(len(left), 0))
            nearer = (found < best[left]) | ((found == best[left]) & (k < number[left]))
            number[left[nearer]], best[left[nearer]] = k, found[nearer]
        return number, best, measured


def pick_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: the first, then each time the one farthest from all taken."""
    if not len(sample):
        return sample
    taken, near = [0], None
    while len(taken) < min(count, len(sample)):
        own = distances(sample, sample[taken[-1:]])[:, 0]
        near = own if near is None else np.minimum(near, own)
        if not near.max():
            break
        taken.append(int(near.argmax()))
    return sample[taken]


def integer_vectors(vectors: DataFrame, id_column: str, column: str, scale: int, dimension: int) -> DataFrame:
    """(id, vec) of the rows that take part, as floor(scale * x)."""
    vec = F.col(f"`{column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), vec.alias("vec")).filter(F.size("vec") == dimension)
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**62 / scale)))
    kind = rows.schema["id"].dataType.simpleString()

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.floor(matrix(batch.column("vec")) * scale).astype(np.int64)
            yield with_lists(batch, vec=whole)

    return rows.mapInArrow(scaled, f"id {kind}, vec array<bigint>")


def with_lists(batch: pa.RecordBatch, **matrices: np.ndarray) -> pa.RecordBatch:
    """`batch` with columns of lists set to the rows of matrices."""
    columns = {name: batch.column(name) for name in batch.schema.names}
    for name, rows in matrices.items():
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
        columns[name] = pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    kind = rows.schema["id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield with_lists(batch, to_pivots=roots(distances(matrix(batch.column("vec")), shared.value)))

    return rows.mapInArrow(measure, f"id {kind}, vec array<bigint>, to_pivots array<double>")


def _sums(table: DataFrame, centroids: Centroids) -> dict[int, tuple[int, list[int]]]:
    """Per cluster that has rows: how many, and the exact sum of each component."""
    shared = table.sparkSession.sparkContext.broadcast(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            if not len(batch):
                continue
            vectors = matrix(batch.column("vec"))
            number, _, _ = shared.value.assign(vectors, matrix(batch.column("to_pivots")))
            small = np.abs(vectors).max() < SMALL
            for k in np.unique(number).tolist():
                own = vectors[number == k]
                total = own.sum(axis=0).tolist() if small else [sum(map(int, c)) for c in own.T]
                counts[k] = counts.get(k, 0) + len(own)
                sums[k] = [a + b for a, b in zip(sums[k], total)] if k in sums else total
        rows = [(k, i, counts[k], Decimal(x)) for k, total in sums.items() for i, x in enumerate(total)]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["k", "place", "rows", "total"]
        )

    parts = table.select("vec", "to_pivots").mapInArrow(add, "k int, place int, rows bigint, total decimal(38,0)")
    found = parts.groupBy("k", "place").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    out: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(found.collect(), key=lambda r: (r["k"], r["place"])):
        out.setdefault(row["k"], (row["rows"], []))[1].append(int(row["total"]))
    return out


def _assigned(table: DataFrame, centroids: Centroids) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(centroids)
    kind = table.schema["id"].dataType.simpleString()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                number, best, _ = shared.value.assign(matrix(batch.column("vec")), matrix(batch.column("to_pivots")))
                best = np.minimum(best, TOP).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(number, pa.int32()), pa.array(best, pa.int64())],
                    ["id", "cluster", "distance"],
                )

    return table.mapInArrow(nearest, f"id {kind}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    id_column: str = "vec_id",
    column: str = "embedding",
    scale: int = SCALE,
    dimension: int = DIMENSION,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of every vector, the centroids they were last assigned to)."""
    rows = stored(integer_vectors(vectors, id_column, column, scale, dimension), "integers")
    hashed = lambda mark: F.sha2(F.concat(F.lit(f"{mark}:"), F.col("id").cast("string")), 256)
    starts = rows.orderBy(hashed(1).asc_nulls_last(), "vec").limit(clusters).collect()
    sample = rows.orderBy(hashed(2).asc_nulls_last(), "vec").limit(PIVOT_ROWS).collect()
    chosen = pick_pivots(np.array([r["vec"] for r in sample], np.int64).reshape(-1, dimension), pivots)
    table = stored(_with_pivots(rows, chosen), "pivots")
    now = Centroids([r["vec"] for r in starts], chosen)
    for _ in range(rounds):
        found = _sums(table, now)
        moved = [[x // found[k][0] for x in found[k][1]] if k in found else old for k, old in enumerate(now.exact)]
        now = Centroids(moved, chosen)
    return _assigned(table, now), now.exact


def report(spark: SparkSession, assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Every row with its cluster's and the whole inertia and the digest of its centroid."""
    assigned = stored(assigned, "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    inertia = {r["cluster"]: int(r["inertia"]) for r in assigned.groupBy("cluster").agg(exact).collect()}
    whole = min(sum(inertia.values()), TOP)
    known = [
        (k, min(own, TOP), whole, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
        for k, own in sorted(inertia.items())
    ]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return assigned.join(F.broadcast(spark.createDataFrame(known, kinds)), "cluster")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows = report(spark, *cluster(vectors))
    return rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql(clusters: int, rounds: int, scale: int, dimension: int) -> str:
    """Full distances to every centroid, round by round."""
    steps = [
        f"""kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dimension}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimension})""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS k, v
  FROM kept QUALIFY k < {clusters})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
  SELECT rid, vec_id, k, d FROM (
    SELECT rid, vec_id, k,
           CAST(list_sum(list_transform(range(1, {dimension + 1}), lambda i: (kept.v[i] - c{i}.v[i]) * (kept.v[i] - c{i}.v[i]))) AS BIGINT) AS d
    FROM kept, c{i})
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS (
  SELECT c{i}.k, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM (
      SELECT k, place, sum(x) AS s, count(*) AS n FROM (
        SELECT a{i}.k, unnest(range(1, {dimension + 1})) AS place, unnest(kept.v) AS x
        FROM a{i} JOIN kept USING (rid)) GROUP BY k, place) GROUP BY k) m ON m.k = c{i}.k)""")
    last = rounds
    return "WITH " + ",\n".join(steps) + f"""
SELECT a{last}.vec_id, CAST(a{last}.k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a{last}.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON a{last}.k = c{last}.k"""


ORACLE_SQL = _sql(CLUSTERS, ROUNDS, SCALE, DIMENSION)
