"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are made unit vectors (if their norms differ, by one more coordinate that keeps
the order of inner products), turned by pseudo-rotations (random signs and Hadamard
transforms), and put in the bucket of the nearest signed axis, in several tables. A
query probes in each table the buckets of the axes nearest to it; what it meets there is
ranked by the inner product of the original vectors in double precision. Large tables
use two rotations per table and pairs of axes as buckets.

How many buckets are probed is measured: for SAMPLE queries the true neighbours are found
by a full scan, and the fewest probes that reach the wanted recall on them are taken. A
query that meets fewer than k rows probes every bucket of one table, which is exact.

Large data: equal vectors are one node with its smallest k + 1 ids, which is all a result
can use, so a vector that a third of all rows share is one row. Queries with equal
vectors are searched once. A bucket's nodes and queries are dealt to chunks of bounded
size and each pair of chunks is one group, so no group grows with the data; within it,
scores are products of blocks of fixed size. Each task keeps its best k + 1 nodes per
query before results are shuffled.

Defined cases: null, empty and zero vectors, vectors with null or non-finite components,
vectors of another length than most, and rows with null id take no part; repeated ids
are kept; fewer candidates than k give all; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.sources.scratch import stored

K, RECALL, SAMPLE = 20, 0.96, 200
TABLES, BUCKET_ROWS, CHUNK = 4, 50_000, 10_000
BLOCK = 256
SEED = 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of rows whose length is a power of two."""
    rows, n = x.shape
    step = 1
    while step < n:
        x = x.reshape(rows, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(rows, n) / np.sqrt(n)


class Polytopes:
    """Bucket numbers and probe orders of unit vectors in each table."""

    def __init__(self, dimension: int, top_norm: float, level: bool, tables: int, parts: int):
        self.dimension, self.top_norm, self.level = dimension, top_norm, level
        self.tables, self.parts = tables, parts
        self.width = 1 << max(0, (dimension + (not level) - 1)).bit_length()
        signs = np.random.default_rng(SEED).integers(0, 2, (tables, parts, 3, self.width))
        self.signs = 2.0 * signs - 1

    @property
    def buckets(self) -> int:
        return (2 * self.width) ** self.parts

    def _unit(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        if query or self.level:
            out[:, : self.dimension] = x / np.linalg.norm(x, axis=1, keepdims=True)
        else:
            scaled = x / self.top_norm
            out[:, : self.dimension] = scaled
            out[:, self.dimension] = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1)))
        return out

    def scores(self, x: np.ndarray, table: int, query: bool) -> np.ndarray:
        """How near each vector is to each bucket's axes."""
        unit = self._unit(x, query)
        total = np.zeros((len(x), 1))
        for part in range(self.parts):
            turned = unit
            for sign in self.signs[table, part]:
                turned = hadamard(turned * sign)
            near = np.concatenate([turned, -turned], axis=1)
            total = (total[:, :, None] + near[:, None, :]).reshape(len(x), -1)
        return total

    def bucket(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each vector."""
        return np.stack([self.scores(x, t, False).argmax(1) for t in range(self.tables)], axis=1)

    def probes(self, x: np.ndarray, table: int, count: int) -> np.ndarray:
        """(rows, count): the nearest buckets, nearest first."""
        score = self.scores(x, table, True)
        count = min(count, self.buckets)
        some = np.argpartition(-score, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(score, some, 1), axis=1, kind="stable")
        return np.take_along_axis(some, order, 1)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _products(queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed alike wherever they are worked out."""
    return np.multiply(queries, nodes).sum(axis=1)


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, vec) of the rows that take part, with vectors as doubles."""
    vec = F.col(f"`{column}`").cast("array<double>")
    finite = F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = (
        vectors.select(F.col(f"`{id_column}`").alias("id"), vec.alias("vec"))
        .filter("id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
        .filter(finite & F.exists("vec", lambda x: x != 0))
    )
    most = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (most["n"] if most else 0))


def _nodes(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids."""
    first = Window.partitionBy("vec").orderBy("id")
    return (
        rows.withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= k + 1)
        .groupBy("vec")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("node", F.col("ids")[0])
    )


def _best(queries: np.ndarray, names: np.ndarray, nodes: np.ndarray, ids: np.ndarray, keep: int):
    """(query, node place, score) of each query's best nodes."""
    keep = min(keep, len(ids))
    order = np.argsort(ids, kind="stable")
    nodes, ids = nodes[order], ids[order]
    for start in range(0, len(queries), BLOCK):
        block = queries[start : start + BLOCK]
        score = block @ nodes.T
        some = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
        # Nodes as good as the last kept one, to rounding, may have a smaller id.
        edge = np.take_along_axis(score, some, 1).min(1, keepdims=True)
        row, place = np.nonzero(score >= edge - 1e-12 * (1 + np.abs(edge)))
        exact = _products(block[row], nodes[place])
        rank = np.lexsort((ids[place], -exact, row))
        row, place, exact = row[rank], place[rank], exact[rank]
        within = np.arange(len(row)) - np.searchsorted(row, row)
        row, place, exact = (v[within < keep] for v in (row, place, exact))
        yield names[start : start + BLOCK][row], order[place], exact


def _measure(nodes: DataFrame, queries: DataFrame, hasher: Polytopes, k: int, wanted: float) -> int:
    """The fewest probes per table that find the wanted share of true neighbours."""
    picked = queries.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).toPandas()
    if not len(picked):
        return 1
    names, sample = picked["node"].to_numpy(), _matrix(picked["vec"])
    shared = nodes.sparkSession.sparkContext.broadcast((names, sample))

    def scan(batches):
        names, sample = shared.value
        for batch in batches:
            if len(batch):
                vectors = _matrix(batch["vec"])
                for query, place, score in _best(sample, names, vectors, batch["node"].to_numpy(), k + 1):
                    yield pd.DataFrame({
                        "query": query, "node": batch["node"].to_numpy()[place], "score": score,
                        "vec": batch["vec"].to_numpy()[place],
                    })

    found = nodes.select("node", "vec").mapInPandas(scan, "query long, node long, score double, vec array<double>")
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    true = found.filter("query <> node").withColumn("n", F.row_number().over(rank)).filter(F.col("n") <= k).toPandas()
    if not len(true):
        return 1
    own = pd.Series(np.arange(len(names)), index=names)[true["query"]].to_numpy()
    held = hasher.bucket(_matrix(true["vec"]))
    need = np.full(len(true), hasher.buckets)
    for table in range(hasher.tables):
        score = hasher.scores(sample, table, True)
        mine = score[own, held[:, table]]
        place = np.array([(score[q] > s).sum() + 1 for q, s in zip(own, mine)])
        need = np.minimum(need, place)
    return int(np.quantile(need, wanted, method="higher"))


def _search(nodes: DataFrame, queries: DataFrame, hasher: Polytopes, probes: int, k: int, chunk: int) -> DataFrame:
    """(query, node, score): the best k + 1 nodes each query meets."""
    shared = nodes.sparkSession.sparkContext.broadcast(hasher)

    def places(batches):
        for batch in batches:
            if len(batch):
                held = shared.value.bucket(_matrix(batch["vec"]))
                yield pd.concat([batch.assign(table=t, bucket=held[:, t]) for t in range(held.shape[1])])

    def probed(batches):
        for batch in batches:
            if len(batch):
                vectors = _matrix(batch["vec"])
                for table in range(shared.value.tables):
                    near = shared.value.probes(vectors, table, probes)
                    at = np.repeat(np.arange(len(batch)), near.shape[1])
                    yield batch.iloc[at].assign(table=table, bucket=near.reshape(-1))

    put = "node long, vec array<double>, table int, bucket long"
    base = nodes.select("node", "vec").mapInPandas(places, put)
    asked = queries.select("node", "vec").mapInPandas(probed, put)
    where = ["table", "bucket"]
    parts = lambda df, name: df.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias(name))
    cuts = stored(parts(base, "left_parts").join(parts(asked, "right_parts"), where), "buckets")

    def dealt(df: DataFrame, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
        return (
            df.join(cuts, where)
            .withColumn(own, F.pmod(F.xxhash64("node"), F.col(own_parts)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)))
            .select(*where, "left", "right", "node", "vec")
        )

    group = [*where, "left", "right"]
    left = dealt(base, "left", "left_parts", "right", "right_parts")
    right = dealt(asked, "right", "right_parts", "left", "left_parts")

    def rank(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(queries):
            return pd.DataFrame({"query": [], "node": [], "score": []}).astype({"query": int, "node": int})
        ids = nodes["node"].to_numpy()
        parts = list(_best(_matrix(queries["vec"]), queries["node"].to_numpy(), _matrix(nodes["vec"]), ids, k + 1))
        query, place, score = (np.concatenate(p) for p in zip(*parts))
        return pd.DataFrame({"query": query, "node": ids[place], "score": score})

    met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(
        rank, "query long, node long, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    return (
        met.withColumn("n", F.dense_rank().over(best))
        .filter(F.col("n") <= k + 1)
        .select("query", "node", "score")
        .distinct()
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_column: str = "vec_id",
    column: str = "embedding",
    tables: int = TABLES,
    recall: float = RECALL,
    chunk: int = CHUNK,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): per row of `queries` its k nearest rows of `vectors`.

    `queries` are rows of `vectors`; a row is not its own neighbour.
    """
    rows = stored(usable(vectors, id_column, column), "vectors")
    nodes = stored(_nodes(rows, k), "vectors")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    size = nodes.agg(
        F.count(F.lit(1)).alias("n"), F.max(norm).alias("top"), F.min(norm).alias("low"),
        F.max(F.size("vec")).alias("dimension"),
    ).first()
    asked = stored(
        usable(queries, id_column, column).join(nodes.select("vec", "node"), "vec").select("id", "node"), "queries"
    )
    groups = stored(
        asked.select("node").distinct().join(nodes.select("node", "vec"), "node"), "queries"
    )
    level = not size["n"] or size["top"] <= size["low"] * (1 + 1e-6)
    hasher = Polytopes(size["dimension"] or 1, size["top"] or 1.0, level, tables, 1)
    if size["n"] > bucket_rows * hasher.buckets:
        hasher = Polytopes(size["dimension"], size["top"], level, tables, 2)
    probes = _measure(nodes, groups, hasher, k, recall)
    met = stored(_search(nodes, groups, hasher, probes, k, chunk), "met")

    def listed(met: DataFrame) -> DataFrame:
        """Per query node its nearest k + 1 ids, as an array."""
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        each = met.join(nodes.select("node", "ids"), "node").select(
            "query", "score", F.explode("ids").alias("id")
        )
        few = each.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
        return few.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("near"))

    found = stored(listed(met), "near")
    full = min(k + 1, rows.count())
    short = groups.join(found.filter(F.size("near") >= full), F.col("node") == F.col("query"), "left_anti")
    if short.limit(1).count():
        one = Polytopes(hasher.dimension, hasher.top_norm, level, 1, 1)
        rest = listed(stored(_search(nodes, short, one, one.buckets, k, chunk), "met"))
        found = found.filter(F.size("near") >= full).union(rest)
    own = F.transform(F.filter("near", lambda x: x["id"] != F.col("id")), lambda x: x)
    return (
        asked.join(found, asked["node"] == found["query"])
        .select(F.col("id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), "x.score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))
