"""Hard negatives by angular triangle filtering.

Vectors become integer vectors; a row's score for an anchor is their integer inner
product. Beside each row its norm and its angles to a few reference directions are stored.
The angle between a row and an anchor lies between the largest difference and the smallest
sum of their angles to any reference; the cosines of these limits times the two norms,
widened by more than their rounding error, bound the score. A pair is scored, in integers,
only if its bounds overlap a window that can still give a result:

1. positives: rows of the anchor's label from its fifth best score so far on;
2. negatives: rows of other labels within [LOW %, HIGH %] of a positive's score, and from
   the fifth best score so far of that positive on.

Whole blocks of rows that point the same way are bounded first, by the range of their
angles and norms, so a block that meets no window of an anchor is not looked at by row.
The references are directions far from each other in a sample of SAMPLE rows of lowest
hash; the sample's own scores give the first windows. Both decide how much is scored,
never the result: windows only ever exclude what cannot be among the first.

Large data: rows are stored once, ordered by nearest reference and angle. Anchors come in
groups of at most ANCHORS, a fixed share of memory; each group is broadcast and takes two
scans of the stored rows, in which a task keeps the best few rows per anchor. Only those
are shuffled, so equal vectors or one label on a third of all rows load no single task.
Finished groups are written to the shared folder.

Defined cases: rows with null id, label or vector or with a null or non-finite component
take no part, nor do those with a component whose integer does not fit 64 bits. Of rows
with the same id the one with the smallest label and vector counts. Shorter vectors count
as padded with zeros. An anchor without positives, or a positive without negatives, gives
no rows; fewer than asked give all. Scores are compared exactly and shown within 64 bits.
An empty table gives no rows. Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.centroids import with_lists
from lectern.sources.scratch import shared_folder, stored

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
REFERENCES, SAMPLE, ANCHORS, BLOCK = 8, 2_048, 2_048, 512
#: How far an angle may be off, far above the error of an arc cosine in doubles.
SLACK = 1e-6
TOP = 2**63 - 1
NONE = -(1 << 200)  # below any score


def rows_of(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Lists as rows of one width (that of the longest, or the given): cut, or padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0)) if width is None else width
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), values.dtype)
    starts = np.cumsum(lengths) - lengths
    for row, (start, length) in enumerate(zip(starts.tolist(), np.minimum(lengths, width).tolist())):
        out[row, :length] = values[start : start + length]
    return out


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def angles(vectors: np.ndarray, lengths: np.ndarray, references: np.ndarray) -> np.ndarray:
    """(rows, references): angles to unit vectors, zero for a zero vector."""
    width = references.shape[1]
    cosine = (vectors[:, :width].astype(np.float64) @ references.T[: vectors.shape[1]]) / np.maximum(lengths, 1e-300)[:, None]
    return np.where(lengths[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)


def score(vectors: np.ndarray, anchor: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products with an anchor; `top` bounds the products of norms."""
    width = min(vectors.shape[1], len(anchor))
    if top < 2.0**52:
        return (vectors[:, :width].astype(np.float64, copy=False) @ anchor[:width].astype(np.float64)).astype(np.int64)
    own = [int(x) for x in anchor[:width]]
    return np.array([sum(int(a) * b for a, b in zip(v, own)) for v in vectors[:, :width]], object)


def bounds(low: np.ndarray, high: np.ndarray, smallest, largest, own: np.ndarray, norm: float):
    """Lowest and highest score of an anchor with rows whose angles lie in [low, high]."""
    apart = np.maximum(np.maximum(low - own, own - high), 0).max(axis=1) - SLACK
    upper = np.minimum(high + own, 2 * np.pi - low - own).min(axis=1) + SLACK
    most, least = np.cos(np.clip(apart, 0, np.pi)), np.cos(np.clip(upper, 0, np.pi))
    edge = 1 + 1e-9 * largest * norm
    most = np.maximum(most * largest, most * smallest) * norm + edge
    least = np.minimum(least * largest, least * smallest) * norm - edge
    return least, most


class Best:
    """The first few rows of one window, by score and then smaller id."""

    def __init__(self, low, high, keep: int):
        self.low, self.high, self.keep = low, high, keep
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        ids, scores = np.concatenate([self.ids, ids[inside]]), np.concatenate([self.scores, scores[inside]])
        if len(ids) > 4 * self.keep:
            kth = np.partition(scores, len(scores) - self.keep)[len(scores) - self.keep]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        order = np.lexsort((ids, -scores))[: self.keep]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.keep:
            self.low = max(self.low, self.scores[-1])


class Anchors:
    """A group of anchors with their windows; `same` tells whether rows share the anchor's label."""

    def __init__(self, rows: list, references: np.ndarray, same: bool, keep: int):
        self.ids = [r["id"] for r in rows]
        self.labels = [r["label"] for r in rows]
        width = max((len(r["vec"]) for r in rows), default=0)
        self.vectors = np.zeros((len(rows), width), np.int64)
        for at, row in enumerate(rows):
            self.vectors[at, : len(row["vec"])] = row["vec"]
        self.norms = norms(self.vectors)
        self.angles = angles(self.vectors, self.norms, references)
        self.same, self.keep = same, keep
        self.windows: list[list[tuple]] = [[(NONE, -NONE)] for _ in rows]

    def scan(self, batches: Iterator[pa.RecordBatch], seeds: pa.RecordBatch | None = None):
        """Per anchor and window the best rows, and how many pairs were bounded and scored."""
        held = [[Best(low, high, self.keep) for low, high in windows] for windows in self.windows]
        counts = np.zeros(2, np.int64)
        if seeds is not None and len(seeds):
            first = [[Best(low, high, self.keep) for low, high in windows] for windows in self.windows]
            self._meet(seeds, first, counts)
            for mine, known in zip(held, first):
                for window, seed in zip(mine, known):
                    window.low = max(window.low, seed.low)
        for batch in batches:
            if len(batch):
                self._meet(batch, held, counts)
        return held, counts

    def _meet(self, batch: pa.RecordBatch, held: list[list[Best]], counts: np.ndarray) -> None:
        ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
        vectors, turned = rows_of(batch.column("vec")), rows_of(batch.column("angles"))
        lengths = batch.column("norm").to_numpy()
        if np.abs(vectors).max(initial=0) < 1 << 50:
            vectors = vectors.astype(np.float64)  # whole numbers still
        starts = np.arange(0, len(ids), BLOCK)
        low, high = np.minimum.reduceat(turned, starts), np.maximum.reduceat(turned, starts)
        small, large = np.minimum.reduceat(lengths, starts), np.maximum.reduceat(lengths, starts)
        for at in range(len(self.ids)):
            windows = [w for w in held[at] if w.low <= w.high]
            if not windows:
                continue
            own, norm = self.angles[at], self.norms[at]
            least, most = bounds(low, high, small, large, own, norm)
            leading = np.arange(len(starts)) == most.argmax()  # its scores narrow the windows for the others
            for some in (leading, ~leading):
                blocks = some & self._overlap(windows, least, most)
                rows = np.nonzero(blocks.repeat(BLOCK)[: len(ids)])[0]
                rows = rows[(labels[rows] == self.labels[at]) == self.same]
                rows = rows[ids[rows] != self.ids[at]]
                counts[0] += len(rows)
                if not len(rows):
                    continue
                alike, far = turned[rows], lengths[rows]
                rows = rows[self._overlap(windows, *bounds(alike, alike, far, far, own, norm))]
                counts[1] += len(rows)
                found = score(vectors[rows], self.vectors[at], norm * lengths[rows].max(initial=0))
                for window in windows:
                    window.add(ids[rows], found)

    @staticmethod
    def _overlap(windows: list[Best], least: np.ndarray, most: np.ndarray) -> np.ndarray:
        near = np.zeros(len(least), bool)
        for window in windows:
            near |= (most >= _real(window.low)) & (least <= _real(window.high))
        return near


def _real(value) -> float:
    """A window's limit as a double; its rounding is within the bounds' margin."""
    return float(max(min(value, 10**60), -(10**60)))


def usable(
    vectors: DataFrame, id_column: str, label_column: str, column: str, scale: int, label: Column | None = None
) -> DataFrame:
    """(id, label, vec) of the rows that take part, with vectors as floor(scale * x)."""
    vec = F.col(f"`{column}`").cast("array<double>")
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        (F.col(f"`{label_column}`") if label is None else label).cast("long").alias("label"),
        vec.alias("vec"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**62 / scale)))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vec")
            whole = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale).astype(np.int64)
            offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(whole))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), lists], ["id", "label", "vec"])

    whole = rows.mapInArrow(scaled, "id long, label long, vec array<bigint>")
    return whole.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.label", "row.vec")


def pick_references(vectors: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors of rows that point in directions far from each other."""
    length = norms(vectors)
    units = vectors[length > 0] / length[length > 0, None]
    if not len(units):
        return np.zeros((1, max(1, vectors.shape[1])))
    taken, near = [0], np.full(len(units), -2.0)
    while len(taken) < min(count, len(units)):
        near = np.maximum(near, units @ units[taken[-1]])
        taken.append(int(near.argmin()))
    return units[taken]


def directed(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """Rows with their norms and angles, ordered by nearest reference and angle to it."""
    shared = rows.sparkSession.sparkContext.broadcast(references)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = rows_of(batch.column("vec"))
            length = norms(vectors)
            turned = angles(vectors, length, shared.value)
            near = turned.argmin(axis=1)
            held = batch.append_column("norm", pa.array(length)).append_column("angles", batch.column("vec"))
            held = with_lists(held, angles=turned)
            yield held.append_column("near", pa.array(near, pa.int32())).append_column("turn", pa.array(turned.min(axis=1)))

    kinds = "id long, label long, vec array<bigint>, norm double, angles array<double>, near int, turn double"
    placed = rows.mapInArrow(turn, kinds)
    ordered = placed.repartitionByRange("near", "turn", "id").sortWithinPartitions("near", "turn")
    return ordered.drop("near", "turn")


def _found(table: DataFrame, group: Anchors, seeds) -> DataFrame:
    """(anchor, window, id, score): the best rows of each window, over all tasks."""
    shared = table.sparkSession.sparkContext.broadcast((group, seeds))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, seeds = shared.value
        held, _ = group.scan(batches, seeds)
        rows = [
            (group.ids[at], number, int(i), str(s))
            for at, windows in enumerate(held)
            for number, window in enumerate(windows)
            for i, s in zip(window.ids, window.scores)
        ]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "window", "id", "score"]
        )

    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    met = table.mapInArrow(scan, "anchor long, window int, id long, score string")
    met = met.withColumn("score", F.col("score").cast("decimal(38,0)"))
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= group.keep)


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    label_column: str = "label",
    column: str = "embedding",
    label: Column | None = None,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    references: int = REFERENCES,
    group_size: int = ANCHORS,
) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score) of every anchor.

    `anchors` is a condition on the column id; `label`, if given, replaces the label.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_column, label_column, column, scale, label), "integers")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().combine_chunks().to_batches()
    seeds, chosen = None, np.zeros((1, 1))
    if sample:
        drawn = rows_of(sample[0].column("vec"))
        chosen, length = pick_references(drawn, references), norms(drawn)
        seeds = sample[0].append_column("norm", pa.array(length)).append_column("angles", sample[0].column("vec"))
        seeds = with_lists(seeds, angles=angles(drawn, length, chosen))
    table = stored(directed(rows, chosen), "angles")
    asked = table.filter(anchors)
    groups = max(1, -(-asked.count() // (group_size * 3 // 4)))
    folder = shared_folder(spark, "anchors")
    dealt = asked.select("id", "label", "vec").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    dealt.repartition("part").write.partitionBy("part").parquet(f"{folder}/asked")
    kinds = "anchor long, positive long, rank int, negative long, positive_score long, negative_score long"
    within = lambda c: F.least(F.greatest(F.col(c), F.lit(-TOP - 1)), F.lit(TOP)).cast("long").alias(c)
    known = "id long, label long, vec array<bigint>, part int"
    for part in range(groups):
        own = spark.read.schema(known).parquet(f"{folder}/asked").filter(F.col("part") == part).collect()
        if not own:
            continue
        same = Anchors(own, chosen, True, positives)
        found = _found(table, same, seeds).orderBy("anchor", "rank").collect()
        first: dict[int, list] = {}
        for row in found:
            first.setdefault(row["anchor"], []).append((row["rank"], row["id"], int(row["score"])))
        other = Anchors([r for r in own if r["id"] in first], chosen, False, negatives)
        other.windows = [[(-(-low * s // 100), high * s // 100) for _, _, s in first[i]] for i in other.ids]
        pairs = [(i, rank - 1, p, s) for i, few in first.items() for rank, p, s in few]
        pairs = [(i, w, p, str(s)) for i, w, p, s in pairs]
        listed = spark.createDataFrame(pairs, "anchor long, window int, positive long, positive_score string")
        listed = listed.withColumn("positive_score", F.col("positive_score").cast("decimal(38,0)"))
        hard = _found(table, other, seeds).join(F.broadcast(listed), ["anchor", "window"])
        hard.select(
            "anchor", "positive", "rank", F.col("id").alias("negative"),
            within("positive_score"), within("score").alias("negative_score"),
        ).write.parquet(f"{folder}/found/group={part}")
    if not _exists(spark, f"{folder}/found"):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(f"{kinds}, group int").parquet(f"{folder}/found").drop("group")


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = mine(vectors, F.col("id") % 100 == 0, label=moved)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), "positive_score", "negative_score",
    )


ORACLE_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""
