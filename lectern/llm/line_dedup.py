"""Line dedup with a sharded minimal perfect hash.

A line's key is the line without white space at both ends, with A-Z lower-cased. Keys
found in at least `min_docs` documents lose all their lines in every document.

Distinct line hashes that more than one document has are dealt to shards. For each
shard a minimal perfect hash (levels of bits: a key takes the place that no other key
of its level wants, the rest go on to the next level) numbers the hashes without
storing them, and two compact arrays, indexed by that number, hold fingerprints and
document counts. Documents probe the arrays; a hash that the index does not hold meets
a foreign fingerprint. Hash and fingerprint are 64 bits each.

Large data: a document's keys are made distinct before they are counted and counts are
combined before the shuffle, so a line that all documents share is one row per task.
What is shuffled is hashes, never lines, and texts stay where they are. The arrays take
about 12.5 bytes per key of several documents. They are broadcast while that is within
`broadcast_bytes`; beyond it the frequent hashes are joined to the hashes of distinct
texts by a shuffle, with the same result.

Defined cases: null or empty text is one empty line; empty keys are never dropped, unless
`min_chars` is 0; repeated rows are documents of their own; an empty table stays empty;
added columns (n_lines, n_dropped, kept) replace columns of the same names.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.url_filter import LOWER, UPPER
from lectern.sources.scratch import stored

SPACE = " \t\n\x0b\x0c\r"
MIN_DOCS, MIN_CHARS = 10, 1
SHARD_KEYS = 500_000
BROADCAST_BYTES = 128 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + _GOLD * np.uint64(salt + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers n distinct 64-bit keys from 0 to n-1; other keys get any number or -1."""

    def __init__(self, keys: np.ndarray, room: float = 2.0):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        rest = keys
        taken = 0
        while len(rest):
            if len(self.levels) == 200:
                raise ValueError("keys are not distinct")
            size = -(-max(64, int(room * len(rest))) // 64) * 64
            place = (_mixed(rest, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.levels.append((size, words, (taken + np.cumsum(ones) - ones).astype(np.int64)))
            taken += int(ones.sum())
            rest = rest[~alone[place]]

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        live = np.arange(len(keys))
        for depth, (size, words, before) in enumerate(self.levels):
            place = _mixed(keys[live], depth) % np.uint64(size)
            at, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            word = words[at]
            here = (word >> bit & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            found[live[here]] = (before[at] + np.bitwise_count(below))[here]
            live = live[~here]
        return found


class Shard:
    """Fingerprints and document counts, indexed by the perfect hash of the line hashes."""

    def __init__(self, hashes: np.ndarray, prints: np.ndarray, counts: np.ndarray):
        for self.salt in range(8):  # two keys that one mixture cannot tell apart
            keys = self._keys(hashes, prints)
            if len(np.unique(keys)) == len(keys):
                break
        self.index = PerfectHash(keys)
        number = self.index.numbers(keys)
        self.prints = np.zeros(len(keys), np.uint64)
        self.prints[number] = prints.view(np.uint64)
        self.counts = np.zeros(len(keys), np.uint32)
        self.counts[number] = np.minimum(counts, 0xFFFFFFFF)

    def _keys(self, hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return hashes.view(np.uint64) ^ (prints.view(np.uint64) * np.uint64(2 * self.salt + 1) * _GOLD)

    def documents(self, hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """In how many documents each line is; 0 for lines that the shard does not hold."""
        number = self.index.numbers(self._keys(hashes, prints))
        own = (number >= 0) & (self.prints[number] == prints.view(np.uint64))
        return np.where(own, self.counts[number], 0)


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(hash, print, docs) of the keys that several documents have."""
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), key_of))
    return (
        docs.select(F.explode(keys).alias("key"))
        .filter(F.length("key") >= min_chars)
        .groupBy(F.xxhash64("key").alias("hash"), F.xxhash64("key", F.lit(1)).alias("print"))
        .agg(F.count(F.lit(1)).alias("docs"))
    )


def build_index(counts: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The index as rows (shard, content), and the number of shards."""
    shards = max(1, -(-counts.count() // shard_keys))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = [np.ascontiguousarray(pdf[c].to_numpy(np.int64)) for c in ("hash", "print", "docs")]
        return pd.DataFrame({"shard": pdf["shard"][:1], "content": [pickle.dumps(Shard(*columns), 5)]})

    dealt = counts.withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("shard").applyInPandas(build, "shard int, content binary"), "lines"), shards


def dedup_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    shard_keys: int = SHARD_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows and columns of `docs` (doc_id, text), with n_lines, n_dropped and kept."""
    if min_docs < 1:
        raise ValueError("min_docs is 1 at least")
    if min_docs > 0xFFFFFFFF:
        raise ValueError("documents are counted in 32 bits")
    kept = docs.drop("n_lines", "n_dropped", "kept")
    counts = stored(line_counts(docs, min_chars).filter(F.col("docs") >= min(2, min_docs)), "counts")
    index, shards = build_index(counts, shard_keys)
    size = index.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    lined = kept.withColumn("_lines", lines_of(F.col("text")))
    if size <= broadcast_bytes:
        marked = lined.withColumn("_drop", _probe(index, shards, min_docs)(
            F.transform("_lines", lambda x: F.xxhash64(key_of(x))),
            F.transform("_lines", lambda x: F.xxhash64(key_of(x), F.lit(1))),
        ))
    else:
        marked = _joined(lined, counts.filter(F.col("docs") >= min_docs))
    stay = F.filter("_lines", lambda _, i: ~F.get("_drop", i))
    return (
        marked.withColumn("_stay", stay)
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dropped", (F.size("_lines") - F.size("_stay")).cast("long"))
        .withColumn("kept", F.array_join("_stay", "\n"))
        .select(*[f"`{c}`" for c in kept.columns], "n_lines", "n_dropped", "kept")
    )


def _probe(index: DataFrame, shards: int, min_docs: int):
    """A function that says for each line of a document whether it goes."""
    held = index.sparkSession.sparkContext.broadcast(
        {row["shard"]: pickle.loads(row["content"]) for row in index.toLocalIterator()}
    )

    @F.pandas_udf("array<boolean>")
    def probe(hashes: pd.Series, prints: pd.Series) -> pd.Series:
        sizes = hashes.map(len).to_numpy() if len(hashes) else np.zeros(0, int)
        flat = [np.concatenate([*s.to_numpy(), np.zeros(0, np.int64)]).astype(np.int64) for s in (hashes, prints)]
        shard = np.mod(flat[0], shards)
        order = np.argsort(shard, kind="stable")
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        drop = np.zeros(len(shard), bool)
        for number, content in held.value.items():
            rows = order[ends[number] : ends[number + 1]]
            drop[rows] = content.documents(flat[0][rows], flat[1][rows]) >= min_docs
        return pd.Series(np.split(drop, np.cumsum(sizes)[:-1]) if len(sizes) else [], dtype=object)

    return probe


def _joined(lined: DataFrame, frequent: DataFrame) -> DataFrame:
    """The same marks by a shuffle: what goes from a text depends on the text alone."""
    name = [F.xxhash64("text").alias("_a"), F.xxhash64("text", F.lit(1)).alias("_b")]
    named = lined.select("*", *name)
    lines = (
        named.select("_a", "_b", "_lines")
        .select("_a", "_b", F.posexplode("_lines").alias("at", "line"))
        .select(
            "_a", "_b", "at",
            F.xxhash64(key_of(F.col("line"))).alias("hash"),
            F.xxhash64(key_of(F.col("line")), F.lit(1)).alias("print"),
        )
    )
    gone = (
        lines.join(frequent.select("hash", "print"), ["hash", "print"], "left_semi")
        .groupBy("_a", "_b")
        .agg(F.collect_set("at").alias("_gone"))
    )
    empty = F.array().cast("array<int>")
    places = F.map_from_entries(
        F.transform(F.coalesce("_gone", empty), lambda i: F.struct(i, F.lit(True)))
    )
    marks = F.transform("_lines", lambda _, i: F.coalesce(F.element_at("_places", i), F.lit(False)))
    return (
        named.join(gone, ["_a", "_b"], "left").withColumn("_places", places).withColumn("_drop", marks)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE_SQL = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{LOWER}') AS key
  FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
