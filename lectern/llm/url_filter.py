"""URL rules judged by Bloom filter cascades.

A rule is a host and the beginning of a path; it fits its host and all subdomains. A
url's keys are its host's suffixes joined with the beginnings of its path, in those
lengths alone that rules have, the longest first. Two cascades, of the allowed and of
the blocked rules, tell for every key whether it is listed.

Level 0 of a cascade holds the listed keys; level 1 those keys of the whole corpus
that level 0 takes for listed and are not; level 2 the listed keys that level 1 takes
for those, and so on until a level takes no key wrongly. As the levels are built over
all keys of the judged urls, every answer for them is exact, and judging needs no join.

Large data: level 0 is sized by the number of corpus keys so that it lets through about
as many unlisted keys as are listed; from there the levels shrink, so the whole cascade
is some bits per rule and its size follows the rule list, not the corpus. That is what
is broadcast, and its size is known before. Keys are two 64-bit hashes. The corpus is
read three times: to count keys, to find the few that pass level 0, and to judge.

Defined cases: null url, no `://` or empty host fit no rule and are allowed; a rule on
both lists blocks; an empty rule list allows all; repeated rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values of the query: (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
MAX_LEVELS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def keys_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The (host suffix + path beginning) keys in the shapes that rules have, longest first."""
    labels = sorted({h.count(".") + 1 for _, h, _ in rules}, reverse=True)
    lengths = sorted({len(p) for _, _, p in rules}, reverse=True)
    parts = F.size(F.split(host, r"\."))
    keys = [
        F.when(
            (parts >= n) & (F.length(path) >= m),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m)),
        )
        for n in labels
        for m in lengths
    ]
    found = F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")
    return F.array_sort(
        found, lambda a, b: F.length(b) - F.length(a)
    )


def hashes(key: Column) -> Column:
    return F.array(F.xxhash64(key), F.xxhash64(key, F.lit(1)))


class Level:
    """One Bloom filter over pairs of 64-bit hashes."""

    def __init__(self, pairs: np.ndarray, false_rate: float, salt: int):
        n = max(1, len(pairs))
        per_key = max(1.0, math.log2(1 / false_rate))
        self.bits = max(64, int(math.ceil(1.4427 * n * per_key)))
        self.probes, self.salt = max(1, round(per_key)), salt
        self.words = np.zeros(-(-self.bits // 8), np.uint8)
        for place in self._places(pairs):
            np.bitwise_or.at(self.words, place >> 3, (1 << (place & 7)).astype(np.uint8))

    def _places(self, pairs: np.ndarray) -> Iterator[np.ndarray]:
        pairs = pairs.view(np.uint64)
        first, second = pairs[:, 0], pairs[:, 1] | np.uint64(1)
        with np.errstate(over="ignore"):
            mixed = first ^ (second * np.uint64(2 * self.salt + 3))
            for i in range(self.probes):
                mixed = (mixed + second) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
                yield (mixed % np.uint64(self.bits)).astype(np.int64)

    def holds(self, pairs: np.ndarray) -> np.ndarray:
        held = np.ones(len(pairs), bool)
        for place in self._places(pairs):
            held &= (self.words[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        return held


class Cascade:
    """Exact membership for all keys the levels were built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def holds(self, pairs: np.ndarray) -> np.ndarray:
        pairs = np.ascontiguousarray(pairs, np.int64).reshape(-1, 2)
        inside = np.zeros(len(pairs), bool)
        live = np.arange(len(pairs))
        for depth, level in enumerate(self.levels):
            live = live[level.holds(pairs[live])]
            inside[live] = depth % 2 == 0
        return inside

    def size(self) -> int:
        return sum(level.words.nbytes for level in self.levels)


def build_cascade(corpus_keys: DataFrame, n_keys: int, listed: list[str]) -> Cascade:
    """A cascade of `listed` over the corpus's keys (column `key`), n_keys of them at most."""
    spark = corpus_keys.sparkSession
    if not listed:
        return Cascade([])
    rules = spark.createDataFrame([(k,) for k in sorted(set(listed))], "key string")
    inside = _pairs(rules)
    # Lets through about as many unlisted keys as are listed.
    first = Level(inside, min(0.5, max(1e-18, len(inside) / (2.0 * max(1, n_keys)))), 0)
    shared = spark.sparkContext.broadcast(first)

    @F.pandas_udf("boolean")
    def passes(pairs: pd.Series) -> pd.Series:
        return pd.Series(shared.value.holds(_matrix(pairs)))

    wrong = (
        corpus_keys.filter(passes(hashes(F.col("key"))))
        .distinct()
        .join(rules, "key", "left_anti")
    )
    levels, outside = [first], _pairs(stored(wrong, "cascade"))
    while len(outside):
        if len(levels) >= MAX_LEVELS:
            raise ValueError("two different keys have the same hashes")
        levels.append(Level(outside, 0.5, len(levels)))
        inside, outside = outside, inside[levels[-1].holds(inside)]
    return Cascade(levels)


def _pairs(keys: DataFrame) -> np.ndarray:
    rows = keys.select(hashes(F.col("key")).alias("h")).toPandas()["h"]
    return _matrix(rows)


def _matrix(pairs: pd.Series) -> np.ndarray:
    if not len(pairs):
        return np.zeros((0, 2), np.int64)
    return np.concatenate(pairs.to_numpy()).astype(np.int64).reshape(-1, 2)


def judge(urls: DataFrame, rules: list[tuple[str, str, str]] = RULES, column: str = "url") -> DataFrame:
    """`urls` with host, path, rule (null if none fits) and verdict.

    Added columns replace columns of the same names.
    """
    added = ("host", "path", "rule", "verdict")
    kept = urls.drop(*[c for c in added if c != column])
    host, path = host_and_path(F.col(f"`{column}`"))
    plain = urls.select(host.alias("h"), path.alias("p")).select(
        F.explode(keys_of(F.col("h"), F.col("p"), rules)).alias("key")
    )
    n_keys = plain.count()
    blocked = [h + p for v, h, p in rules if v == "block"]
    allowed = [h + p for v, h, p in rules if v != "block"]
    cascades = urls.sparkSession.sparkContext.broadcast(
        (build_cascade(plain, n_keys, blocked), build_cascade(plain, n_keys, allowed))
    )

    @F.pandas_udf("int")
    def fits(batch: pd.Series) -> pd.Series:
        """Twice the place of the first listed key, and one more if it is blocked; else null."""
        sizes = batch.map(len).to_numpy() if len(batch) else np.zeros(0, int)
        pairs = _matrix(batch.explode().dropna())
        block, allow = cascades.value
        stop = block.holds(pairs)
        hit = np.flatnonzero(stop | allow.holds(pairs))
        row = np.repeat(np.arange(len(sizes)), sizes)
        rows, at = np.unique(row[hit], return_index=True)
        start = np.cumsum(sizes) - sizes
        found = pd.Series(pd.NA, index=range(len(sizes)), dtype="Int32")
        found.iloc[rows] = 2 * (hit[at] - start[rows]) + stop[hit[at]]
        return found

    keyed = (
        kept.withColumns({"_host": host, "_path": path})
        .withColumn("_keys", keys_of(F.col("_host"), F.col("_path"), rules))
        .withColumn("_fit", fits(F.transform("_keys", hashes)))
    )
    rule = F.when(
        F.col("_fit").isNotNull(), F.element_at("_keys", (F.floor(F.col("_fit") / 2) + 1).cast("int"))
    )
    verdict = F.when(F.col("_fit") % 2 == 1, "block").otherwise("allow")
    out = [F.col(f"`{c}`") for c in kept.columns]
    values = (F.col("_host"), F.col("_path"), rule, verdict)
    return keyed.select(*out, *[v.alias(c) for v, c in zip(values, added)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r
  FROM pages),
parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(r, '(?s)^([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(r, '(?s)^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rest),
rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""
