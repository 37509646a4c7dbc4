"""SimHash near-duplicates by pigeonhole blocks.

A document's fingerprint has the majority bits of its word shingles' 64-bit hashes.
Fingerprints at `distance` or fewer differing bits are linked, and documents that links
reach form a class. Cut into b blocks, two linked fingerprints agree on at least
b - distance of them; so each choice of b - distance blocks is a table, linked pairs
meet in a bucket of some table, and the Hamming distance is verified there.

Large data: equal fingerprints are one node from the start, so exact copies cost
nothing further. Texts are read once and not shuffled; a shuffled row is a fingerprint
and an id. More distinct fingerprints mean more blocks, so that buckets stay small.
Within a bucket no pairs are listed: a search from node to node over those not yet
reached gives at most one link per fingerprint, which keeps all reachability. Buckets of
many near copies are cut into chunks, and each two chunks are searched by one task.
Classes come from star contraction over stored links.

`near_duplicates` links on the fingerprint alone. `similar_documents` links texts of at
least a given share of common word shingles, exactly. The share of bits in which two
fingerprints of distinct shingles differ is the angle between the sets, 0.15 at a
similarity of 0.8. Several independent fingerprints are cut into blocks; two that agree on
a block, and do not differ further than six standard deviations in three longer check
fingerprints, are candidates. The number of fingerprints follows from `MISSED`: a pair at
`similarity` agrees on no block with a probability of at most a millionth, more alike ones
still less often. (Two texts of four and five shingles, whose bits are uneven sums, differ
in 0.19 of the bits; for them it is up to 6 in 10,000.) Classes of candidates hold all pairs that
are linked; in each the shingle sets themselves are compared, and only pairs that reach
`similarity` are links. A class of more than ELEMENTS shingles is cut into chunks, each two
of which are one task; the rows of such a class are sent once per chunk.

Defined cases: null text and text without words have fingerprint zero; fewer words than
a shingle are one shingle; a row with null doc_id gets its fingerprint, a null class, and
links nothing; repeated rows share a class; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import acos, ceil, comb, log, log2, pi, sqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.components import components
from lectern.sources.scratch import stored

SHINGLE, DISTANCE, BITS = 3, 3, 64
CHUNK = 50_000
# For similar_documents: words of a shingle, share of common shingles, fingerprints to check
# candidates by, pairs at that share that may meet in no block, texts in a block's bucket.
SIMILAR_SHINGLE, SIMILARITY, CHECK_LONGS, MISSED, BUCKET = 5, 0.8, 3, 1e-6, 1_000
#: Tables searched before classes are first formed.
FIRST = 2
#: Shingles of a class of candidates that one task holds, or twice as many of two chunks.
ELEMENTS = 4_000_000
GOLD = 0x4F1BBCDCBFA53E0B
#: A row through the shuffle costs as much as comparing it with so many others.
COMPARED = 128


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _hashes(words: list[bytes], shingle: int, distinct: bool = False) -> np.ndarray:
    """XXH64 (seed 42) of the shingles; of fewer words all are one."""
    digest = xxhash.xxh64_intdigest
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    joined = map(b" ".join, runs)
    return np.fromiter((digest(run, 42) for run in (set(joined) if distinct else joined)), np.uint64)


def majority(hashes: np.ndarray) -> np.ndarray:
    """For each column of 64-bit hashes the bits that over half of them have."""
    ones = np.zeros((hashes.shape[1], BITS), np.int64)
    for start in range(0, len(hashes), 255):  # as many as a byte counts
        part = np.ascontiguousarray(hashes[start : start + 255])
        bits = np.unpackbits(part.view(np.uint8).reshape(*part.shape, 8), axis=2, bitorder="little")
        ones += bits.sum(0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").view(np.int64)[:, 0]


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text, as a signed 64-bit number."""
    words = _words(text)
    return int(majority(_hashes(words, shingle)[:, None])[0]) if words else 0


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct shingles' hashes in order; none for a text without words."""
    words = _words(text)
    return np.unique(_hashes(words, shingle, distinct=True)) if words else np.zeros(0, np.uint64)


def set_name(shingles: bytes) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return tuple(np.frombuffer(xxhash.xxh128_digest(shingles), np.int64).tolist())


def long_fingerprint_of(shingles: np.ndarray, longs: int) -> list[int]:
    """Independent 64-bit SimHashes of a set."""
    if not len(shingles):
        return [0] * longs
    each = shingles[:, None]
    with np.errstate(over="ignore"):
        wide = (each ^ each >> np.uint64(31)) * (np.arange(longs, dtype=np.uint64) * np.uint64(2 * GOLD) + np.uint64(GOLD))
        wide = (wide ^ wide >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        wide ^= wide >> np.uint64(32)
    return majority(wide).tolist()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as a long) of all rows."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", simhash(F.col("text")).alias("fingerprint"))


def block_count(distinct: int, distance: int = DISTANCE) -> int:
    """The fewest blocks for which a fingerprint meets few unrelated ones."""
    for blocks in range(distance + 2, BITS + 1):
        shared = BITS * (blocks - distance) // blocks
        if distinct * comb(blocks, distance) <= COMPARED * 2**shared:
            return blocks
    return BITS


def block_keys(print_: Column, distance: int, blocks: int) -> Column:
    """For each table the bits that a bucket of it has in common."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    keys = []
    for table, chosen in enumerate(combinations(masks, blocks - distance)):
        mask = sum(chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(table).alias("table"), print_.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def share_of_bits(similarity: float) -> float:
    """The share of bits in which fingerprints of sets with this similarity differ."""
    return acos(2 * similarity / (1 + similarity)) / pi


def check_distance(similarity: float, longs: int) -> int:
    """Bits in which such fingerprints differ: the expected number and six standard deviations."""
    bits, share = BITS * longs, share_of_bits(similarity)
    return round(bits * share + 6 * sqrt(bits * share * (1 - share)))


def block_plan(texts: int, similarity: float = SIMILARITY) -> tuple[int, int]:
    """(bits of a block, number of fingerprints), so that a pair is missed with `MISSED` at most."""
    width = min(14, max(8, ceil(log2(max(texts, 1) / BUCKET))))
    blocks = log(MISSED) / log(1 - (1 - share_of_bits(similarity)) ** width)
    return width, ceil(blocks / (BITS // width))


def spanning_links(
    prints: np.ndarray,
    distance: int,
    left: np.ndarray | None = None,
    checks: np.ndarray | None = None,
    most: int = 0,
) -> list[tuple[int, int]]:
    """Links (by place) that keep all reachability within a bucket.

    With `left`, only those between a member of it and another count; with `checks`, the
    longer fingerprints differ in `most` bits at most, too.
    """
    rest, found = np.arange(len(prints)), []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(prints[rest] ^ prints[node]) <= distance
            if left is not None:
                near &= left[rest] != left[node]
            if checks is not None and near.any():
                at = np.flatnonzero(near)
                near[at] = np.bitwise_count(checks[rest[at]] ^ checks[node]).sum(1) <= most
            reached = rest[near]
            found += [(node, other) for other in reached]
            queue += list(reached)
            rest = rest[~near]
    return found


def bucket_links(
    prints: np.ndarray, distance: int, left: np.ndarray | None, checks: np.ndarray, most: int
) -> list[tuple[int, int]]:
    """Links as of `spanning_links`, by comparing all at once where few are near each other."""
    n, count, found = len(prints), 0, []
    if n > 4096:
        return spanning_links(prints, distance, left, checks, most)
    met, step = np.zeros(n, bool), max(1, (1 << 18) // n)
    for start in range(0, n, step):
        one, other = checks[start : start + step], checks[start:]
        apart = sum(np.bitwise_count(one[:, None, c] ^ other[None, :, c]) for c in range(checks.shape[1]))
        u, v = np.nonzero(apart <= most)
        u, v = u[v > u] + start, v[v > u] + start
        if left is not None:
            cross = left[u] != left[v]
            u, v = u[cross], v[cross]
        met[u] = met[v] = True
        count += len(u)
        if count <= 4 * n:
            found += zip(u, v)
    if count <= 4 * n:
        return found
    at = np.flatnonzero(met)
    within = spanning_links(prints[at], distance, None if left is None else left[at], checks[at], most)
    return [(at[u], at[v]) for u, v in within]


def uniting(pairs: list[tuple[int, int]], classes: np.ndarray) -> np.ndarray:
    """Of links by place, those that unite classes not united before, as pairs of classes."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            x = above[x]
        return x

    kept = []
    for u, v in pairs:
        one, other = int(classes[u]), int(classes[v])
        low, high = sorted((top(one), top(other)))
        if low != high:
            above[high] = low
            kept.append((one, other))
    return np.array(kept, np.int64).reshape(-1, 2)


def _frame(links: list[np.ndarray]) -> pd.DataFrame:
    both = np.concatenate([np.zeros((0, 2), np.int64), *links])
    return pd.DataFrame({"u": both[:, 0], "v": both[:, 1]})


def _search(distance: int, checks: list[str], most: int):
    """Links of ids, or with `checks` of the classes that rows are in already."""
    columns = ["table", "key", "low", "high", "chunk", "fingerprint", "rep", *checks]
    columns += ["class"] * bool(checks)

    def links_of(group: np.ndarray) -> np.ndarray:
        left = group[:, 4] == group[:, 2] if group[0, 2] != group[0, 3] else None
        unsigned = np.ascontiguousarray(group).view(np.uint64)
        if checks:
            classes = group[:, -1]
            if (classes == classes[0]).all():
                return np.zeros((0, 2), np.int64)
            own = [5, *range(7, 7 + len(checks))]
            return uniting(bucket_links(unsigned[:, 5], distance, left, unsigned[:, own], most), classes)
        pairs = spanning_links(unsigned[:, 5], distance, left)
        return group[:, 6][np.array(pairs, int).reshape(-1, 2)]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by bucket; the last bucket of a batch waits for the next batch."""
        held = np.zeros((0, len(columns)), np.int64)
        for batch in batches:
            rows = np.concatenate([held, batch[columns].to_numpy(np.int64)])
            cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            *groups, held = np.split(rows, cuts)
            yield _frame([links_of(g) for g in groups if len(g) > 1])
        yield _frame([links_of(held)] if len(held) > 1 else [])

    return search


def _chunked(rows: DataFrame, at: list[str], chunks: Column, rep: str = "rep") -> DataFrame:
    """Each row once for every pair of chunks that its own chunk is in: low, high, chunk."""
    named = [F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")]
    return (
        rows.withColumn("chunk", F.pmod(F.xxhash64(rep), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(*rows.columns, "chunk", *named)
        .repartition(*at, "low", "high")
        .sortWithinPartitions(*at, "low", "high")
    )


def near_links(
    nodes: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK, blocks: int | None = None
) -> DataFrame:
    """Links (u, v) that connect the ids `rep` of distinct fingerprints as all links would."""
    blocks = blocks or block_count(nodes.count(), distance)
    keyed = nodes.select("fingerprint", "rep", F.inline(block_keys(F.col("fingerprint"), distance, blocks)))
    sizes = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    dealt = _chunked(keyed.join(sizes, ["table", "key"]), ["table", "key"], chunks).drop("n")
    return dealt.mapInPandas(_search(distance, [], 0), "u long, v long")


def candidate_links(
    nodes: DataFrame, tables: list[tuple[str, int]], width: int, similarity: float, chunk: int = CHUNK
) -> DataFrame:
    """Links (u, v) that connect the values of `class` of all nodes that agree on a block
    and differ in no more bits of check0, check1 ... than `similarity` allows.

    A table is a fingerprint and the number of the block of `width` bits in it. A bucket
    gives at most one link less than it has classes.
    """
    checks = [f"check{i}" for i in range(CHECK_LONGS)]
    keys = [
        F.struct(
            F.lit(table).alias("table"),
            F.shiftrightunsigned(name, at * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int").alias("key"),
        )
        for table, (name, at) in enumerate(tables)
    ]
    renamed = [F.col(checks[0]).alias("fingerprint"), "rep", *checks[1:], "class"]
    keyed = nodes.select(*renamed, F.inline(F.array(*keys)))
    # Few buckets are that large, so they go to all executors and the rows move once.
    large = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > chunk)
    chunks = F.coalesce(F.ceil(F.col("n") / chunk).cast("int"), F.lit(1))
    dealt = _chunked(keyed.join(F.broadcast(large), ["table", "key"], "left"), ["table", "key"], chunks).drop("n")
    search = _search(check_distance(similarity, 1), checks[1:], check_distance(similarity, CHECK_LONGS))
    return dealt.mapInPandas(search, "u long, v long")


def exact_links(sets: list[np.ndarray], similarity: float, left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (by place) that keep all reachability by pairs of at least that similarity.

    With `left`, only those between a member of it and another count.
    """
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner, ends = np.repeat(np.arange(len(sets)), sizes), np.cumsum(sizes)
    own = [ids[end - size : end] for end, size in zip(ends, sizes)]
    marked = np.zeros(len(ids) + 1, bool)
    rest, found = np.arange(len(sets)), []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            marked[own[node]] = True
            common = np.bincount(owner[marked[ids]], minlength=len(sets))[rest]
            marked[own[node]] = False
            near = common >= similarity * (sizes[rest] + sizes[node] - common) - 1e-9
            if left is not None:
                near &= left[rest] != left[node]
            if not near.any():
                continue
            reached, rest = rest[near], rest[~near]
            found += [(node, other) for other in reached]
            queue += list(reached)
            stay = np.zeros(len(sets), bool)
            stay[rest] = True
            owner, ids = owner[stay[owner]], ids[stay[owner]]
    return found


def _verify(similarity: float):
    columns = ["component", "low", "high", "chunk", "rep", "shingles"]

    def links_of(rows: list[tuple]) -> np.ndarray:
        _, low, high, *_ = rows[0]
        left = np.array([r[3] == low for r in rows]) if low != high else None
        pairs = exact_links([np.frombuffer(r[5], np.uint64) for r in rows], similarity, left)
        return np.array([r[4] for r in rows], np.int64)[np.array(pairs, int).reshape(-1, 2)]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by class and chunks; the last group of a batch waits for the next."""
        rows: list[tuple] = []
        for batch in batches:
            links = []
            for row in batch[columns].itertuples(index=False, name=None):
                if rows and rows[0][:3] != row[:3]:
                    links.append(links_of(rows))
                    rows = []
                rows.append(row)
            yield _frame(links)
        yield _frame([links_of(rows)] if rows else [])

    return verify


def similar_links(
    docs: DataFrame, nodes: DataFrame, loose: DataFrame, shingle: int, similarity: float, elements: int
) -> DataFrame:
    """Links (u, v) by exact similarity within the classes `loose` (node, component)."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["shingles"] = [shingle_set(t, shingle).tobytes() for t in batch["text"]]
            # An id may have other texts, too, that count with another representative.
            own = [set_name(s)[0] in names for s, names in zip(batch["shingles"], batch["own"])]
            yield batch[np.array(own, bool)][["rep", "component", "chunks", "shingles"]]

    ids = nodes.groupBy("rep").agg(F.sum("size").alias("size"), F.collect_set("set0").alias("own"))
    members = ids.join(loose, ids["rep"] == loose["node"])
    sizes = members.groupBy("component").agg(F.ceil(F.sum("size") / elements).cast("int").alias("chunks"))
    chunks = F.greatest("chunks", F.lit(1)).alias("chunks")
    named = members.join(sizes, "component").select("rep", "component", "own", chunks)
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    texts = texts.join(named, "rep").dropDuplicates(["rep", "text"])
    rows = texts.mapInPandas(sets, "rep long, component long, chunks int, shingles binary")
    return _chunked(rows, ["component"], F.col("chunks")).mapInPandas(_verify(similarity), "u long, v long")


def _classes(prints: DataFrame, names: list[str], nodes: DataFrame, found: DataFrame) -> DataFrame:
    """`prints` (doc_id and the columns `names`) with component_id, by components of `nodes`."""
    classes = nodes.join(found, nodes["rep"] == found["node"], "left").select(
        *names, F.coalesce("component", "rep").alias("class")
    )
    known = F.when(F.col("doc_id").isNotNull(), F.col("class"))
    return prints.join(classes, names, "left").withColumn("component_id", known)


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, chunk: int = CHUNK
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all rows; the class is its smallest doc_id."""
    prints = stored(fingerprints(docs, shingle), "simhash")
    known = prints.filter("doc_id IS NOT NULL")
    rows = prints.count()
    nodes = stored(known.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "simhash", rows)
    most = rows * comb(block_count(rows, distance), distance)  # per table, unless buckets are chunked
    classes = _classes(prints, ["fingerprint"], nodes, components(near_links(nodes, distance, chunk), most))
    return classes.select("doc_id", "fingerprint", "component_id")


def _loose_classes(
    nodes: DataFrame, tables: list[tuple[str, int]], width: int, similarity: float, chunk: int
) -> DataFrame:
    """(node, component) of the ids that have candidates, by components of all their links.

    The first tables find nearly all classes; the later ones link only what is still in
    different classes, so a group of copies gives its links once and not per table.
    """
    classes = nodes.select("rep", F.col("rep").alias("class")).distinct()
    for some in (tables[:FIRST], tables[FIRST : 4 * FIRST], tables[4 * FIRST :]):
        links = candidate_links(nodes.join(classes, "rep"), some, width, similarity, chunk)
        merged = components(links)
        joined = classes.join(merged, classes["class"] == merged["node"], "left")
        classes = stored(joined.select("rep", F.coalesce("component", "class").alias("class")), "classes")
    several = classes.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return classes.join(several, "class", "left_semi").select(F.col("rep").alias("node"), F.col("class").alias("component"))


def similar_documents(
    docs: DataFrame,
    shingle: int = SIMILAR_SHINGLE,
    similarity: float = SIMILARITY,
    chunk: int = CHUNK,
    elements: int = ELEMENTS,
) -> DataFrame:
    """(doc_id, component_id) of all rows, linked from `similarity` of common shingles on."""
    width, count = block_plan(docs.count(), similarity)
    blocked = [f"print{i}" for i in range(count)]
    longs = [*(f"check{i}" for i in range(CHECK_LONGS)), *blocked]
    names = ["set0", "set1"]  # equal sets, by 128 bits

    @F.pandas_udf(", ".join(f"{n} long" for n in [*names, "size", *longs]))
    def simhash(texts: pd.Series) -> pd.DataFrame:
        rows = np.zeros((len(texts), len(names) + 1 + len(longs)), np.int64)
        for row, text in zip(rows, texts):
            shingles = shingle_set(text, shingle)
            row[:2] = set_name(shingles.tobytes())
            row[2] = len(shingles)
            row[3:] = long_fingerprint_of(shingles, len(longs))
        return pd.DataFrame(rows, columns=[*names, "size", *longs])

    prints = stored(docs.select("doc_id", simhash(F.col("text")).alias("p")).select("doc_id", "p.*"), "simhash")
    first = [F.first(n).alias(n) for n in ["size", *longs]]
    known = prints.filter("doc_id IS NOT NULL")
    nodes = stored(known.groupBy(*names).agg(F.min("doc_id").alias("rep"), *first), "simhash")
    tables = [(name, at) for name in blocked for at in range(BITS // width)]
    loose = _loose_classes(nodes, tables, width, similarity, chunk)
    found = components(similar_links(docs, nodes, loose, shingle, similarity, elements))
    return _classes(prints.select("doc_id", *names), names, nodes, found).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest doc_id; rows without an id stay."""
    first = classes.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*[f"`{c}`" for c in docs.columns]).union(docs.filter("doc_id IS NULL"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return near_duplicates(docs).select("doc_id", text.alias("fingerprint"), "component_id")
