"""Passages that repeat across documents, by sparse suffix arrays.

Of a document's suffixes only those are retained that start at minimisers: in every run
of consecutive grams (runs of `gram` words) as long as a passage of `words` words has,
the gram with the smallest hash. Two documents that share a passage retain the suffix of
the same gram in it. Retained suffixes are brought together by their first gram; then,
for every way to extend the match left and right to `words` words, they are sorted by the
words of that extension and neighbours are compared. Equal neighbours of two documents
are a repeat, and the ways that fit join to its whole length: the result is every
`words`-word window that two documents have, as spans.

A suffix carries 16-bit hashes of the words around its gram, as far as a passage of
`words` words may reach; the gram itself is compared by 64 bits. So a span may be a word
too long with a probability of 2**-16 at each end. All that decides about a suffix is its
context: gram, words around and which windows count. Contexts are named by 64 bits.

A window counts if it has `distinct` different words at least: one by default and in the
query, which leaves no window out. With more, filler such as one word written fifty times
is no passage.

Large data: a first pass counts the grams; a bitmap of fixed size of those that repeat
spares the second pass most of the unrepeated ones (it may let others through, which
then have no equal neighbour). What is shuffled is about 160 bytes for each repeated
retained suffix, of which there is one for some 18 words. A second bitmap marks grams with
more than `hot` suffixes, of few texts or of many. These are not brought together: equal
contexts become one row, combined before the shuffle, and the extensions of distinct
contexts are counted by a grouped aggregation. The windows that repeat go back to the
suffixes by context, as ranges; a context that very many suffixes share is a hot key on
one side of that join only, which adaptive execution splits. Spans are merged per document.

Defined cases: null or empty text and texts of fewer than `words` words have no spans;
rows with null doc_id take no part; rows with the same doc_id are one document, whose
own repetitions do not count; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.sources.scratch import stored

WORDS, GRAM, HOT = 50, 16, 4_000
#: The bitmap's size, a power of two.
BITMAP = 1 << 26
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def _runs(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` values, by doubling."""
    have = 1
    with np.errstate(over="ignore"):
        while have < length:
            shift = min(have, length - have)
            values = _mix(values[:-shift] * _ODD + (values[shift:] ^ np.uint64(shift)))
            have += shift
    return values


def counting(hashes: np.ndarray, words: int, distinct: int) -> np.ndarray:
    """Of each window of `words` words whether it has `distinct` different ones."""
    n = len(hashes)
    if n < words or distinct <= 1:
        return np.ones(max(0, n - words + 1), bool)
    order = np.argsort(hashes, kind="stable")
    again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    before = np.full(n, -1)
    before[order[again + 1]] = order[again]
    # A word is new in the windows that start after its last occurrence and reach it.
    place = np.arange(n)
    change = np.bincount(np.maximum(before, place - words) + 1, minlength=n + 1)
    change[1:] -= 1
    return np.cumsum(change)[: n - words + 1] >= distinct


def _minimisers(
    text: str | None, words: int, gram: int, distinct: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(digest, (text or "").encode("utf-8", "replace").split()), np.uint64)
    counts = counting(hashes, words, distinct)
    if not counts.any():
        return hashes, np.zeros(0, np.int64), np.zeros(0, np.uint64), counts
    grams = _runs(hashes, gram)
    window = words - gram + 1
    least = sliding_window_view(_mix(grams), window).argmin(axis=1) + np.arange(len(grams) - window + 1)
    least = least[counts]
    places = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return hashes, places, grams[places], counts


def retained(
    text: str | None, words: int, gram: int, distinct: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all words, starts of the minimisers of windows that count, their grams)."""
    return _minimisers(text, words, gram, distinct)[:3]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binaries."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _grams(words: int, gram: int, distinct: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(retained(t, words, gram, distinct)[2], return_counts=True)
                     for t in batch["text"].to_pylist()]
            flat = np.concatenate([np.zeros(0, np.uint64), *(g for g, _ in found)]).view(np.int64)
            times = np.concatenate([np.zeros(0, np.int64), *(n for _, n in found)])
            yield pa.RecordBatch.from_pydict({"gram": flat, "times": times})

    return emit


def _holds(bitmap: np.ndarray, grams: np.ndarray) -> np.ndarray:
    at = grams & np.uint64(BITMAP - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _terms(around: np.ndarray) -> np.ndarray:
    """A hash of each word around a gram with its place."""
    with np.errstate(over="ignore"):
        factors = _mix(np.arange(1, around.shape[1] + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
        return _mix(around.astype(np.uint64) * _ODD + factors)


def _suffixes(words: int, gram: int, distinct: int, repeated, frequent):
    """Each retained suffix whose gram `repeated` holds, with its context."""
    reach = words - gram

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(reach + 1, dtype=np.uint64)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                hashes, places, grams, counts = _minimisers(text, words, gram, distinct)
                keep = _holds(repeated.value, grams)
                places, grams = places[keep], grams[keep]
                if not len(places):
                    continue
                short = (hashes >> np.uint64(48)).astype(np.uint16)
                padded = np.concatenate([np.zeros(reach, np.uint16), short, np.zeros(reach, np.uint16)])
                around = sliding_window_view(padded, 2 * reach + gram)[places]
                around = np.concatenate([around[:, :reach], around[:, reach + gram :]], axis=1)
                # Bit i: the window that starts reach - i words before the gram counts.
                fits = np.concatenate([np.zeros(reach, bool), counts, np.zeros(reach, bool)])
                allowed = (sliding_window_view(fits, reach + 1)[places].astype(np.uint64) << bits).sum(axis=1)
                with np.errstate(over="ignore"):
                    context = _mix(_terms(around).sum(axis=1, dtype=np.uint64) + _mix(grams * _ODD + _mix(allowed)))
                yield pa.RecordBatch.from_pydict({
                    "gram": grams.view(np.int64),
                    "context": context.view(np.int64),
                    "doc_id": np.full(len(places), doc_id, np.int64),
                    "start": places.astype(np.int32),
                    "allowed": allowed.astype(np.uint64).view(np.int64),
                    "around": _binary(around),
                    "hot": _holds(frequent.value, grams),
                })

    return emit


SUFFIX = "gram long, context long, doc_id long, start int, allowed long, around binary, hot boolean"


def _table(batch: pa.RecordBatch | pa.Table, reach: int, columns: tuple[str, ...]) -> dict[str, np.ndarray]:
    out = {c: batch[c].to_numpy() if isinstance(batch, pa.Table) else batch[c].to_numpy(zero_copy_only=False)
           for c in ("gram", "context", "allowed", *columns)}
    joined = b"".join(batch["around"].to_pylist())
    return out | {"around": np.frombuffer(joined, np.uint16).reshape(-1, 2 * reach)}


def _extensions(rows: dict[str, np.ndarray], reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each window by its bit: the rows in which it counts, and a name of its words."""
    base = rows["gram"].view(np.uint64)
    allowed = rows["allowed"].view(np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([
            np.zeros((len(base), 1), np.uint64), np.cumsum(_terms(rows["around"]), axis=1, dtype=np.uint64)
        ], axis=1)
        for bit in range(reach + 1):
            counts = (allowed >> np.uint64(bit) & np.uint64(1)).astype(bool)
            yield bit, counts, _mix(sums[:, reach + bit] - sums[:, bit] + _mix(base + np.uint64(reach - bit)))


RANGE = "context long, low int, high int, first_doc_id long"


def _ranges_of(rows: dict[str, np.ndarray], reach: int) -> pa.RecordBatch:
    """Of whole groups: each context's ranges of windows that two documents have."""
    n = len(rows["gram"])
    repeat = np.zeros((n, reach + 2), bool)
    first = np.full(n, np.iinfo(np.int64).max)
    docs = rows["doc_id"]
    for bit, counts, name in _extensions(rows, reach):
        at = np.flatnonzero(counts)
        order = at[np.lexsort((docs[at], name[at]))]
        if len(order) < 2:
            continue
        key = name[order]
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        run = np.cumsum(begins) - 1
        head = np.flatnonzero(begins)
        tail = np.append(head[1:], len(order)) - 1
        several = (docs[order[head]] != docs[order[tail]])[run]
        hit = order[several]
        repeat[hit, bit + 1] = True
        np.minimum.at(first, hit, docs[order[head]][run][several])
    one = np.unique(rows["context"], return_index=True)[1]
    edges = np.diff(np.concatenate([repeat[one], np.zeros((len(one), 1), bool)], axis=1).astype(np.int8), axis=1)
    row, low = np.nonzero(edges == 1)
    _, stop = np.nonzero(edges == -1)
    return pa.RecordBatch.from_pydict({
        "context": rows["context"][one[row]], "low": low.astype(np.int32),
        "high": (stop - 1).astype(np.int32), "first_doc_id": first[one[row]],
    })


def _compare(reach: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by gram; the last gram of a batch waits for the next batch."""
        held = None
        for batch in batches:
            if not len(batch):
                continue
            whole = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            grams = whole["gram"].to_numpy()
            cut = int(np.searchsorted(grams, grams[-1]))
            if cut:
                yield _ranges_of(_table(whole.slice(0, cut), reach, ("doc_id",)), reach)
            held = whole.slice(cut)
        if held is not None and len(held) > 1:
            yield _ranges_of(_table(held, reach, ("doc_id",)), reach)

    return compare


def _named(reach: int):
    """Each extension of each context by name."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = _table(batch, reach, ("least", "most"))
            for bit, counts, name in _extensions(rows, reach):
                yield pa.RecordBatch.from_pydict({
                    "name": name[counts].view(np.int64),
                    "context": rows["context"][counts],
                    "bit": np.full(int(counts.sum()), bit, np.int32),
                    "least": rows["least"][counts],
                    "most": rows["most"][counts],
                })

    return name


def _bitmap(grams: DataFrame) -> np.ndarray:
    """One bit per gram by its last bits; of fixed size, worked out by the executors."""
    place = F.col("gram").bitwiseAND(F.lit(BITMAP - 1))
    words = grams.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    ).toPandas()
    held = np.zeros(BITMAP >> 6, np.uint64)
    held[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return held


def gram_counts(texts: DataFrame, words: int, gram: int, distinct: int = 1) -> DataFrame:
    """(gram, n, suffixes) of the grams that several texts retain: the texts and all occurrences."""
    found = texts.select("text").mapInArrow(_grams(words, gram, distinct), "gram long, times long")
    counts = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.sum("times").alias("suffixes"))
    return counts.filter("n > 1")


def marked_suffixes(texts: DataFrame, words: int, gram: int, hot: int, distinct: int = 1) -> DataFrame:
    """The retained suffixes of repeated grams; `hot` marks those of grams with more than `hot`."""
    counts = stored(gram_counts(texts, words, gram, distinct), "grams")
    share = texts.sparkSession.sparkContext.broadcast
    repeated, frequent = share(_bitmap(counts)), share(_bitmap(counts.filter(F.col("suffixes") > hot)))
    return stored(texts.mapInArrow(_suffixes(words, gram, distinct, repeated, frequent), SUFFIX), "suffixes")


def few_ranges(suffixes: DataFrame, reach: int) -> DataFrame:
    """The repeated ranges of contexts whose gram has few suffixes: these are compared in place."""
    few = suffixes.filter("NOT hot").select("gram", "context", "doc_id", "allowed", "around")
    return few.repartition("gram").sortWithinPartitions("gram").mapInArrow(_compare(reach), RANGE)


def frequent_ranges(suffixes: DataFrame, reach: int) -> DataFrame:
    """The same of the other contexts, by aggregation over the distinct ones."""
    contexts = stored(
        suffixes.filter("hot").groupBy("gram", "context", "allowed", "around")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")),
        "contexts",
    )
    named = contexts.mapInArrow(_named(reach), "name long, context long, bit int, least long, most long")
    common = (
        named.groupBy("name")
        .agg(F.min("least").alias("first_doc_id"), F.max("most").alias("last"))
        .filter("first_doc_id <> last")
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    has = lambda i: F.call_function("shiftright", F.col("bits"), i).bitwiseAND(F.lit(1)) == 1
    bits = F.sequence(F.lit(0), F.lit(reach))
    lows = F.filter(bits, lambda i: has(i) & ((i == 0) | ~has(F.greatest(i - 1, F.lit(0)))))
    highs = F.filter(bits, lambda i: has(i) & ~has(i + 1))
    return (
        named.select("name", "context", "bit").join(common.select("name", "first_doc_id"), "name")
        .groupBy("context")
        .agg(F.bit_or(bit).alias("bits"), F.min("first_doc_id").alias("first_doc_id"))
        .select("context", F.explode(F.arrays_zip(lows.alias("low"), highs.alias("high"))).alias("range"), "first_doc_id")
        .select("context", F.col("range.low").alias("low"), F.col("range.high").alias("high"), "first_doc_id")
    )


def repeated_spans(
    docs: DataFrame, words: int = WORDS, gram: int = GRAM, hot: int = HOT, distinct: int = 1
) -> DataFrame:
    """(doc_id, start_word, n_words, first_doc_id) of all passages of `words` words or more
    that another document has too, each window with `distinct` different words at least;
    words are what white space separates. first_doc_id is the smallest id of the documents
    with a part of the passage.
    """
    reach = words - gram
    if not 0 <= reach <= 61:
        raise ValueError("a passage has up to 61 words more than a gram")
    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    suffixes = marked_suffixes(texts, words, gram, hot, distinct)
    ranges = few_ranges(suffixes, reach).union(frequent_ranges(suffixes, reach))
    begin = F.col("start").cast("long") - reach
    spans = suffixes.select("context", "doc_id", "start").join(ranges, "context").select(
        "doc_id", (begin + F.col("low")).alias("begin"), (begin + F.col("high")).alias("upto"), "first_doc_id"
    )
    order = Window.partitionBy("doc_id").orderBy("begin", "upto")
    before = F.max("upto").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("begin") <= before + words, 0).otherwise(1)
    return (
        spans.withColumn("fresh", fresh)
        .withColumn("span", F.sum("fresh").over(order))
        .groupBy("doc_id", "span")
        .agg(
            F.min("begin").alias("start_word"),
            (F.max("upto") + words - F.min("begin")).alias("n_words"),
            F.min("first_doc_id").alias("first_doc_id"),
        )
        .drop("span")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repeated_spans(docs)
