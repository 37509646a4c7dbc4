"""Byte-level BPE over overlapping chunks.

A text is cut into chunks of CHUNK characters, each seen with the OVERLAP characters after
it. Chunks are split into pre-tokens independently, each as if a pre-token began at its
start, and every pre-token is encoded by the ranks of its bytes. What a pattern matches
from a place on depends on the text from there on only, so two chunks that both have a
boundary at one place of their overlap agree from it on: the earlier chunk's tokens count
up to the first such place, the later one's from it. A boundary counts only if it lies so
far before the end of what its chunk sees that more text could not move it. Texts whose
neighbouring chunks share no boundary (a run of letters longer than the overlap) are cut
again with chunks GROWTH times as long, until they agree or are one chunk. Decoding
concatenates the bytes of the ids.

Large data: a text of one chunk is encoded where it is read. Chunks of longer texts are
dealt over all tasks by the text's digest and their number; copies of a text are one by
then, combined before the shuffle, so neither a long text nor a much copied one keeps a
task busy. A chunk sends on its ids, two bytes each if the vocabulary allows, and the
boundaries of its two overlaps, in numbers as short as its length allows. Only the ids of
one text meet in one place. `encode_digests` takes a text's digests where its ids meet, once
for all copies, so the ids themselves are neither stored nor sent to the rows they are for.

Defined cases: null text is empty, an empty text has no ids; there are no special tokens;
repeated rows and ids are repeated; an empty table gives no rows; only the named columns
are read, so others may have any names. Pre-tokens remembered by a task are bounded in
number and length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.scratch import stored

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CHUNK, OVERLAP, GROWTH, FRAME = 8_192, 512, 16, 1 << 20
REMEMBERED, LONG, SHORT = 400_000, 64, 48
#: A pre-token that ends this far before the end of what is seen cannot change: the
#: pattern looks at most two characters beyond the start of a contraction.
SURE = 2


class Ranks(dict):
    """Encoded pre-tokens: text to the bytes of its ids. Unknown ones are merged when asked for."""

    def __init__(self, lines: bytes, pattern: str):
        super().__init__()
        pairs = (line.split() for line in lines.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.kind = np.dtype("<u2" if max(self.tokens, default=0) < 1 << 16 else "<u4")
        self.pattern = regex.compile(pattern)
        self.older: dict[str, bytes] = {}
        self.single = [self.ranks[bytes([b])] for b in range(256)]

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            merge = self.merged_short if len(data) <= SHORT else self.merged
            ids = array(self.kind.char, merge(data)).tobytes()
        if len(piece) <= LONG:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    @cached_property
    def joined(self) -> list[dict[int, int]]:
        """Per id the ids that may follow it, and the token that both make."""
        ranks = self.ranks
        found: list[dict[int, int]] = [{} for _ in range(max(ranks.values()) + 1)]
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    found[left][right] = rank
        return found

    def merged_short(self, piece: bytes) -> list[int]:
        """The same as `merged` for a few bytes, by searching the list of pairs for each merge."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        joined, none = self.joined, 1 << 29
        ids = list(map(self.single.__getitem__, piece))
        pairs = [joined[a].get(b, none) for a, b in zip(ids, ids[1:])]
        while (best := min(pairs)) < none:
            at = pairs.index(best)
            ids[at] = best
            del ids[at + 1], pairs[at]
            if at:
                pairs[at - 1] = joined[ids[at - 1]].get(best, none)
            if at < len(pairs):
                pairs[at] = joined[best].get(ids[at + 1], none)
            elif not at:
                break
        return ids

    def merged(self, piece: bytes) -> list[int]:
        """Adjacent parts of the lowest rank become one, leftmost first, while there are any."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        ends = list(range(1, n + 1))  # of the part that begins at each byte; 0: none begins
        before = list(range(-1, n - 1))
        found = self.ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := found(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, start, stop = heapq.heappop(heap)
            middle = ends[start]
            if not middle or middle >= n or ends[middle] != stop:
                continue  # one of its parts has been merged meanwhile
            ends[start], ends[middle] = stop, 0
            if stop < n:
                before[stop] = start
                if (r := found(piece[start : ends[stop]])) is not None:
                    heapq.heappush(heap, (r, start, ends[stop]))
            if start and (r := found(piece[before[start] : stop])) is not None:
                heapq.heappush(heap, (r, before[start], stop))
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : ends[at]]])
            at = ends[at]
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text that is one chunk."""
        return np.frombuffer(b"".join(map(self.__getitem__, self.pattern.findall(text))), self.kind)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def view(self, text: str, step: int, complete: bool):
        """(ids, head, tail) of a chunk and what it sees after its `step` characters.

        head and tail hold (place, number of ids before it) of the boundaries below `step`
        and from it on. `complete`: the text ends where `text` does.
        """
        pieces = self.pattern.findall(text)
        ends = np.cumsum([0, *map(len, pieces)])
        if not complete:
            sure = int(np.searchsorted(ends, len(text) - SURE, side="right"))
            pieces, ends = pieces[: max(0, sure - 1)], ends[: max(1, sure)]
        coded = list(map(self.__getitem__, pieces))
        counts = np.cumsum([0, *map(len, coded)]) // self.kind.itemsize
        marks = np.stack([ends, counts], axis=1)
        return b"".join(coded), marks[ends < step], marks[ends >= step]


@lru_cache(maxsize=2)
def _loaded(lines: bytes, pattern: str) -> Ranks:
    return Ranks(lines, pattern)


def _shared(df: DataFrame, path: str | None):
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return df.sparkSession.sparkContext.broadcast((file.read(), public_tokenizers.PATTERN))


def mark_kind(seen: int) -> np.dtype:
    """The type of places and numbers of ids in `seen` characters, of four bytes at most each."""
    return np.dtype("<u2" if 4 * seen < 1 << 16 else "<u4" if 4 * seen < 1 << 32 else "<i8")


def _marks(column: bytes, marks: np.dtype) -> np.ndarray:
    return np.frombuffer(column, marks).reshape(-1, 2).astype(np.int64)


def stitch(
    chunks: list[tuple[bytes, bytes, bytes]], step: int, kind: np.dtype, marks: np.dtype = np.dtype(np.int64)
) -> np.ndarray | None:
    """The ids of a text from (ids, head, tail) of its chunks in order; None if two never agree."""
    parts, first = [], 0
    for number, (data, _, tail) in enumerate(chunks):
        ids = np.frombuffer(data, kind)
        if number + 1 == len(chunks):
            parts.append(ids[first:])
            break
        mine, theirs = _marks(tail, marks), _marks(chunks[number + 1][1], marks)
        _, here, there = np.intersect1d(mine[:, 0] - step, theirs[:, 0], return_indices=True)
        if not len(here):
            return None
        parts.append(ids[first : mine[here[0], 1]])
        first = theirs[there[0], 1]
    return np.concatenate(parts)


def frames(rows: Iterator[tuple], columns: list[str], weight: Callable[[tuple], int]) -> Iterator[pd.DataFrame]:
    """Rows in frames of bounded weight (and one row at least)."""
    some: list[tuple] = []
    held = 0
    for row in rows:
        some.append(row)
        held += weight(row) + 1
        if held >= FRAME:
            yield pd.DataFrame(some, columns=columns)
            some, held = [], 0
    if some:
        yield pd.DataFrame(some, columns=columns)


def _listed(_: Ranks, ids: np.ndarray) -> tuple:
    return (ids.astype(np.int32),)


def _digested(ranks: Ranks, ids: np.ndarray) -> tuple:
    decimal = ",".join(map(str, ids.tolist()))
    return (
        len(ids),
        hashlib.sha256(decimal.encode()).hexdigest(),
        hashlib.sha256(ranks.decode(ids)).hexdigest(),
    )


#: What becomes of a text's ids: columns, and their values.
LISTED = "ids array<int>", _listed
DIGESTED = "n_tokens long, ids_sha256 string, decoded_sha256 string", _digested


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


def _long(texts: DataFrame, held, step: int, overlap: int, made: tuple[str, Callable]) -> DataFrame:
    """(digest, agreed, made) of each distinct text of more than `step` characters."""
    columns, values = made
    names, marks = _names(columns), mark_kind(step + overlap)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (
            (digest, number, text[start : start + step + overlap], start + step + overlap >= len(text))
            for batch in batches
            for digest, text in zip(batch["digest"], batch["text"])
            for number, start in enumerate(range(0, len(text), step))
        )
        yield from frames(rows, ["digest", "number", "part", "complete"], lambda row: len(row[2]))

    def view(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ranks = _loaded(*held.value)
            rows = []
            for part, complete in zip(batch["part"], batch["complete"]):
                ids, head, tail = ranks.view(part, step, complete)
                head = head[head[:, 0] < overlap]
                rows.append((ids, head.astype(marks).tobytes(), tail.astype(marks).tobytes()))
            seen = pd.DataFrame(rows, columns=["ids", "head", "tail"])
            yield pd.concat([batch[["digest", "number"]], seen], axis=1)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = _loaded(*held.value)
        none = (False, *[None] * len(names))
        rows = (row for b in batches for row in zip(b["digest"], b["ids"], b["head"], b["tail"]))
        chunked = groupby(rows, itemgetter(0))
        texts = ((digest, stitch([chunk[1:] for chunk in chunks], step, ranks.kind, marks)) for digest, chunks in chunked)
        stitched = ((digest, *(none if ids is None else (True, *values(ranks, ids)))) for digest, ids in texts)
        yield from frames(stitched, ["digest", "agreed", *names], lambda row: np.size(row[2]))

    parts = texts.select("digest", "text").mapInPandas(cut, "digest string, number int, part string, complete boolean")
    once = parts.groupBy("digest", "number", "complete").agg(F.min("part").alias("part"))
    seen = once.mapInPandas(view, "digest string, number int, ids binary, head binary, tail binary")
    ordered = seen.repartition("digest").sortWithinPartitions("digest", "number")
    return ordered.mapInPandas(join, f"digest string, agreed boolean, {columns}")


def _encoded(
    docs: DataFrame, id_column: str, column: str, path: str | None, chunk: int, overlap: int, made: tuple[str, Callable]
) -> DataFrame:
    """(id, made) of every text."""
    columns, values = made
    names = _names(columns)
    overlap = min(overlap, chunk)
    held = _shared(docs, path)

    @F.pandas_udf(columns)
    def at_once(texts: pd.Series) -> pd.DataFrame:
        ranks = _loaded(*held.value)
        return pd.DataFrame([values(ranks, ranks.encode(t)) for t in texts], columns=names)

    text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    short = rows.filter(F.length("text") <= chunk).select("id", at_once("text").alias("made")).select("id", "made.*")
    long = rows.filter(F.length("text") > chunk).withColumn("digest", F.sha2("text", 256))
    done, left, step = [], long, chunk
    while True:
        found = stored(_long(left, held, step, overlap, made), "tokens")
        done.append(found.filter("agreed"))
        failed = found.filter("NOT agreed").select("digest")
        if failed.isEmpty():
            break
        left = long.join(failed, "digest", "left_semi")
        step, overlap = step * GROWTH, overlap * GROWTH
    for more in done[1:]:
        done[0] = done[0].union(more)
    return short.union(long.select("id", "digest").join(done[0], "digest").select("id", *names))


def encode(
    docs: DataFrame,
    id_column: str = "doc_id",
    column: str = "text",
    path: str | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(id, ids): the token ids of every text, as a list. The overlap is a chunk at most."""
    return _encoded(docs, id_column, column, path, chunk, overlap, LISTED)


def encode_digests(
    docs: DataFrame,
    id_column: str = "doc_id",
    column: str = "text",
    path: str | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text: `digests` of `encode`, without moving ids."""
    return _encoded(docs, id_column, column, path, chunk, overlap, DIGESTED)


def decode(tokens: DataFrame, column: str = "ids", path: str | None = None, into: str = "bytes") -> DataFrame:
    """`tokens` with the bytes that a list of ids stands for (null: none)."""
    held = _shared(tokens, path)

    @F.pandas_udf("binary")
    def bytes_of(lists: pd.Series) -> pd.Series:
        ranks = _loaded(*held.value)
        return pd.Series([b"" if ids is None else ranks.decode(ids) for ids in lists], dtype=object)

    return tokens.withColumn(into, bytes_of(F.col(f"`{column}`")))


def digests(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of encoded texts."""
    held = _shared(tokens, path)

    columns, values = DIGESTED

    @F.pandas_udf(columns)
    def made(lists: pd.Series) -> pd.DataFrame:
        ranks = _loaded(*held.value)
        return pd.DataFrame([values(ranks, ids) for ids in lists], columns=_names(columns))

    return tokens.select("id", made("ids").alias("made")).select("id", "made.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_digests(docs).withColumnRenamed("id", "doc_id")
