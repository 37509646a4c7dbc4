"""BPE encoding and decoding as bounded-lookahead streaming transducers.

Merges apply by rank. Two continuations of the same symbols can only differ in their
tokens near the end: at each rank the place up to which both agree moves left by the
left part of that merge at most, and only if the merge's right part begins with what
the move before left there. The longest such chain through the merge list is the
sufficient lookahead; a token that ends that far before the end of the read symbols is
stable and is emitted, and the symbols before it are forgotten. That needs a proper list
(every part is a symbol or made by an earlier merge, every token by one), which is
checked on loading.

The encoder reads a text in slices. Normalising, splitting into pieces and merging each
keep only a bounded rest: what a later character could still change (a piece at the end
of a slice, an apostrophe that may begin a contraction, the beginning of a special
token), and for a piece of any length the window of symbols above. Only an endless run of
combining marks, which NFC has to reorder as one, is held as a whole. The results of
short pieces are remembered up to a fixed number.

The decoder is a state machine over bytes: ids become bytes, and bytes become text as
soon as a character is complete; ill-formed bytes become U+FFFD.

Texts are independent: no shuffle, and tokenizer files travel as a broadcast of fixed
size. Defined cases: null text is empty, empty text has no ids; special tokens in a text
are single ids, as in the library; repeated rows are repeated; an empty table stays
empty; added columns replace columns of the same names.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE, WINDOW, LONG, REMEMBERED, KEPT_LISTS = 1 << 16, 4096, 256, 200_000, 100_000
TOKENIZER = "word_bpe_49k.json"
WORD_END = "</w>"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def composing() -> frozenset[str]:
    """Characters that may join the one before under NFC."""
    found = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A7, 0x11C3))}
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


class Bpe:
    """A tokenizer of the kind: NFC, lower case, split by a pattern, byte symbols, word ends."""

    def __init__(self, definition: str):
        read = json.loads(definition)
        model = read["model"]
        steps = [n["type"] for n in read["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("a tokenizer of another kind")
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.specials = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.specials.items()}
        self.ranks = {
            (self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b])
            for rank, (a, b) in enumerate(self.merges)
        }
        self.pair_ranks = {a << 20 | b: rank for (a, b), (rank, _) in self.ranks.items()}
        self.made = [self.vocab[a + b] for a, b in self.merges]
        self.symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(self.symbols)}
        self.inner = [self.vocab[s] for s in self.symbols]
        self.last = [self.vocab[s + WORD_END] for s in self.symbols]
        pattern = read["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern)
        self.runs = (regex.compile(r"[\p{L}]+"), regex.compile(r"[^\s\p{L}\p{N}]+"))
        marks = sorted(self.specials, key=len, reverse=True)
        self.special_marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self.remembered: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.known: dict[str, list[int]] = {}
        self.older_known: dict[str, list[int]] = {}
        self._check()

    def _check(self) -> None:
        made = set()
        for a, b in self.merges:
            for part in (a, b):
                if len(part.removesuffix(WORD_END)) > 1 and part not in made:
                    raise ValueError("a merge comes before its parts")
            if a + b in made:
                raise ValueError("two merges make the same token")
            made.add(a + b)

    @cached_property
    def lookahead(self) -> int:
        """How many symbols after a token's end decide it, at most."""
        left_of = {a + b: a for a, b in self.merges}
        reach: dict[str, int] = {}
        most = 0
        for a, b in self.merges:
            follow, token = 0, b
            while token:
                follow = max(follow, reach.get(token, 0))
                token = left_of.get(token)
            reach[a] = max(reach.get(a, 0), len(a) + follow)
            most = max(most, reach[a])
        return most

    @cached_property
    def named_bytes(self) -> dict[int, bytes]:
        return {i: name.encode() for i, name in self.names.items()}

    @cached_property
    def text_bytes(self) -> dict[int, bytes]:
        """What each id stands for, with a space after a word's end."""
        found = {}
        for i, name in self.names.items():
            if name in self.specials:
                found[i] = name.encode()
            else:
                own = bytes(self.byte_of[c] for c in name.removesuffix(WORD_END))
                found[i] = own + b" " * name.endswith(WORD_END)
        return found

    def merge(self, ids: list[int]) -> list[int]:
        """All merges, lowest rank and then leftmost first."""
        n = len(ids)
        if n < 2:
            return ids
        if n <= 40:
            pairs, made, none = self.pair_ranks.get, self.made, len(self.merges)
            ids = list(ids)
            ranks = [pairs(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
            while ranks and (best := min(ranks)) < none:
                at = ranks.index(best)
                ids[at] = made[best]
                del ids[at + 1], ranks[at]
                if at:
                    ranks[at - 1] = pairs(ids[at - 1] << 20 | ids[at], none)
                if at < len(ranks):
                    ranks[at] = pairs(ids[at] << 20 | ids[at + 1], none)
            return ids
        ranks = self.ranks
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            entry = ranks.get((ids[i], ids[j]))
            if entry is None or entry[0] != rank:
                continue
            ids[i], ids[j], after[i] = entry[1], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (ids[a], ids[b]) in ranks:
                    heapq.heappush(heap, (ranks[ids[a], ids[b]][0], a))
        return [t for t in ids if t >= 0]

    def piece(self, piece: str) -> list[int]:
        """The ids of a whole short piece. Of the pieces met the last ones are remembered."""
        ids = self.known.get(piece)
        if ids is None:
            ids = self.older_known.get(piece) or self.fresh_piece(piece)
            if len(self.known) >= KEPT_LISTS:
                self.older_known, self.known = self.known, {}
            if len(piece) <= 64:
                self.known[piece] = ids
        return ids

    def fresh_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "replace")
        return self.merge([*(self.inner[b] for b in data[:-1]), self.last[data[-1]]])

    def lower(self, text: str) -> str:
        """NFC and lower case, character by character (no final sigma)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Window:
    """The merges of one long piece, as its characters come."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.held = bpe, b""

    def push(self, piece: str) -> list[int]:
        """Ids that nothing later can change."""
        self.held += piece.encode("utf-8", "replace")
        out: list[int] = []
        while len(self.held) > WINDOW + self.bpe.lookahead + 1:
            part = self.held[: WINDOW + self.bpe.lookahead]
            stable, at = len(part) - self.bpe.lookahead, 0
            for token in self.bpe.merge([self.bpe.inner[b] for b in part]):
                size = len(self.bpe.names[token])
                if at + size > stable:
                    break
                out.append(token)
                at += size
            self.held = self.held[at:]
        return out

    def close(self) -> list[int]:
        data, self.held = self.held, b""
        if not data:
            return []
        return self.bpe.merge([*(self.bpe.inner[b] for b in data[:-1]), self.bpe.last[data[-1]]])


class Encoder:
    """Slices of a text in, ids out: `feed` each slice, then `close`."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.raw = ""  # not normalised yet
        self.rest = ""  # normalised, its last piece not ended
        self.run: tuple[regex.Pattern, Window] | None = None

    def feed(self, text: str) -> Iterator[list[int]]:
        self.raw += text
        cut = self._cut(self.raw)
        ready, self.raw = self.raw[:cut], self.raw[cut:]
        yield from self._sections(ready)

    def close(self) -> Iterator[list[int]]:
        ready, self.raw = self.raw, ""
        yield from self._sections(ready)
        yield from self._split("", True)

    def _cut(self, raw: str) -> int:
        """Where the text can be cut so that no later character changes what is before."""
        if not raw:
            return 0
        longest = max(map(len, self.bpe.specials), default=0)
        at = raw.rfind("<", max(0, len(raw) - longest))
        if at >= 0 and any(s.startswith(raw[at:]) for s in self.bpe.specials):
            return at
        at, joins = len(raw) - 1, composing()
        while at > 0 and (unicodedata.combining(raw[at]) or raw[at] in joins):
            at -= 1
        marks = self.bpe.special_marks
        for mark in marks.finditer(raw, max(0, at - longest)) if marks else ():
            if mark.start() < at < mark.end():
                return mark.end()
        return at

    def _sections(self, raw: str) -> Iterator[list[int]]:
        """Special tokens stand alone and end the piece before them."""
        at, marks = 0, self.bpe.special_marks
        for mark in marks.finditer(raw) if marks and "<" in raw else ():
            yield from self._split(self.bpe.lower(raw[at : mark.start()]), True)
            yield [self.bpe.specials[mark[0]]]
            at = mark.end()
        if at < len(raw):
            yield from self._split(self.bpe.lower(raw[at:]), False)

    def _split(self, text: str, ends: bool) -> Iterator[list[int]]:
        at = 0
        if self.run:
            pattern, window = self.run
            more = pattern.match(text)
            at = more.end() if more else 0
            yield window.push(text[:at])
            if at == len(text) and not ends:
                return
            yield window.close()
            self.run = None
        text = self.rest + text[at:]
        self.rest = ""
        found = [(m.start(), m.end()) for m in self.bpe.pieces.finditer(text)]
        keep = len(text)
        if not ends and found and found[-1][1] == len(text):
            keep = found[-1][0]
            if len(found) > 1 and found[-2][1] == keep and text[found[-2][0] : keep] == "'":
                keep = found[-2][0]
        for start, stop in found:
            if start < keep:
                yield self.bpe.piece(text[start:stop]) if stop - start <= LONG else self._whole(text[start:stop])
        if keep < len(text):
            last = text[keep:]
            if len(last) > LONG:
                pattern = next((p for p in self.bpe.runs if p.fullmatch(last)), None)
                if pattern:
                    self.run = (pattern, Window(self.bpe))
                    yield self.run[1].push(last)
                    return
            self.rest = last

    def _whole(self, piece: str) -> list[int]:
        window = Window(self.bpe)
        return window.push(piece) + window.close()


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    return (text[i : i + size] for i in range(0, len(text), size))


def encode(bpe: Bpe, texts: Iterable[str]) -> Iterator[list[int]]:
    """Lists of ids of one text that comes in slices."""
    encoder = Encoder(bpe)
    for part in texts:
        yield from encoder.feed(part)
    yield from encoder.close()


class Decoder:
    """Ids in, text out as soon as its characters are complete.

    `joined` is the text as the library gives it for a tokenizer without a decoder:
    token names with single spaces between them. Otherwise byte symbols become bytes and
    word ends become spaces.
    """

    def __init__(self, bpe: Bpe, joined: bool = True):
        self.bpe, self.joined, self.begun = bpe, joined, False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        if self.joined:
            data = b" ".join(map(self.bpe.named_bytes.__getitem__, ids))
            if data and self.begun:
                data = b" " + data
            self.begun = self.begun or bool(data)
        else:
            data = b"".join(map(self.bpe.text_bytes.__getitem__, ids))
        return self.state.decode(data)

    def close(self) -> str:
        return self.state.decode(b"", True)


def digests(bpe: Bpe, text: str | None) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids, SHA-256 of the decoded text."""
    text = text or ""
    if len(text) <= SLICE and not (bpe.special_marks and "<|" in text and bpe.special_marks.search(text)):
        return _short_digests(bpe, text)
    count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
    decoder = Decoder(bpe)
    for ids in encode(bpe, slices(text)):
        if ids:
            ids_hash.update((" " * (count > 0) + " ".join(map(str, ids))).encode())
            text_hash.update(decoder.feed(ids).encode())
            count += len(ids)
    text_hash.update(decoder.close().encode())
    return count, ids_hash.hexdigest(), text_hash.hexdigest()


def _short_digests(bpe: Bpe, text: str) -> tuple[int, str, str]:
    """The same for a text of one slice, from remembered pieces."""
    pieces = bpe.pieces.findall(bpe.lower(text))
    found = list(map(bpe.remembered.get, pieces))
    if None in found:
        found = [entry or _entry(bpe, piece) for entry, piece in zip(found, pieces)]
    ids, names = map(" ".join, zip(*found)) if found else ("", "")
    count = ids.count(" ") + 1 if ids else 0
    return count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(names.encode()).hexdigest()


def _entry(bpe: Bpe, piece: str) -> tuple[str, str]:
    """The ids and the decoded text of a piece. Of the pieces met the last ones are remembered."""
    entry = bpe.remembered.get(piece) or bpe.older.get(piece)
    if entry is None:
        ids = bpe.fresh_piece(piece) if len(piece) <= LONG else Encoder(bpe)._whole(piece)
        entry = (" ".join(map(str, ids)), Decoder(bpe).feed(ids))
    if len(piece) <= 64:
        if len(bpe.remembered) >= REMEMBERED:
            bpe.older, bpe.remembered = bpe.remembered, {}
        bpe.remembered[piece] = entry
    return entry


@lru_cache(maxsize=4)
def _loaded(definition: str) -> Bpe:
    return Bpe(definition)


def _definition(df: DataFrame, path: str | None):
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _ids_of(bpe: Bpe, text: str) -> np.ndarray:
    """All ids of a text, four bytes each."""
    return np.fromiter((i for ids in encode(bpe, slices(text)) for i in ids), np.int32)


def encode_column(docs: DataFrame, column: str = "text", path: str | None = None, into: str = "ids") -> DataFrame:
    """`docs` with the ids of a text column, as a list."""
    held = _definition(docs, path)

    @F.pandas_udf("array<int>")
    def ids_of(texts: pd.Series) -> pd.Series:
        bpe = _loaded(held.value)
        return pd.Series([_ids_of(bpe, t or "") for t in texts], dtype=object)

    return docs.withColumn(into, ids_of(F.col(f"`{column}`")))


def decode_column(
    docs: DataFrame, column: str = "ids", path: str | None = None, into: str = "decoded", joined: bool = False
) -> DataFrame:
    """`docs` with the text of a list of ids (null: empty)."""
    held = _definition(docs, path)

    @F.pandas_udf("string")
    def text_of(lists: pd.Series) -> pd.Series:
        bpe = _loaded(held.value)
        out = []
        for ids in lists:
            decoder = Decoder(bpe, joined)
            out.append(decoder.feed([] if ids is None else ids.tolist()) + decoder.close())
        return pd.Series(out, dtype=object)

    return docs.withColumn(into, text_of(F.col(f"`{column}`")))


def encode_digests(docs: DataFrame, column: str = "text", path: str | None = None) -> DataFrame:
    """`docs` with n_tokens, ids_sha256 and decoded_sha256 of a text column."""
    held = _definition(docs, path)
    added = ("n_tokens", "ids_sha256", "decoded_sha256")

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def made(texts: pd.Series) -> pd.DataFrame:
        bpe = _loaded(held.value)
        return pd.DataFrame([digests(bpe, t) for t in texts], columns=list(added))

    kept = [f"`{c}`" for c in docs.columns if c not in added]
    return docs.withColumn("_made", made(F.col(f"`{column}`"))).select(
        *kept, *[F.col(f"_made.{c}").alias(c) for c in added]
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
