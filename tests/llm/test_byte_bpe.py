import base64
import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken

from lectern.llm import byte_bpe


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as file:
        return byte_bpe.Ranks(file.read(), public_tokenizers.PATTERN)


def _texts(seed, count=150):
    pick = random.Random(seed)
    words = ["hello", "  ", " ", "\n", "\n \n", "'re", "'r", "'", "''", "ll", "été", "日本語", "123", "4567", "!?", "\t", " ", "\U0001f600", "don't"]
    return ["".join(pick.choice(words) for _ in range(pick.randrange(0, 120))) for _ in range(count)]


def test_merges_equal_the_library(ranks, library):
    for text in [*_texts(1), "a" * 5000, "ab" * 999, "́" * 300]:
        assert ranks.encode(text).tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("step,overlap", [(12, 9), (24, 16), (40, 11)])
def test_stitched_chunks_equal_the_whole(ranks, library, step, overlap):
    agreed = 0
    for text in _texts(step, 400):
        starts = range(0, max(1, len(text)), step)
        views = [ranks.view(text[s : s + step + overlap], step, s + step + overlap >= len(text)) for s in starts]
        chunks = [(i, h[h[:, 0] < overlap].tobytes(), t.tobytes()) for i, h, t in views]
        ids = byte_bpe.stitch(chunks, step, ranks.kind)
        if ids is not None:
            agreed += len(starts) > 1
            assert ids.tolist() == library.encode_ordinary(text)
    assert agreed > 20


def test_cases_at_chunk_ends(spark, library):
    texts = [None, "", "x", " ", "a" * 900, "word " * 300, " " * 500 + "x", "it's we're they've " * 40, "\n" * 64, "日本" * 200]
    texts += _texts(3, 60) + ["same long text, " * 50] * 40
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    for chunk, overlap in ((32, 16), (64, 8)):
        got = {r["id"]: r["ids"] for r in byte_bpe.encode(docs, chunk=chunk, overlap=overlap).collect()}
        assert got == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_repeated_rows_round_trip_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc " * 50), (1, "abc " * 50), (None, "abc " * 50), (None, None)], "doc_id long, text string")
    coded = byte_bpe.decode(byte_bpe.encode(docs, chunk=64, overlap=16))
    rows = sorted((r["id"] or 0, bytes(r["bytes"])) for r in coded.collect())
    assert rows == [(0, b""), (0, b"abc " * 50), (1, b"abc " * 50), (1, b"abc " * 50)]
    assert byte_bpe.digests(byte_bpe.encode(docs.limit(0))).collect() == []


def test_query_equals_the_library(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert max(map(len, texts.values())) > byte_bpe.CHUNK
    for row in byte_bpe.query(spark, sf_dir).collect():
        text = texts.pop(row["doc_id"])
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert not texts


def test_short_and_long_merges_agree(ranks):
    pick = random.Random(8)
    for _ in range(500):
        data = bytes(pick.choice(b"abcdeth \xc3\xa9\xe6\x97") for _ in range(pick.randrange(1, 40)))
        assert ranks.merged_short(data) == ranks.merged(data)


def test_digests_move_no_ids(spark, library, monkeypatch):
    """Long texts, of which some chunks agree at once and some in a second round, send and store no lists of ids."""
    kept = []
    monkeypatch.setattr(byte_bpe, "stored", lambda df, purpose, put=byte_bpe.stored: kept.append(df) or put(df, purpose))
    texts = [None, "", "x", "a" * 900, "word " * 300, "it's we're they've " * 40, "日本" * 200, *["copied long text, " * 50] * 9]
    texts += _texts(5, 40)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    made = byte_bpe.encode_digests(docs, chunk=32, overlap=16)
    got = {r["id"]: tuple(r)[1:] for r in made.collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        decimal = ",".join(map(str, ids)).encode()
        assert got[i] == (len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert len(kept) > 1
    assert not [c for df in [*kept, made] for c, kind in df.dtypes if kind.startswith("array")]
    assert "ids#" not in made._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("seen,size", [(byte_bpe.CHUNK + byte_bpe.OVERLAP, 2), (1 << 14, 4), (1 << 30, 8)])
def test_boundaries_fit_their_numbers(ranks, library, seen, size):
    """In the worst case a character is four ids; chunks stitch by numbers of that size as by others."""
    kind = byte_bpe.mark_kind(seen)
    assert kind.itemsize == size and 4 * seen <= np.iinfo(kind).max
    text = "one two " * 30
    views = [ranks.view(text[s : s + 56], 40, s + 56 >= len(text)) for s in range(0, len(text), 40)]
    chunks = [(i, h[h[:, 0] < 16].astype(kind).tobytes(), t.astype(kind).tobytes()) for i, h, t in views]
    assert byte_bpe.stitch(chunks, 40, ranks.kind, kind).tolist() == library.encode_ordinary(text)
