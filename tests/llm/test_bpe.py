import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lectern.llm import bpe as B

PATH = public_tokenizers.path(B.TOKENIZER)
TOKEN = Tokenizer.from_file(PATH)
ODD = [
    "", " ", "\n\t", "Hello World", "don't they're I'VE 'sx ''s !'s x'l l'll 12 3a ½ ²", "ΣΑΣ Σας İstanbul ẞ",
    "é ạ̈ 각 ொ", "<|endoftext|>x<|startoftext|>", "a<|endoftext", "<|endoftext|",
    "日本語テキスト", "😀👍🏽 !!!???...", "  x\x85y\x1cz", "à" * 50, "<|endoftext|≯", "x" * 700, "ab" * 3000,
    "the" * 4000 + "s", "!" * 5000 + "'s", "ñ" * 2000 + "<|endoftext|>" + "é" * 900, "ing" * 2500 + " end", "<" * 40 + "<|endoftext|>",
]


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, encoding="utf-8") as file:
        return B.Bpe(file.read())


def library(text):
    return TOKEN.encode(text, add_special_tokens=False).ids


def streamed(bpe, text, size):
    return [i for ids in B.encode(bpe, B.slices(text, size)) for i in ids]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 5000, 1 << 16])
def test_slices_like_the_library(bpe, size):
    for text in ODD:
        assert streamed(bpe, text, size) == library(text), text[:40]


def test_random_texts_like_the_library(bpe):
    rng = random.Random(1)
    signs = "aeinrsthEIS  '\n.,!0<|>éèñß́̈Σ日😀" + "".join(map(chr, range(0x1100, 0x1110)))
    for _ in range(300):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(200)))
        want = library(text)
        assert streamed(bpe, text, rng.choice([1, 5, 50])) == want
        count, ids, decoded = B.digests(bpe, text)
        assert count == len(want)
        assert ids == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        said = TOKEN.decode(want, skip_special_tokens=False)
        assert decoded == hashlib.sha256(said.encode()).hexdigest()


def test_small_windows_need_the_lookahead(bpe, monkeypatch):
    monkeypatch.setattr(B, "WINDOW", 40)
    rng = random.Random(4)
    for _ in range(40):
        text = "".join(rng.choice("aeinrsth") for _ in range(3000))
        assert streamed(bpe, text, 100) == library(text)


def test_constant_memory(bpe):
    encoder = B.Encoder(bpe)
    for _ in range(50):
        list(encoder.feed("thingstion" * 2000))
        assert len(encoder.raw) + len(encoder.rest) + len(encoder.run[1].held) < B.WINDOW + bpe.lookahead + 20_001


def test_decoder_is_incremental(bpe):
    text = "naïve 日本語 😀 x"
    ids = library(text)
    decoder = B.Decoder(bpe, joined=False)
    parts = [decoder.feed([i]) for i in ids]
    assert "".join(parts) + decoder.close() == text + " "
    assert "" in parts and "�" not in "".join(parts)
    broken = B.Decoder(bpe, joined=False)
    assert broken.feed(ids[-8:-7]) + broken.close() is not None


def test_columns(spark):
    rows = [(i, t, "c") for i, t in enumerate(ODD)] + [(None, None, "c"), (1, "x", None), (1, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = B.encode_digests(docs)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in out.collect():
        want = library(r["text"] or "")
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    turned = B.decode_column(B.encode_column(docs.filter("doc_id < 5"))).collect()
    assert all(r["decoded"].replace(" ", "") == "".join(r["text"].lower().split()) for r in turned)
    assert B.encode_digests(docs.limit(0)).count() == 0
