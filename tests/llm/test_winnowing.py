import random

import pytest
from pyspark.sql import functions as F

from lectern.llm.winnowing import PLACES, digest, edited_pairs, fingerprints, winnow

TEXTS = [
    None, "", " \n\t", "one", "One two three four", "one two three four five", "a b c d e f g h",
    "x " * 500, "same same\x0bsame same same same same same same same same same",
    "naïve Ünïcode 😀 wörds in a row that go on and on and on and on", "t " + "long word list " * 20_000,
]


def brute(spark, text, gram, window):
    """Chosen (hash, position) by trying every window."""
    words = (text or "").lower().translate({c: " " for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    one = lambda *cols: spark.range(1).select(F.xxhash64(*cols)).first()[0]
    known = {w: one(F.lit(w)) for w in set(words)}
    h = [known[w] for w in words]
    if not h:
        return []
    runs = [h[i : i + gram] for i in range(len(h) - gram + 1)]
    if runs:
        rows = spark.createDataFrame([(i, *r) for i, r in enumerate(runs)])
        grams = [r[0] for r in rows.orderBy("_1").select(F.xxhash64(*rows.columns[1:])).collect()]
    else:
        grams = [spark.createDataFrame([(h,)], "a array<bigint>").select(F.xxhash64("a")).first()[0]]
    width = min(window, len(grams))
    chosen = set()
    for start in range(len(grams) - width + 1):
        chosen.add(min(range(start, start + width), key=lambda i: (grams[i] & ~PLACES, -i)))
    return [(grams[i], i) for i in sorted(chosen)]


@pytest.mark.parametrize("gram,window", [(5, 4), (3, 5), (1, 1), (2, 7)])
def test_like_brute_force(spark, gram, window):
    rng = random.Random(7)
    texts = TEXTS[:-1] + [" ".join(rng.choice("abcd") for _ in range(rng.randrange(60))) for _ in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in fingerprints(docs, gram, window).collect():
        got = list(zip(r["fingerprint"]["hashes"], r["fingerprint"]["positions"]))
        assert got == brute(spark, r["text"], gram, window), r["text"]


@pytest.mark.parametrize("bucket_rows", [1000, 3, 1])
def test_edited_texts_and_next(spark, bucket_rows):
    ids = [50, 3, 3, 17, None, 8, 8, -4, 99, 1, 2]
    rows = list(zip(ids, TEXTS)) + [(8, "one"), (8, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = edited_pairs(docs, bucket_rows=bucket_rows).collect()
    tie = {r["text"]: r["h"] for r in docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()}
    order = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    want = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        cut = len(text) // 4
        want.append((i, len(text), text[: len(text) - cut] + following[:cut]))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited"]) for r in got), key=str) == sorted(want, key=str)
    prints = {r["text"] or "": r["fingerprint"] for r in fingerprints(docs).collect()}
    edited = spark.createDataFrame([(r["edited"],) for r in got], "text string")
    prints |= {r["text"]: r["fingerprint"] for r in winnow(edited, "text", "fingerprint").collect()}

    def like(a, b):
        a, b = set(a["hashes"]), set(b["hashes"])
        return len(a & b) / len(a | b) if a | b else 1.0

    after = {}
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        after.setdefault((i, len(text)), []).append(like(prints[text], prints[following]))
    for r in got:
        assert r["near_edited"] == like(r["fingerprint"], prints[r["edited"]])
        assert r["near_next"] in after[r["doc_id"], r["n_chars"]]


def test_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, fingerprint string")
    out = fingerprints(docs)
    assert out.columns == ["doc_id", "text", "fingerprint"]
    assert len(out.select(digest(F.col("fingerprint"))).first()[0]) == 32
    one = edited_pairs(docs).first()
    assert one["near_next"] == 1.0
    assert edited_pairs(docs.limit(0)).count() == 0


def test_match_guarantee(spark):
    rng = random.Random(9)
    shared = " ".join(f"s{i}" for i in range(8))  # window + gram - 1 words
    texts = [" ".join(f"{k}{rng.random()}" for _ in range(30)) + f" {shared} " + " ".join(f"{k}{rng.random()}" for _ in range(30)) for k in "ab"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    a, b = [set(r["fingerprint"]["hashes"]) for r in fingerprints(docs).collect()]
    assert a & b


def test_native(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = edited_pairs(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
