import zlib

import numpy as np

from lectern.llm import language as L


def test_kernel_like_brute_force():
    def grams(text):
        text = " " + "".join(c if c.isalpha() else " " for c in text.lower()).strip() + " "
        text = " ".join(text.split(" ")) if "  " not in text else " " + " ".join(text.split()) + " "
        return {(n, text[i : i + n]) for n in L.ORDERS for i in range(len(text) - n + 1)}

    texts = ["The cat sat", "the CAT, ran!", "Ein Hund lief über", "über  den Hund 12"]
    sets = [L.presence(L.codes_of(t)) for t in texts]
    for a in range(4):
        for b in range(4):
            want = len(grams(texts[a]) & grams(texts[b]))
            assert len(np.intersect1d(sets[a], sets[b])) == want


def test_batched_scores_do_not_depend_on_the_batch(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.fit(docs)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(60).collect()]
    names, shares = model.predict(texts)
    for t, n, s in zip(texts, names, shares):
        one = model.predict([t])
        assert one[0] == [n] and abs(one[1][0] - s) < 1e-4


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = L.identify(docs).filter("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_defined_cases(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.fit(docs)
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 %%", "x"), (None, "the of and", "x"), (4, "que de la " * 100_000, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = L.identify(odd, model)
    assert out.columns == ["doc_id", "text", "held_out", "lang_pred", "score"]
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"]) for r in out.collect()}
    assert [got[i][1] for i in (1, 2, 3)] == ["und"] * 3
    assert got[None] == (False, "en") and got[4][1] in ("es", "fr")
    assert L.identify(odd.limit(0), model).count() == 0
    bare = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    assert L.identify(bare).first()["lang_pred"] == "und"
    kept = L.drop_unidentified(docs.withColumn("score", docs.doc_id))
    assert kept.columns == [*docs.columns, "score"] and kept.count() == docs.count()


def test_nothing_to_learn_from_drops_only_what_has_no_letter(spark):
    """No label at all, or every labelled row held out."""
    texts = ["the clean text", "ein anderer Text", "\u6587\u5b57", None, "", "12 %% .."]
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    bare = [(i, t, None) for i, t in enumerate(texts)]
    held = [(i, t, "en") for i, t in zip(out, texts)]
    for rows in (bare, held):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        assert L.fit(docs) is None
        assert sorted(map(tuple, L.drop_unidentified(docs).collect())) == sorted(rows[:3])
