import random

import pytest

from lectern.llm.repeats import counting, marked_suffixes, query, repeated_spans

SCHEMA = "doc_id long, text string, begin string"


def brute(rows, words, distinct=1):
    """Every window of that many words which two documents have, joined to spans."""
    seen, split = {}, {}
    for i, text in rows:
        if i is None:
            continue
        split.setdefault(i, []).append((text or "").split())
    for i, texts in split.items():
        for ws in texts:
            for s in range(len(ws) - words + 1):
                seen.setdefault(tuple(ws[s : s + words]), set()).add(i)
    out = set()
    for i, texts in split.items():
        marked = sorted({s for ws in texts for s in range(len(ws) - words + 1)
                         if len(seen[tuple(ws[s : s + words])]) > 1
                         and len(set(ws[s : s + words])) >= distinct})
        spans = []
        for s in marked:
            if spans and s <= spans[-1][1] + words:
                spans[-1][1] = s
            else:
                spans.append([s, s])
        out |= {(i, a, b - a + words) for a, b in spans}
    return out


@pytest.mark.parametrize("hot", [4000, 3, 0])
def test_like_brute_force(spark, hot):
    rng = random.Random(2)
    fresh = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    passages = [fresh(n) for n in (19, 20, 21, 35, 120)]
    rows = []
    for i in range(60):
        parts = []
        for p in rng.sample(passages, rng.randrange(3)):
            parts += fresh(rng.randrange(40)) + p
        rows.append((i, " ".join(parts + fresh(rng.randrange(60)))))
    rows += [(100, rows[3][1]), (101, rows[3][1] + " tail"), (102, None), (103, ""), (None, rows[4][1])]
    twice = " ".join(fresh(30))
    rows += [(104, f"{twice} x {twice}"), (105, "a " * 200), (106, "a " * 70), (107, " ".join(passages[4][:60] + ["z"] + passages[4][61:]))]
    rows += [(108, " ".join(fresh(40_000) + passages[3]))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = repeated_spans(docs, words=20, gram=7, hot=hot).collect()
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in got} == brute(rows, 20)
    assert len(got) == len({(r["doc_id"], r["start_word"]) for r in got})
    assert all(r["first_doc_id"] <= r["doc_id"] for r in got)


def test_defined_cases(spark):
    assert repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(map(str, range(60)))
    same = spark.createDataFrame([(1, text, "x"), (1, text, "y"), (None, text, "z")], SCHEMA)
    assert repeated_spans(same).count() == 0
    two = spark.createDataFrame([(1, text, "x"), (2, text, "y"), (3, " ".join(map(str, range(49))), "")], SCHEMA)
    assert sorted(map(tuple, repeated_spans(two).collect())) == [(1, 0, 60, 1), (2, 0, 60, 1)]


def test_a_gram_repeated_inside_texts_is_frequent(spark):
    """Few texts with many suffixes of one gram: they are not brought together in one task."""
    rows = [(i, "a " * (150 + i)) for i in range(6)] + [(9, "b c " * 90), (10, "x b c " + "b c " * 70)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    hot = 50
    every = marked_suffixes(docs, 20, 7, hot)
    few, frequent = every.filter("NOT hot"), every.filter("hot")
    assert all(r["count"] <= hot for r in few.groupBy("gram").count().collect())
    assert frequent.count() > 6 * 100
    got = repeated_spans(docs, words=20, gram=7, hot=hot).collect()
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in got} == brute(rows, 20)


@pytest.mark.parametrize("hot", [4000, 0])
def test_filler_is_no_passage(spark, hot):
    """Windows of few different words do not count, alone or beside a passage."""
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    passage, mixed = fresh(25), [*fresh(12), *["no"] * 30, *fresh(12)]
    rows = [(i, "no " * (60 + i)) for i in range(4)]
    rows += [(10 + i, " ".join([*["no"] * 40, *passage, *["so"] * 40, *fresh(5)])) for i in range(3)]
    rows += [(20 + i, " ".join(fresh(i) + mixed)) for i in range(3)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = repeated_spans(docs, words=20, gram=7, hot=hot, distinct=6).collect()
    found = {(r["doc_id"], r["start_word"], r["n_words"]) for r in got}
    assert found == brute(rows, 20, 6)
    assert found and all(r["doc_id"] >= 10 for r in got)


def test_counting_windows():
    import numpy as np

    rng = random.Random(5)
    for n in (0, 3, 4, 5, 60):
        ws = [rng.randrange(5) for _ in range(n)]
        expected = [len(set(ws[s : s + 4])) >= 3 for s in range(n - 3)]
        assert counting(np.array(ws, np.uint64), 4, 3).tolist() == expected


def test_the_query_leaves_no_passage_out(spark, tmp_path):
    """Passages of one, two and nine different words count like any other."""
    texts = ["no " * 60, "a b " * 30, " ".join(f"w{i % 9}" for i in range(70))]
    rows = [(2 * i + j, t) for i, t in enumerate(texts) for j in range(2)] + [(9, "alone")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = query(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in got} == brute(rows, 50)
    assert {r["doc_id"] for r in got} == set(range(6))
