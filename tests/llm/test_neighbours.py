import numpy as np
import pytest

from lectern.llm.neighbours import Polytopes, hadamard, nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, asked):
    ok = [(i, np.asarray(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, v in ok:
        if asked(i):
            near = sorted(((-float(np.multiply(v, w).sum()), j) for j, w in ok if j != i))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    return hits / sum(len(w) for w in want.values())


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_and_exact_scores(spark, scaled):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 24))
    x = centres[rng.integers(0, 20, 1500)] + 0.6 * rng.normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scaled:
        x *= rng.uniform(0.2, 5, (1500, 1))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collect(nearest(df, df.filter("vec_id % 20 = 0"), k=10, chunk=40))
    want = brute(rows, 10, lambda i: i % 20 == 0)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    score = {i: dict(brute(rows, 1500, lambda j: j == i)[i]) for i in (0, 20)}
    for i, all_scores in score.items():
        for j, s in got[i]:
            assert abs(all_scores[j] - s) < 1e-12
        assert [s for _, s in got[i]] == sorted((s for _, s in got[i]), reverse=True)


def test_equal_vectors_and_few_candidates(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(i, one) for i in range(60)] + [(100 + i, two) for i in range(3)] + [(200, [-1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collect(nearest(df, df.filter("vec_id % 20 = 0"), k=5))
    assert got == brute(rows, 5, lambda i: i % 20 == 0)
    small = df.filter("vec_id >= 100")
    assert collect(nearest(small, small, k=20)) == brute(rows[60:], 20, lambda i: True)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 0.0]),
        (6, []), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [0.5, 0.5]), (9, [-1.0, 0.25]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "1 AS rank")
    got = collect(nearest(df, df))
    assert got == brute([rows[0], rows[9], rows[10]], 20, lambda i: True)
    assert nearest(df.limit(0), df.limit(0)).count() == 0
    assert nearest(df, df.filter("vec_id = 1")).count() == 0


def test_rotations():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(hadamard(hadamard(x)), x)
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    pairs = Polytopes(3, 1.0, True, 2, 2)
    assert pairs.buckets == 64
    assert (pairs.probes(x[:, :3], 1, 5)[:, 0] == pairs.bucket(x[:, :3] / 10)[:, 1]).all()
