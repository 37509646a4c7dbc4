import hashlib
import math
import random

import numpy as np
import pandas as pd

from lectern.llm import centroids

KIND = "vec_id long, embedding array<double>, cluster int"


def brute(rows, clusters, rounds, scale, dimension):
    """Full distances in Python integers; (id, cluster, distance) sorted, and the centroids."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) and abs(x) < 2.0**62 / scale for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    now = [v for _, v in sorted(kept, key=key)[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(rounds + 1):
        near = [min((far(v, c), k) for k, c in enumerate(now)) for _, v in kept]
        if step < rounds:
            for k in range(len(now)):
                own = [v for (_, v), (_, n) in zip(kept, near) if n == k]
                if own:
                    now[k] = [sum(c) // len(own) for c in zip(*own)]
    return sorted(((i, k, min(d, 2**63 - 1)) for (i, _), (d, k) in zip(kept, near)), key=str), now


def _rows(seed, count, dimension=6):
    pick = random.Random(seed)
    middles = [[pick.uniform(-2, 2) for _ in range(dimension)] for _ in range(5)]
    rows = [(i, [c + pick.gauss(0, 0.2) for c in pick.choice(middles)], 7) for i in range(count)]
    rows += [(pick.randrange(count), [0.5] * dimension, 7) for _ in range(count // 2)]  # one vector, repeated ids
    return rows


def _check(spark, rows, clusters=4, rounds=3, scale=64, dimension=6):
    got, last = centroids.cluster(spark.createDataFrame(rows, KIND), clusters, rounds, scale=scale, dimension=dimension)
    want = brute(rows, clusters, rounds, scale, dimension)
    assert (sorted(map(tuple, got.collect()), key=str), last) == want


def test_equals_full_distances(spark):
    for seed in range(3):
        _check(spark, _rows(seed, 120))


def test_unusable_rows_ties_and_fewer_rows_than_clusters(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [1.0, None], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [1.0], 0),
        (7, [1.0, 2.0, 3.0], 0), (8, [1e300, 0.0], 0), (None, [0.5, 0.5], 0), (9, [0.0, 0.0], 0), (9, [0.0, 0.0], 0),
        (10, [-0.001, 1.0], 0), (11, [1.0, 1.0], 0),
    ]
    _check(spark, rows, clusters=3, dimension=2)
    _check(spark, rows, clusters=50, dimension=2)
    _check(spark, rows[:8], clusters=3, dimension=2)
    _check(spark, rows[:0] or [(1, None, 0)], clusters=3, dimension=2)


def test_large_components_stay_exact(spark):
    pick = random.Random(5)
    rows = [(i, [pick.uniform(-1, 1) * 10.0 ** pick.randrange(0, 16) for _ in range(4)], 0) for i in range(60)]
    _check(spark, rows, clusters=5, dimension=4)


def test_bounds_spare_distances_and_never_change_the_nearest():
    pick = np.random.default_rng(3)
    middles = pick.integers(-2000, 2000, (12, 8))
    vectors = middles[pick.integers(0, 12, 3000)] + pick.integers(-20, 20, (3000, 8))
    pivots = centroids.pick_pivots(vectors[:500], 6)
    held = centroids.Centroids([r.tolist() for r in middles], pivots)
    number, best, measured = held.assign(vectors, centroids.roots(centroids.distances(vectors, pivots)))
    whole = centroids.distances(vectors, middles)
    assert (number == whole.argmin(axis=1)).all() and (best == whole.min(axis=1)).all()
    assert measured < 0.3 * vectors.shape[0] * len(middles)


def test_query_equals_its_sql(spark, tmp_path, twin):
    pick = random.Random(9)
    rows = [(i, [pick.gauss(0, 1) for _ in range(64)], 0) for i in range(150)]
    rows += [(200, [0.25] * 64, 0), (201, [0.25] * 64, 0), (202, None, 0), (203, [1.0], 0), (204, [float("nan")] * 64, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = centroids.query(spark, str(tmp_path))
    names = sorted(got.columns)
    want = twin(
        f"SELECT {', '.join(names)} FROM ({centroids.ORACLE_SQL})",
        embeddings=pd.DataFrame({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows]}),
    )
    assert sorted(map(tuple, got.select(names).collect()), key=str) == want
