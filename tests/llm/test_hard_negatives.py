import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lectern.llm import hard_negatives as hard

KIND = "vec_id long, embedding array<double>, label int, score long"


def brute(rows, every, positives=5, negatives=5, low=80, high=100, scale=256):
    kept = {}
    for i, v, label, _ in rows:
        if i is None or v is None or label is None:
            continue
        if all(x is not None and math.isfinite(x) and abs(x) < 2.0**62 / scale for x in v):
            row = (label, [math.floor(scale * x) for x in v])
            kept[i] = min(kept.get(i, row), row)
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    out = []
    for a, (label, own) in kept.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(own, v)), i, kind == label) for i, (kind, v) in kept.items() if i != a]
        scores.sort()
        for p, i, same in [s for s in scores if s[2]][:positives]:
            near = [(n, j) for n, j, kind in scores if not kind and low * -p <= 100 * -n <= high * -p][:negatives]
            out += [(a, i, k + 1, j, clip(-p), clip(-n)) for k, (n, j) in enumerate(near)]
    return sorted(out)


def _check(spark, rows, every=3, **options):
    frame = spark.createDataFrame(rows, KIND)
    got = hard.mine(frame, F.col("id") % every == 0, **options)
    want = brute(rows, every)
    assert sorted(map(tuple, got.collect())) == want
    return want


def _rows(seed, count, dimension, near):
    pick = random.Random(seed)
    middles = [[pick.gauss(0, 1) for _ in range(dimension)] for _ in range(4)]
    return [
        (i, [c + pick.gauss(0, near) for c in pick.choice(middles)], pick.randrange(3), 0) for i in range(count)
    ]


def test_equals_all_scores(spark):
    assert _check(spark, _rows(1, 150, 8, 0.2), references=4)
    assert _check(spark, _rows(2, 150, 16, 1.0), group_size=8)


def test_ties_repeated_rows_and_one_vector_on_a_third(spark):
    rows = _rows(3, 90, 4, 0.3)
    rows += [(100 + i, [0.5, 0.5, 0.25, 0.0], i % 2, 0) for i in range(60)] + rows[:20]
    rows += [(5, [1.0, 1.0, 1.0, 1.0], 0, 0), (300, [0.0] * 4, 1, 0), (303, [0.0] * 4, 2, 0)]
    assert _check(spark, rows)


def test_unusable_rows_other_lengths_and_large_components(spark):
    nan = float("nan")
    rows = _rows(4, 40, 4, 0.5) + [
        (60, None, 1, 0), (63, [1.0, None], 1, 0), (66, [nan], 1, 0), (69, [1.0], None, 0), (None, [1.0], 1, 0),
        (72, [], 1, 0), (75, [2.0], 1, 0), (78, [1.0] * 9, 2, 0), (81, [1e200], 0, 0),
    ]
    assert _check(spark, rows)
    big = [(i, [x * 10.0**15 for x in v], label, 0) for i, v, label, _ in rows[:40]]
    assert _check(spark, big)


def test_few_rows_and_empty_table(spark):
    assert _check(spark, [(0, [1.0], 1, 0)]) == []
    assert _check(spark, [(0, [1.0], 1, 0), (1, [1.0], 1, 0), (2, [0.9], 2, 0)]) == [(0, 1, 1, 2, 65536, 58880)]
    assert _check(spark, [(1, None, 1, 0)]) == []


def _batch(vectors, references, labels):
    length = hard.norms(vectors)
    lists = lambda rows: pa.array(list(rows))
    return pa.RecordBatch.from_pydict({
        "id": pa.array(range(len(vectors))), "label": pa.array(labels), "vec": lists(vectors),
        "norm": pa.array(length), "angles": lists(hard.angles(vectors, length, references)),
    })


def test_bounds_hold_and_spare_scores():
    pick = np.random.default_rng(1)
    middles = pick.normal(0, 300, (12, 6))
    vectors = np.floor(middles[np.sort(pick.integers(0, 12, 4000))] + pick.normal(0, 20, (4000, 6))).astype(np.int64)
    references = hard.pick_references(vectors[::40], 8)
    length = hard.norms(vectors)
    turned = hard.angles(vectors, length, references)
    for at in range(0, 4000, 400):
        least, most = hard.bounds(turned, turned, length, length, turned[at], length[at])
        true = vectors @ vectors[at]
        assert (least <= true).all() and (true <= most).all()
    labels = pick.integers(0, 3, 4000)
    rows = [{"id": int(i), "label": int(labels[i]), "vec": vectors[i].tolist()} for i in range(0, 4000, 100)]
    group = hard.Anchors(rows, references, True, 5)
    _, counts = group.scan(iter([_batch(vectors, references, labels)]))
    pairs = 40 * 4000 / 3
    assert counts[0] < pairs / 2 and counts[1] < pairs / 4


def test_query_equals_its_sql(spark, sf_dir, twin):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    got = hard.query(spark, sf_dir)
    names = sorted(got.columns)
    want = twin(f"SELECT {', '.join(names)} FROM ({hard.ORACLE_SQL})", embeddings=table)
    assert sorted(map(tuple, got.select(names).collect()), key=str) == want and want
