import math
from collections import defaultdict

import pytest

from lectern.llm.mixing import mix, resample

SCHEMA = "doc_id long, text string, source string, taken string"


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share, hold the ones above their bound, share the excess among the rest, again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return held | share
        held |= {s: most * sizes[s] for s in over}


def build(spark, rows):
    return spark.createDataFrame([(i, t, s, "x") for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("bucket_rows", [5000, 16])
def test_targets_copies_and_sums(spark, bucket_rows):
    rows, n = [], 0
    for source, docs in (("a", 40), ("b", 900), ("c", 30), ("Z", 5), ("é", 200), (None, 60)):
        for i in range(docs):
            rows.append((n, " ".join(["w"] * (1 + (i * 7) % 50)), source))
            n += 1
    got = mix(build(spark, rows), bucket_rows=bucket_rows).collect()
    assert len(got) == n
    sizes, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    expected = brute_targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], expected[s], rel_tol=1e-12)
        assert abs(taken[s] - target[s]) <= 50 * (1 if bucket_rows == 5000 else 12)
    again = mix(build(spark, rows[::-1]), bucket_rows=bucket_rows).collect()
    assert {r["doc_id"]: r["taken"] for r in got} == {r["doc_id"]: r["taken"] for r in again}


def test_defined_cases(spark):
    assert mix(build(spark, [])).count() == 0
    none = mix(build(spark, [(1, None, "a"), (2, "", None), (None, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in none] == [(0, 0.0, 0)] * 3
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "c", "s"), (2, "d " * 10_000, None)]
    out = mix(build(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    assert sorted(r["size"] for r in out.collect()) == [1, 2, 2, 10_000]
    mixed = resample(build(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source", "taken"]
    assert mixed.count() == sum(r["copies"] for r in out.collect() if r["copies"] > 0)
