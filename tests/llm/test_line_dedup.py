import pytest

from lectern.llm import line_dedup
from lectern.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string, kept int, n_lines string"


def brute(texts, min_docs, min_chars=1):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    split = [(t or "").split("\n") for t in texts]
    seen = {}
    for lines in split:
        for k in {key(x) for x in lines}:
            seen[k] = seen.get(k, 0) + 1
    gone = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_chars}
    return [(len(ls), "\n".join(x for x in ls if key(x) not in gone)) for ls in split]


TEXTS = (
    [f"Shared Line\nown {i}\n\n shared line\t" for i in range(12)]
    + [None, "", "\n", "ÄShared", "äshared", "x\u00a0", "last\n", "SHARED LINE"]
    + ["same text\nagain"] * 5
    + ["word\n" * 3000 + "end"]
)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("shard_keys", [1, 1000])
def test_like_brute_force(spark, broadcast_bytes, shard_keys):
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(TEXTS)], SCHEMA)
    out = dedup_lines(docs, 3, shard_keys=shard_keys, broadcast_bytes=broadcast_bytes)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped", "kept"]
    found = [(r["n_lines"], r["kept"]) for r in out.orderBy("doc_id").collect()]
    assert found == brute(TEXTS, 3)


def test_empty_table_and_repeated_rows(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a\nb")] * 3 + [(None, "b")], "doc_id long, text string")
    out = dedup_lines(docs, 4).select("doc_id", "kept").collect()
    assert sorted(map(tuple, out), key=str) == sorted([(1, "a")] * 3 + [(None, "")], key=str)


def test_perfect_hash_is_minimal():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64))
    index = line_dedup.PerfectHash(keys)
    assert sorted(index.numbers(keys)) == list(range(len(keys)))
    bits = sum(64 * len(words) for _, words, _ in index.levels)
    assert bits < 5 * len(keys)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_a_line_of_very_many_documents(spark, broadcast_bytes):
    """Counts do not saturate: 70,000 documents are as many as asked for, 70,001 are not."""
    docs = spark.range(70_000).selectExpr("id doc_id", "concat('own ', id, chr(10), 'shared') text")
    for min_docs, dropped in ((70_000, 70_000), (70_001, 0)):
        out = dedup_lines(docs, min_docs, broadcast_bytes=broadcast_bytes)
        assert out.agg({"n_dropped": "sum"}).first()[0] == dropped
