import random

import pytest
import xxhash

from lectern.llm.components import components
from lectern.llm.simhash import (
    block_count, block_plan, near_duplicates, near_links, one_of_each, share_of_bits, similar_documents,
)
from lectern.sources.scratch import stored

MASK = (1 << 64) - 1


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance=3):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(prints))]


def test_documents_like_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(20)]
    for base in list(texts[:6]):
        for _ in range(5):
            copy = base.split()
            copy[rng.randrange(200)] = "changed"
            texts.append(" ".join(copy))
    texts += [None, "", " \n", "One", "one", "ONE two", "a b c", "Ä b c", texts[0], texts[0].upper()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in near_duplicates(docs).collect()}
    prints = [brute_print(t) for t in texts]
    assert [got[i]["fingerprint"] & MASK for i in range(len(texts))] == prints
    classes = brute_classes(prints)
    assert [got[i]["component_id"] for i in range(len(texts))] == classes
    kept = one_of_each(docs.selectExpr("doc_id", "text", "1 AS component_id"), near_duplicates(docs))
    assert kept.columns == ["doc_id", "text", "component_id"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(classes))


@pytest.mark.parametrize("chunk,blocks", [(50_000, None), (7, 5), (3, 6)])
def test_bucket_search_keeps_all_classes(spark, chunk, blocks):
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(40):  # chains of close ones, and others further off
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])):
                at ^= 1 << bit
            prints.append(at)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "fingerprint long, rep long")
    found = {r["node"]: r["component"] for r in components(near_links(nodes, 3, chunk, blocks)).collect()}
    assert [found.get(i, i) for i in range(len(prints))] == brute_classes(prints)


def test_components_of_long_chains(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    links = [(a, b) for a, b in zip(order, order[1:])] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == {**{i: 0 for i in range(200)}, 500: 500, 501: 500}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_few_links_go_to_few_files(spark, conf, monkeypatch):
    """As many files as rows call for, not as many as there are shuffle partitions."""
    conf(spark__sql__shuffle__partitions="31", spark__sql__adaptive__coalescePartitions__enabled="false")
    kept = []

    def noted(df, *more):
        kept.append(stored(df, *more))
        return kept[-1]

    for module in ("simhash", "components"):
        monkeypatch.setattr(f"lectern.llm.{module}.stored", noted)
    monkeypatch.setattr("lectern.sources.scratch.ROWS", 250)
    texts = [" ".join(f"w{i // 4}x{n}" for n in range(150)) + f" end{i}" for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs.coalesce(1)).collect()}
    assert [got[i] for i in range(400)] == brute_classes([brute_print(t) for t in texts])
    assert len(set(got.values())) < 400
    assert len(kept) > 3
    assert [len(df.inputFiles()) for df in kept[:2]] == [1, 2]  # fingerprints, distinct ones
    assert max(len(df.inputFiles()) for df in kept[2:]) <= 16  # 4,000 links at most
    assert max(len(df.inputFiles()) for df in kept[3:]) <= 3  # as many links as were counted


def test_defined_cases(spark):
    empty = near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0
    docs = spark.createDataFrame([(None, "x"), (4, "x"), (4, "x"), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in near_duplicates(docs).collect())
    assert got == [(0, None), (2, 2), (4, 4), (4, 4)]
    assert sorted(r["doc_id"] or 0 for r in one_of_each(docs, near_duplicates(docs)).collect()) == [0, 2, 4]


def test_blocks_follow_the_number_of_fingerprints():
    assert block_count(10) == 5 and block_count(10**10) > 5


def test_similar_documents(spark):
    """Near copies are linked, texts with half their shingles in common are not."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioutrns") for _ in range(7))
    texts, kinds = [], []
    for kind in range(30):
        base = [word() for _ in range(300)]
        copies = [base]
        for edits in (1, 3, 5):
            copy = list(base)
            for at in rng.sample(range(300), edits):
                copy[at] = word()
            copies.append(copy)
        copies.append(base[:150] + [word() for _ in range(150)])  # shares half
        for n, copy in enumerate(copies):
            texts.append(" ".join(copy))
            kinds.append((kind, n == 4))
    texts += [texts[0], None, "", "a b", "b a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(docs, chunk=4).collect()}
    first = {}
    for i, k in enumerate(kinds):
        first.setdefault(k, i)
    wrong = [i for i, k in enumerate(kinds) if got[i] != first[k]]
    assert len(wrong) <= 2, wrong
    n = len(kinds)
    assert [got[i] for i in range(n, n + 5)] == [0, n + 1, n + 1, n + 3, n + 4]


def _edited(rng, word, n):
    """A text and its copies: (share of common shingles, copy)."""
    base = [word() for _ in range(n)]
    copies = []
    for part in (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3):
        more = max(1, round(n * part))
        copies.append(base + [word() for _ in range(more)])  # appended
        copies.append([word() for _ in range(more)] + base)  # put before
        copies.append(base[: n - more])  # cut short
        copies.append(base[more // 2 : n - more // 2])  # cut at both ends
        copy = list(base)
        for at in rng.sample(range(n), max(1, more // 5)):
            copy[at] = word()
        copies.append(copy)
    return base, copies


def _share(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a, b))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("options", [{}, {"elements": 100, "chunk": 20}])
def test_similar_documents_links_from_the_share_on(spark, options):
    """Additions, cuts and substitutions: linked from 0.8 on without a miss, not below."""
    rng = random.Random(21)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 3000}"
    pairs = []
    for n in (30, 60, 100, 300, 1000) * 4:
        base, copies = _edited(rng, word, n)
        pairs += [(_share(base, c), base, c) for c in copies]
    # Each pair by itself: its words are those of no other pair.
    docs = []
    for i, (_, a, b) in enumerate(pairs):
        for at, words in enumerate((a, b)):
            docs.append((2 * i + at, " ".join(f"{w}x{i}" for w in words)))
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(
        spark.createDataFrame(docs, "doc_id long, text string"), **options).collect()}
    linked = [got[2 * i] == got[2 * i + 1] for i in range(len(pairs))]
    assert [s for (s, *_), l in zip(pairs, linked) if s >= 0.8 and not l] == []
    assert sum(s >= 0.8 for s, *_ in pairs) > 200
    assert [s for (s, *_), l in zip(pairs, linked) if s < 0.8 and l] == []
    assert sum(0.65 <= s < 0.8 for s, *_ in pairs) > 50


def test_block_plan_bound():
    """The share of pairs at 0.8 that meet in no block is a millionth at most, at all sizes."""
    for texts in (0, 10, 10**5, 10**6, 10**7, 10**8):
        width, count = block_plan(texts)
        share = share_of_bits(0.8)
        assert (1 - (1 - share) ** width) ** (count * (64 // width)) <= 1e-6


def test_classes_follow_exact_links_only(spark):
    """A chain of texts, each alike only to its neighbours, is one class; what is near it is not."""
    rng = random.Random(3)
    words = [f"w{rng.getrandbits(40)}" for _ in range(1200)]
    chain = [words[at : at + 300] for at in range(0, 900, 30)]
    aside = [words[150:300] + [f"v{i}" for i in range(50)] + words[300:400]]
    docs = [(i, " ".join(w)) for i, w in enumerate(chain + aside)]
    assert max(_share(aside[0], c) for c in chain) < 0.8 <= min(_share(a, b) for a, b in zip(chain, chain[1:]))
    for elements in (10**6, 1000):
        frame = spark.createDataFrame(docs + [docs[5]], "doc_id long, text string")
        got = {r["doc_id"]: r["component_id"] for r in similar_documents(frame, elements=elements).collect()}
        assert got == {**{i: 0 for i in range(len(chain))}, len(chain): len(chain)}
