"""The pipeline's stages, each held against brute force over its own input."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.sources.scratch import stored


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The input and output rows of each stage, over the small documents and odd rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    copy = first["text"].split(" ")
    copy[5] = "changedword"
    odd = [
        (9000, None, "en", "src0", 0), (9001, "", "en", "src1", 0), (9002, "12 %% \n ..", None, "src1", 9),
        (9003, first["text"], first["lang"], "src2", first["n_chars"]),
        (9004, " ".join(copy), first["lang"], None, 1),
    ]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    out = []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, sf_dir), name)
        if name != "bpe":
            assert result.columns == docs.columns
        out.append((name, docs.collect(), result.collect()))
        docs = result
    return {name: (before, after) for name, before, after in out}


def test_language_id_drops_what_has_no_letter(stages):
    before, after = stages["language_id"]
    want = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
    assert Counter(after) == Counter(want) and len(want) == len(before) - 3


def test_line_dedup(stages):
    from test_line_dedup import brute

    before, after = stages["line_dedup"]
    texts = {r["doc_id"]: t for r, (_, t) in zip(before, brute([r["text"] for r in before], 10))}
    assert {r["doc_id"]: r["text"] for r in after} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in after) and len(after) == len(before)


def test_near_dedup(stages):
    before, after = stages["near_dedup"]

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    like = lambda a, b: len(a & b) / max(1, len(a | b))
    for low, exact in ((0.8, False), (0.6, True)):
        parent = {i: i for i in sets}
        for i in sets:
            for j in sets:
                if i < j and like(sets[i], sets[j]) >= low:
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
        firsts = {root(i) for i in sets}
        kept = {r["doc_id"] for r in after}
        # All that 0.8 links is one document; nothing that 0.6 does not link goes.
        assert kept >= firsts if exact else len(kept - firsts) <= 1
    assert {r["doc_id"]: r for r in after}.items() <= {r["doc_id"]: r for r in before}.items()


def test_mix(stages):
    from test_mixing import brute_targets

    before, after = stages["mix_sources"]
    size = lambda r: len(r["text"].split())
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r["source"]] += size(r)
        largest[r["source"]] = max(largest[r["source"]], size(r))
    for r in after:
        taken[r["source"]] += size(r)
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= largest[source]
    assert max(Counter(after).values()) <= 3 and set(after) <= set(before)


def test_bpe(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in before}
    assert len(after) == len(before)
    for r in after:
        assert r["ids"] == ids[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
        assert r["text"].split() == [
            w for w in library.decode(r["ids"]).replace("</w>", "\0").replace(" ", "").split("\0") if w
        ] or not r["text"].isascii()


def test_run_is_its_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "lang", "source", "text", "n_chars", "n_tokens", "ids"]
    again = corpus_pipeline.run(spark, sf_dir)
    count = lambda df: Counter((r["doc_id"], r["n_tokens"]) for r in df.collect())
    assert count(rows) == count(again)
