"""Language identification with string kernels.

Two texts are as alike as the n-grams (n from 1 to 4, of letters and word bounds) that
both hold at all: a blended-spectrum presence kernel. Landmark passages give a Nyström
map of it, in which one ridge regression per language is fitted, that language against
the rest. A batch of texts becomes a presence matrix over the landmarks' n-grams; its
product with the landmarks is the kernel, and that times the coefficients the scores.
A text's own norm would scale all its scores alike and is left out. The score is the
winner's share of the positive scores.

Fitting uses a bounded sample: PER_LANGUAGE labelled rows per language, those with the
smallest hashes, and of each a passage of at most PASSAGE characters from a place its
hash chooses, and a short one within it.
Predictions read whole texts. The model has a fixed size (landmarks, their n-grams and
a slot table) and is broadcast; texts are scored where they are, nothing is shuffled. A
task holds the characters of CHARACTERS-sized groups of texts at a time.

Defined cases: null text and text without a letter are `und` with score 0; a table
without labelled rows gives `und` throughout; null doc_id is not held out and not learned
from; repeated rows are scored alike; an empty table stays empty; added columns
(held_out, lang_pred, score) replace columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDERS = (1, 2, 3, 4)
SLOTS = 1 << 22
PER_LANGUAGE, PASSAGE, SHORT, LANDMARKS = 400, 1500, 60, 32
RIDGE = 1e-2
CHARACTERS, ROWS = 1 << 20, 256
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def codes_of(text: str | None) -> np.ndarray:
    """Lower-cased letters as code points, with one space for all between; empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint32)
    letter = np.concatenate([[False], letter, [False]])
    codes = np.where(letter, np.concatenate([[32], codes, [32]]), 32).astype(np.uint32)
    return codes[letter | np.concatenate([[True], letter[:-1]])]


def slots_of(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, slot) of all n-grams, by order."""
    with np.errstate(over="ignore"):
        value = np.zeros(len(codes), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if n > len(codes):
                return
            value = value[: len(codes) - n + 1] * np.uint32(0x01000193) ^ (
                codes[n - 1 :] + np.uint32(n)
            ) * np.uint32(0x9E3779B1)
            if n in ORDERS:
                mixed = (value ^ value >> np.uint32(15)) * np.uint32(0x85EBCA6B)
                yield n, (mixed >> np.uint32(10)).astype(np.int64)


def presence(codes: np.ndarray) -> np.ndarray:
    """The distinct n-grams of one text."""
    return np.unique(np.concatenate([np.zeros(0, np.int64), *(s for _, s in slots_of(codes))]))


class Model:
    """Landmark n-grams, kernel columns and coefficients; `predict` scores batches."""

    def __init__(self, languages: list[str], passages: list[np.ndarray], labels: np.ndarray, landmarks: list[int]):
        self.languages = languages
        sets = [presence(p) for p in passages]
        grams = np.unique(np.concatenate([sets[i] for i in landmarks]))
        self.column = np.full(SLOTS, -1, np.int32)
        self.column[grams] = np.arange(len(grams))
        held = np.zeros((len(landmarks), len(grams)), np.float32)
        for row, i in enumerate(landmarks):
            held[row, self.column[sets[i]]] = 1 / np.sqrt(len(sets[i]))
        self.landmarks = np.ascontiguousarray(held.T)
        rows = np.zeros((len(sets), len(landmarks)))
        for row, own in enumerate(sets):
            at = self.column[own]
            rows[row] = self.landmarks[at[at >= 0]].sum(0) / np.sqrt(len(own))
        within = rows[landmarks]
        value, vector = np.linalg.eigh((within + within.T) / 2)
        keep = value > 1e-6 * value[-1]
        root = vector[:, keep] / np.sqrt(value[keep])
        features = rows @ root
        targets = np.eye(len(languages))[labels]
        gram = features.T @ features + RIDGE * len(sets) * np.mean(value[keep]) / len(value) * np.eye(keep.sum())
        self.weights = (root @ np.linalg.solve(gram, features.T @ targets)).astype(np.float32)

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Positive scores of each language as shares, for texts as code points."""
        matrix = np.zeros((len(texts), self.landmarks.shape[0]), np.float32)
        codes = np.concatenate(texts)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        for n, slots in slots_of(codes):
            column = self.column[slots]
            row = owner[: len(slots)]
            whole = (column >= 0) & (row == owner[n - 1 :])
            matrix[row[whole], column[whole]] = 1
        raw = np.maximum((matrix @ self.landmarks) @ self.weights, 0).astype(np.float64)
        total = raw.sum(1, keepdims=True)
        return np.divide(raw, total, out=np.full_like(raw, 1 / raw.shape[1]), where=total > 0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
        group: list[tuple[int, np.ndarray]] = []
        size = 0

        def score():
            for (i, _), row in zip(group, self.scores([c for _, c in group])):
                best = int(row.argmax())
                names[i], shares[i] = self.languages[best], float(row[best])
            group.clear()

        for i, text in enumerate(texts):
            codes = codes_of(text)
            if not len(codes):
                continue
            if group and (size + len(codes) > CHARACTERS or len(group) == ROWS):
                score()
                size = 0
            group.append((i, codes))
            size += len(codes)
        if group:
            score()
        return names, shares


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, text) of the labelled rows to learn from, a bounded number per language."""
    usable = docs.filter(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()
    ).filter(F.col("text").rlike(r"\p{L}"))
    mark = F.xxhash64(F.col("doc_id").cast("string"))
    length = F.greatest(F.length("text") - PASSAGE + 1, F.lit(1))
    passage = F.substring(F.col("text"), (1 + F.pmod(mark, length)).cast("int"), F.lit(PASSAGE))
    chosen = (
        usable.select("lang", "doc_id", mark.alias("mark"), passage.alias("text"))
        .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id", "text")))
        .filter(F.col("n") <= per_language)
    )
    return chosen.orderBy("lang", "n").select("lang", "text")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model | None:
    """A model from the labelled rows of `docs` (doc_id, text, lang) that are not held out."""
    sample = training_sample(docs, per_language).toPandas()
    languages = sorted(sample["lang"].unique())
    passages, labels, chosen, seen = [], [], [], dict.fromkeys(languages, 0)
    for lang, text in zip(sample["lang"], sample["text"]):
        codes = codes_of(text)
        if not len(codes):
            continue
        if seen[lang] < landmarks and len(codes) > SHORT:
            chosen.append(len(passages))
            seen[lang] += 1
        middle = len(codes) // 2
        for part in (codes, codes[middle : middle + SHORT]):
            passages.append(part)
            labels.append(languages.index(lang))
    if not passages:
        return None
    return Model(languages, passages, np.array(labels), chosen or list(range(len(passages)))[:landmarks])


def identify(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, with held_out, lang_pred and score."""
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ("held_out", "lang_pred", "score")

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        names, shares = known.predict(list(texts)) if known else ([UNKNOWN] * len(texts), [0.0] * len(texts))
        return pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": pd.Series(shares, dtype=float)})

    kept = [f"`{c}`" for c in docs.columns if c not in added]
    return docs.withColumn("_said", predict(F.col(f"`{text}`"))).select(
        *kept, held_out(F.col("doc_id")).alias("held_out"), "_said.lang_pred", "_said.score"
    )


def drop_unidentified(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """`docs` without the rows that are no language, or whose score is below `least`.

    If no row can be learned from, only null texts and texts without a letter go.
    """
    model = fit(docs)
    if model is None:

        @F.pandas_udf("boolean")
        def lettered(texts: pd.Series) -> pd.Series:
            return pd.Series([len(codes_of(t)) > 0 for t in texts], dtype=bool)

        return docs.filter(lettered(F.col("text")))
    said = identify(docs.withColumn("_kept", F.struct(*[f"`{c}`" for c in docs.columns])), model)
    return said.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("_kept.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs, fit(docs)).select("doc_id", "held_out", "lang_pred", "score")
