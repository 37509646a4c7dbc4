"""Document fingerprints by winnowing, in DataFrame functions alone.

A text's grams are its runs of `gram` words (fewer words: all of them as one gram). The
words' hashes are made once, and rolled into the grams' hashes. Of each window of
`window` consecutive grams the one with the smallest hash (by its leading 34 bits) is
chosen, the rightmost on ties; the chosen hashes with their positions, each once, are
the fingerprint. Two texts that share window + gram - 1 words in a row share a chosen
hash. The window minima come from doubling, so the work per word is a logarithm of the
window.

Likeness of fingerprints is the Jaccard index of their distinct hashes; of two empty
ones it is 1.

`with_next` gives each document the next one by id, without a global sort: ids are cut
into buckets by quantiles, each bucket's first document is also put at the end of the
bucket before it, and a window function per bucket does the rest. Texts cross the network
once. The first rows' keys are broadcast, one for every BUCKET_ROWS documents.

Defined cases: null text is empty; a text without words has an empty fingerprint; null
ids come first, equal ids follow the hash of their texts, repeated rows follow each
other; a single document is its own next; an empty table stays empty; added columns
replace columns of the same names.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 5, 4
BUCKET_ROWS = 5_000
SPACE = r"[\x20\x09-\x0D]+"
PLACES = (1 << 30) - 1


def _runs(df: DataFrame, column: str, length: int, combine) -> DataFrame:
    """`column`: an array's elements; then of each run of `length` elements, by doubling.

    Each step is a column of its own, so that no step is worked out more than once.
    """
    have = 1
    while have < length:
        shift = min(have, length - have)
        left = F.greatest(F.size(column) - shift, F.lit(0))
        pair = F.zip_with(F.slice(column, F.lit(1), left), F.slice(column, F.lit(shift + 1), left), combine)
        df = df.withColumn(column, pair)
        have += shift
    return df


def winnow(df: DataFrame, text: str, into: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """`df` with the chosen hashes and positions of a text column: a struct of two arrays.

    A window's minimum is that of one number per gram, its hash's leading bits before its
    place counted down. The places' bits suffice for the longest string Spark can hold.
    """
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPACE)
    df = df.withColumn("_words", F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w)))
    many = F.size("_words") >= gram
    few = F.when(F.size("_words") > 0, F.array(F.xxhash64("_words"))).otherwise(
        F.array().cast("array<bigint>")
    )
    starts = F.slice("_words", F.lit(1), F.greatest(F.size("_words") - (gram - 1), F.lit(1)))
    each = F.transform(
        starts, lambda h, i: F.xxhash64(h, *[F.get("_words", i + j) for j in range(1, gram)])
    )
    df = df.withColumn("_grams", F.when(many, each).otherwise(few))
    ranked = F.transform(
        "_grams", lambda h, i: h.bitwiseAND(F.lit(~PLACES)).bitwiseOR(F.lit(PLACES) - i)
    )
    df = df.withColumn("_least", ranked)
    # Fewer grams than a window are one window.
    short = F.when(F.size("_grams").between(1, window - 1), F.array(F.array_min("_least")))
    df = _runs(df.withColumn("_short", short), "_least", window, lambda a, b: F.least(a, b))
    fresh = F.filter("_least", lambda x, i: (i == 0) | (F.get("_least", i - 1) != x))
    df = df.withColumn("_chosen", F.coalesce("_short", fresh))
    places = F.transform("_chosen", lambda x: (F.lit(PLACES) - x.bitwiseAND(F.lit(PLACES))).cast("int"))
    df = df.withColumn("_places", places)
    found = F.struct(
        F.transform("_places", lambda p: F.get("_grams", p)).alias("hashes"),
        F.col("_places").alias("positions"),
    )
    return df.withColumn(into, found).drop("_words", "_grams", "_least", "_short", "_chosen", "_places")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / F.greatest(every, F.lit(1)))


def hashes(chosen: Column) -> Column:
    return F.array_distinct(chosen["hashes"])


def digest(chosen: Column) -> Column:
    """A short name of a fingerprint: 128 bits of its hashes and positions."""
    parts = [F.lower(F.hex(F.xxhash64(chosen, F.lit(seed)))) for seed in (0, 1)]
    return F.concat(*[F.lpad(p, 16, "0") for p in parts])


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above the key, in two steps of square root size."""
    width = max(1, isqrt(len(bounds)))
    rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    if not rows:
        return F.lit(0)
    heads = F.lit([r[0] for r in rows])
    table = F.array(*[F.lit(r) for r in rows])
    row = F.size(F.filter(heads, lambda b: b <= key))
    inside = F.size(F.filter(F.get(table, row - 1), lambda b: b <= key))
    return F.when(key.isNull() | (row == 0), F.lit(0)).otherwise((row - 1) * width + inside)


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, compute=lambda df: df, lead=("text",)) -> DataFrame:
    """`docs` (doc_id, text), with `next_<c>` of the next document for each c in `lead`.

    `compute` adds columns after the texts have been dealt out; `lead` may name those.
    """
    rows = docs.count()
    buckets = -(-rows // bucket_rows)
    shares = [i / buckets for i in range(1, buckets)]
    found = (
        docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * buckets))).first()[0]
        if shares
        else []
    )
    placed = docs.select(
        "*",
        _bucket(F.col("doc_id"), sorted(set(found or []))).alias("_bucket"),
        F.xxhash64("text").alias("_tie"),
        F.lit(False).alias("_extra"),
    )
    firsts = placed.groupBy("_bucket").agg(F.min(F.struct(F.col("doc_id"), F.col("_tie"))).alias("k"))
    order = Window.orderBy("_bucket")
    behind = firsts.select(
        F.coalesce(F.lag("_bucket").over(order), F.max("_bucket").over(order.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"),
        F.col("_bucket").alias("_own"),
        F.col("k.doc_id").alias("_id"),
        F.col("k._tie").alias("_id_tie"),
    )
    same = (
        (F.col("_bucket") == F.col("_own"))
        & F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("_tie").eqNullSafe(F.col("_id_tie"))
    )
    extra = (
        placed.join(F.broadcast(behind), same)
        .dropDuplicates(["_bucket"])
        .withColumn("_bucket", F.col("_before"))
        .withColumn("_extra", F.lit(True))
        .select(*placed.columns)
    )
    dealt = compute(placed.union(extra).repartition("_bucket"))
    along = Window.partitionBy("_bucket").orderBy(
        "_extra", F.col("doc_id").asc_nulls_first(), F.col("_tie")
    )
    led = dealt.select("*", *[F.lead(c).over(along).alias(f"next_{c}") for c in lead])
    return led.filter(~F.col("_extra")).drop("_bucket", "_tie", "_extra")


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """All rows and columns of `docs`, with `fingerprint`: the chosen (hash, position)."""
    return winnow(docs.drop("fingerprint"), "text", "fingerprint", gram, window)


def edited_pairs(
    docs: DataFrame, gram: int = GRAM, window: int = WINDOW, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Per document its fingerprint, its edited text's and their likeness, and the next's."""

    def chosen(df: DataFrame) -> DataFrame:
        df = winnow(df, "text", "fingerprint", gram, window)
        return df.withColumn("own", hashes(F.col("fingerprint")))

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    led = with_next(texts, bucket_rows, chosen, ("text", "own"))
    length = F.length("text")
    cut = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), length - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    made = led.withColumn("edited", edited).withColumn("n_chars", length.cast("long"))
    made = winnow(made, "edited", "edited_fingerprint", gram, window)
    return made.withColumn("edited_own", hashes(F.col("edited_fingerprint"))).select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return edited_pairs(docs).select(
        "doc_id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("fingerprint")).alias("fingerprint"),
        digest(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
