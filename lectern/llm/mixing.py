"""Mixing sources to target weights by systematic sampling.

Sources get shares of all words by weight, held below a multiple of what they have.
Within a source every document has the same expected number of copies; the running
sum of those, moved by one random offset per source, crosses so many integers at a
document as the mix holds copies of it. All of it is DataFrame functions.

Large data: the running sum never walks a source in one task. Documents are dealt to
buckets by their id; a document's rank is its place in its bucket plus the rows of the
buckets before. Only counts per (source, bucket) are summed along a source, and only
counts per source along all sources. Rows cross the network once. Within a bucket
documents run from long to short, so that neighbours in the sum weigh alike and a
source's words stay near its target: off by about its longest document at most for
each bucket, with signs that cancel.

Defined cases: null text is size 0 and takes nothing, whatever its copies; a null
source is a source of its own, the last; an empty table or one without words gives
targets 0; repeated rows are documents of their own, ranked among equals in any order;
names of the added columns replace columns of the same name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
# Fixed values of the query: weights by place in code point order, and the most copies.
WEIGHTS, MOST, SEED = (5, 2, 1), 3, "7"
BUCKET_ROWS = 5_000
#: Offsets are multiples of 2**-20, so that a whole number of expected copies is met exactly.
STEPS = 1 << 20


def _hex(text: Column, digits: int) -> Column:
    """The first digits of the text's MD5, as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most=MOST) -> DataFrame:
    """Target words per source; `sizes` has one row per source with source_size.

    The water level is the largest of the levels that come of holding the first k
    sources, by what they can give per weight, at their bound.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = reduce(
        lambda other, i: F.when(place == i, F.lit(weights[i])).otherwise(other),
        range(len(weights)),
        F.lit(None).cast("int"),
    )
    ranked = sizes.withColumn("weight", weight)
    bound = most * F.col("source_size")
    by_need = Window.orderBy(bound / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    held = F.coalesce(F.sum(bound).over(before), F.lit(0))
    left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumn(
        "level", (F.sum("source_size").over(every) - held).cast("double") / left
    )
    target = F.least(
        bound.cast("double"), F.max("level").over(every) * F.col("weight").cast("double")
    )
    return level.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """All rows and columns of `docs`, with size, source_size, target, copies and taken.

    `docs` has doc_id, text and source. `copies` is how often the mix holds the row,
    `taken` its words times that.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    kept = docs.drop(*added)
    sized = kept.withColumn(
        "size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    )
    buckets = max(1, -(-docs.count() // bucket_rows))
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    sized = sized.withColumn("_bucket", F.pmod(_hex(name, 8), F.lit(buckets)).cast("int"))

    counts = sized.groupBy("source", "_bucket").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_words")
    )
    along = Window.partitionBy("source").orderBy("_bucket")
    targets = source_targets(
        counts.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, most
    )
    placed = counts.withColumn(
        "_before",
        F.coalesce(
            F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    )
    plan = placed.alias("p").join(targets.alias("t"), F.expr("p.source <=> t.source")).select(
        F.col("p.source").alias("_source"),
        F.col("p._bucket").alias("_in"),
        "_before",
        "source_size",
        "target",
    )

    ties = F.xxhash64(*[F.col(f"`{c}`") for c in kept.columns if _hashable(kept, c)])
    within = Window.partitionBy("source", "_bucket").orderBy(
        F.col("size").desc(), F.col("doc_id").asc_nulls_last(), ties
    )
    ranked = sized.withColumn("_rank", F.row_number().over(within))
    joined = ranked.join(
        plan, ranked["source"].eqNullSafe(plan["_source"]) & (ranked["_bucket"] == plan["_in"])
    )
    each = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    label = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    offset = _hex(F.concat(F.lit(f"{seed}:"), label), 5) / F.lit(float(STEPS))
    rank = (F.col("_rank") + F.col("_before")).cast("double")
    crossed = F.floor(rank * each + offset) - F.floor((rank - 1.0) * each + offset)
    return (
        joined.withColumn("copies", F.least(crossed, F.lit(most).cast("long")))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*[f"`{c}`" for c in kept.columns], *added)
    )


def _hashable(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType.simpleString()
    return "map<" not in kind and "variant" not in kind


def resample(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of `docs`."""
    return (
        mix(docs, **options)
        .filter("copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*[f"`{c}`" for c in docs.columns])
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "source"
    )


ORACLE_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5(coalesce('=' || doc_id, '')), 1, 8))::BIGINT
           % greatest(1, ceil((SELECT count(*) FROM documents) / {BUCKET_ROWS}.0))::BIGINT) AS bucket
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(3 * source_size) OVER need, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER need, 0))::DOUBLE AS level
  FROM sources
  WINDOW need AS (ORDER BY (3 * source_size) / weight::DOUBLE, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, max(level) OVER () * weight::DOUBLE) AS target
  FROM levels),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source
                               ORDER BY bucket, size DESC, doc_id NULLS LAST)::DOUBLE AS place
  FROM sized),
taken AS (
  SELECT r.*, source_size, target,
         CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size::DOUBLE END AS each,
         ('0x' || substr(md5('{SEED}:' || coalesce('=' || r.source, '')), 1, 5))::BIGINT
           / {STEPS}.0::DOUBLE AS shift
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
copied AS (
  SELECT *, least(floor(place * each + shift) - floor((place - 1) * each + shift), 3)::BIGINT
            AS copies
  FROM taken)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies, source FROM copied
"""
