"""Corpus pipeline: five stages over `documents`, each with one of the operators.

1. language identification drops documents that are no language;
2. line dedup takes lines out of documents that ten or more documents have;
3. SimHash near-dedup keeps one document of each class of texts that share 0.8 of their
   five-word shingles or more, the one with the smallest id;
4. mixing repeats and drops documents to reach the sources' target words;
5. BPE encodes each text and returns what the ids decode to, with the number of tokens.

Every stage works on all that the one before kept. The first four return the columns of
`documents`, with n_chars of the text as it is then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, language, line_dedup, mixing, simhash
from lectern.sources.scratch import stored

#: Encoding, mixing and the perfect hash are not SQL; tests hold `run` against brute force.
ORACLE_SQL = None


#: Rows that a Python worker gets at once: some megabytes of text.
BATCH_ROWS = 1_000


def _bounded(spark: SparkSession) -> None:
    """Sets how many rows go to a Python worker at once, for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return language.drop_unidentified(docs)


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    cleaned = line_dedup.dedup_lines(docs)
    values = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cleaned.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return simhash.one_of_each(docs, simhash.similar_documents(docs))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs)


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the decoded text, and the ids."""
    _bounded(spark)
    coded = bpe.decode_column(bpe.encode_column(docs))
    return coded.select(
        "doc_id", "lang", "source", F.col("decoded").alias("text"),
        F.length("decoded").cast("long").alias("n_chars"), F.size("ids").cast("long").alias("n_tokens"), "ids",
    )


STAGES = [
    ("language_id", _language_id),
    ("line_dedup", _line_dedup),
    ("near_dedup", _near_dedup),
    ("mix_sources", _mix),
    ("bpe", _encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
