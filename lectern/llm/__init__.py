"""Operators for preparing text corpora, each with one registered query.

Every module holds an operator with its own interface, a `query(spark, sf_dir)` that
applies it to the given table, and `ORACLE_SQL` where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import (
    bpe,
    byte_bpe,
    centroids,
    hard_negatives,
    html_text,
    language,
    line_dedup,
    mixing,
    neighbours,
    repeats,
    simhash,
    url_filter,
    winnowing,
)

_MODULES = {
    "op1_url_filter": url_filter,
    "op2_html_text": html_text,
    "op3_bpe": bpe,
    "op4_line_dedup": line_dedup,
    "op5_simhash_near_dedup": simhash,
    "op6_mix_sources": mixing,
    "op7_winnowing": winnowing,
    "op8_language": language,
    "op9_neighbours": neighbours,
    "op10_repeats": repeats,
    "op11_byte_bpe": byte_bpe,
    "op12_centroids": centroids,
    "op13_hard_negatives": hard_negatives,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        name: module.ORACLE_SQL
        for name, module in _MODULES.items()
        if getattr(module, "ORACLE_SQL", None)
    }
