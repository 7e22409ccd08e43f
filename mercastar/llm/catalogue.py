"""Queries and SQL of this package by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercastar.llm import queries
from mercastar.llm.oracles import ORACLES
from mercastar.llm.workers import find_package

NAMES = (
    "op1_repeats",
    "op2_jaccard",
    "op3_pseudonyms",
    "op4_interleave",
    "op5_neighbours",
    "op6_decontaminate",
    "op7_language",
    "op8_mix",
    "op9_chat",
    "op10_token_counts",
    "op11_vector_codes",
    "op12_licenses",
    "op13_prefix_trie",
)


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        find_package(spark)
        return query(spark, folder)

    return run


QUERIES = {name: _ready(getattr(queries, name)) for name in NAMES}

__all__ = ["ORACLES", "QUERIES"]
