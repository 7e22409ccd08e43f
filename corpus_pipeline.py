"""From raw documents to sharded training text, in five stages.

Each stage takes the documents its predecessor kept and returns documents with the
same columns; the last adds `shard` and `slot`. Every stage is written to the shared
folder and read again, so a lost executor costs at most the running stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercastar.llm import decontamination, jaccard, language, mixing, sharding
from mercastar.llm.queries import MIXTURE, domain_labels, table
from mercastar.llm.workers import find_package
from mercastar.storage import delete_steps, durable, steps_mark, steps_since

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Classifiers and iterated fits have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


# Rows and bytes of a batch that a Python worker gets. Rows are whole documents, some very
# long, and a batch is held by the JVM and the worker at once.
BATCH_ROWS = "2000"
BATCH_BYTES = "4m"

# Steps that the last stage wrote; nothing reads them once its result is stored.
_earlier: list[str] = []


def _stage(work: Stage) -> Stage:
    """A stage that first deletes what the one before it has left in the shared folder.

    Its result must be written before the next stage is called, as `run` does.
    """

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        find_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        delete_steps(spark, _earlier)
        mark = steps_mark()
        out = work(spark, docs, sf_dir)
        _earlier[:] = steps_since(mark)
        return out

    return run_stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the language found; those without a letter go.

    NULL and empty texts have no letter and go; rows with NULL ids and repeated rows are
    judged like others, each by its own text, however long. Where no label is left to
    learn from, documents keep the language they came with. An empty table gives none.
    """
    model = language.fit_languages(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model)
    kept = found.where(F.col("lang_pred") != language.UNKNOWN).withColumn("lang", F.col("lang_pred"))
    return kept.select(*docs.columns)


ROW_NAME = "_mx_name"


def _row_name(docs: DataFrame) -> Column:
    """A name for each different row that sorts by doc_id, NULL last, then by the md5 of the row."""
    lowest = F.shiftleft(F.lit(1).cast("bigint"), 63)
    digits = F.lpad(F.hex(F.col("doc_id").cast("bigint").bitwiseXOR(lowest)), 16, "0")
    row = F.to_json(F.struct(*docs.columns)).cast("binary")
    return F.concat(F.coalesce(digits, F.lit("none")), F.md5(row))


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: the one with the least id.

    Rows are told apart by all their columns, so rows that share an id, or have none,
    are judged by their texts: unlike ones all stay, similar ones leave one (of equal
    ids the one whose row has the least md5; NULL ids come last). Rows that are equal in
    every column are one document. Texts that are NULL, empty or without words are
    similar to nothing and stay. An empty table gives none.
    """
    named = docs.withColumn(ROW_NAME, _row_name(docs))
    linked = jaccard.link_documents(named.select(ROW_NAME, "text"), ROW_NAME)
    first = linked.where(F.col(ROW_NAME) == F.col("component_id")).select(ROW_NAME).distinct()
    line = Window.partitionBy(ROW_NAME).orderBy(ROW_NAME)
    kept = named.join(first, ROW_NAME, "left_semi").withColumn("_n", F.row_number().over(line))
    return kept.where(F.col("_n") == 1).select(*docs.columns)


@_stage
def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a share of the benchmark.

    NULL and empty texts have no words and stay; NULL ids and repeated rows are judged by
    their texts, however long. An empty table, or an empty benchmark, drops none.
    """
    marked = decontamination.mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.without_documents(marked).select(*docs.columns)


@_stage
def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates, of 1 at most, that bring the domains closest to their targets.

    A document is drawn by its id, so rows that share an id and text stay or go together;
    NULL and empty texts have the shares of the domains at large. An empty table gives none.
    """
    mixed = mixing.mix(docs, domain_labels(spark, sf_dir), MIXTURE, most=1.0)
    return mixed.where(F.col("n_copies") > 0).select(*docs.columns)


@_stage
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot.

    NULL sources form a source of their own; rows with NULL or equal ids are separate
    rows, in an order that does not matter. An empty table gives none.
    """
    return sharding.interleave(docs, "doc_id", "source")


STAGES = [
    ("language identification", identify_language),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_copies),
    ("domain mixing", mix_domains),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sharded documents of a folder of tables.

    Every stage's result is written to the shared folder and read again; the result and
    the inner steps before it are deleted then, so the folder holds two stages at most.
    NULLs, empty texts, ties, repeated rows and empty tables: see the stages.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        mark = steps_mark()
        docs = durable(stage(spark, docs, sf_dir))
        inner, now = steps_since(mark)[:-1], steps_since(mark)[-1]
        delete_steps(spark, inner + ([before] if before else []))
        before = now
    return docs
