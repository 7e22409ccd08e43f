"""The registered queries: against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mercastar import storage
from mercastar.llm import decontamination, jaccard
from mercastar.llm.catalogue import ORACLES, QUERIES
from mercastar.llm.queries import table


def key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, name):
    database = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        database.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    result = database.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=key)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        assert all(
            math.isclose(x, y, rel_tol=1e-9) if isinstance(x, float) else (x == y and type(x) is type(y))
            for x, y in zip(a, b, strict=True)
        ), (a, b)


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_stages(spark, small):
    docs = table(spark, small, "documents").cache()
    letters = docs.where(F.col("text").rlike(r"\p{L}"))
    named = corpus_pipeline.identify_language(spark, docs, small)
    assert named.columns == docs.columns and named.count() == letters.count()

    single = corpus_pipeline.drop_near_copies(spark, docs, small)
    linked = jaccard.link_documents(docs)
    assert single.columns == docs.columns
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in linked.collect()}

    clean = corpus_pipeline.drop_benchmark_copies(spark, docs, small)
    marked = decontamination.mark_contamination(docs, table(spark, small, "benchmark"))
    assert clean.columns == docs.columns
    assert clean.count() == marked.where("NOT contaminated").count() < docs.count()

    mixed = corpus_pipeline.mix_domains(spark, docs, small)
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().where("count > 1").isEmpty()
    cut = corpus_pipeline.shard(spark, docs, small)
    assert cut.columns == [*docs.columns, "shard", "slot"] and cut.count() == docs.count()


def test_pipeline(spark, small):
    out = corpus_pipeline.run(spark, small)
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and 0 < sum(sizes) < table(spark, small, "documents").count()


def test_stages_take_odd_rows(spark, small):
    schema = table(spark, small, "documents").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c", None, None, 5), (2, "a b c", None, None, 5)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() <= 4
        assert stage(spark, docs.where("doc_id < 0"), small).count() == 0


def test_language_is_asked_once(spark, small):
    """The filter on the answer must not have a second worker find it again."""
    kept = corpus_pipeline.identify_language(spark, table(spark, small, "documents"), small)
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_batches_of_long_documents_are_bounded_by_bytes(spark, small):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    @corpus_pipeline._stage
    def measure(spark, docs, folder):
        return docs.mapInArrow(sizes, "n bigint")

    docs = spark.range(200).coalesce(1).select(F.repeat(F.lit("long document "), 6000).alias("text"))
    found = [r.n for r in measure(spark, docs, small).collect()]
    assert sum(found) > 16_000_000 and max(found) < 5_000_000


def test_no_learnable_language_keeps_the_corpus(spark, small):
    schema = table(spark, small, "documents").schema
    rows = [(1, "a b c", None, "s", 5), (2, "12 34", None, "s", 5), (3, "d e f", None, "s", 5), (4, None, None, "s", 0)]
    out = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, schema), small).collect()
    assert sorted((r.doc_id, r.lang) for r in out) == [(1, None), (3, None)]


def test_mixing_bounds_rates_in_the_fit(spark, small, monkeypatch):
    seen = {}

    def mix(docs, labels, factors, **more):
        seen.update(more)
        return docs.withColumn("n_copies", F.lit(1))

    monkeypatch.setattr(corpus_pipeline.mixing, "mix", mix)
    docs = table(spark, small, "documents")
    assert corpus_pipeline.mix_domains(spark, docs, small).count() == docs.count() and seen["most"] == 1.0


def test_near_copies_are_judged_by_texts_not_ids(spark, small, words):
    one, two = words(60), words(70)
    near = one + " " + words(2)
    schema = table(spark, small, "documents").schema
    rows = [
        (7, one, "en", "s", 1), (7, two, "en", "s", 1), (9, near, "en", "t", 1), (None, one, None, None, None),
        (None, two + " x", None, None, None), (None, "a lone text without an id and long enough", None, "q", 1),
        (5, None, None, "s", 0), (6, "", None, "s", 0), (3, "12 ... ??", None, "s", 0), (7, two, "en", "s", 1),
    ]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, schema), small).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept)) == sorted(
        [(7, one), (7, two), (0, rows[5][1]), (5, ""), (6, ""), (3, "12 ... ??")]
    )


def test_run_leaves_one_stored_table(spark, small):
    mark = storage.steps_mark()
    out = corpus_pipeline.run(spark, small)
    assert len(storage.steps_since(mark)) == 1 and out.count() > 0
