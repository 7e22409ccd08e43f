from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mercastar.llm import language as L
from mercastar.llm.text_arrays import slices


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = L.identify(docs, L.fit_languages(docs))
    judged = found.where(L.held_out(F.col("doc_id"))).select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"))
    assert judged.agg(F.avg("ok")).first()[0] >= 0.95
    assert found.where("score < 0 OR score > 1").isEmpty()


def test_prediction_uses_the_text_alone(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = L.fit_languages(docs)
    named = L.identify(docs, model).select("doc_id", "lang_pred", "score")
    blind = L.identify(docs.select("doc_id", "text"), model).select("doc_id", "lang_pred", "score")
    assert named.exceptAll(blind).isEmpty()


def test_held_out_labels_are_not_learned(spark):
    rows = [(i, "abc def " * 3 if i % 2 else "xyz uvw " * 3, None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    secret = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("zz")))
    assert L.fit_languages(secret).languages == ()


def test_families_come_first():
    texts = ["the house and the dog", "das haus und der hund", "la maison et le chien", "la casa y el perro"] * 10
    labels = np.array(["en", "de", "fr", "es"] * 10, object)
    piece = next(slices(pa.array(texts)))
    model = L.LanguageModel.fitted(L._vectors(piece), labels)
    assert model.families == ("germanic", "romance") and model.pairs == (("de", "en"), ("es", "fr"))
    names, score = model.predict(piece)
    assert list(names) == list(labels) and (score > 0.5).all()


def plain_prediction(model, text):
    """The family of the greatest margin, then votes of its pairs, from byte trigrams one by one."""
    raw = [(c | 32 if 65 <= c <= 90 else c) for c in (text or "").encode()]
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0
    raw = [c if 97 <= c <= 122 or c >= 128 else 32 for c in raw]
    margins = np.array(model.weights[-1], float)
    shares = [a | b << 8 | c << 16 for a, b, c in zip(raw, raw[1:], raw[2:])]
    for code in shares:
        place = (code * 0x1CE4E5B9) % 2**32 >> 20
        margins = margins + model.weights[place] / len(shares)
    families = margins[: len(model.families)]
    family = model.families[int(families.argmax())]
    sure = 1 / sum(np.exp(2 * (m - families.max())) for m in families)
    rivals = [x for x in model.languages if L.family_of(x) == family]
    shares_of = {x: [] for x in rivals}
    for (a, b), m in zip(model.pairs, margins[len(model.families) :], strict=True):
        if a in shares_of:
            p = 1 / (1 + np.exp(-2 * m))
            shares_of[a].append(p)
            shares_of[b].append(1 - p)
    best = max(rivals, key=lambda x: sum((p >= 0.5) + 1e-3 * p for p in shares_of[x]))
    return best, sure * min([1.0, *shares_of[best]])


def test_answers_are_those_of_a_plain_scorer(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 20000")
    model = L.fit_languages(docs)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "a"), (-4, "Ab"), (-5, "ÉÀ é"), (-6, "12 .")], "doc_id bigint, text string")
    rows = L.identify(docs.select("doc_id", "text").unionAll(odd), model).collect()
    assert len(rows) > 100
    for r in rows:
        name, score = plain_prediction(model, r.text)
        assert r.lang_pred == name and abs(r.score - score) < 1e-4, r.doc_id


def test_unknown_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = L.fit_languages(docs)
    texts = [None, "", "123 !!", "...", "\U0001f600 42", "й", "a", "the " * 50_000]
    rows = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id bigint, text string, score string")
    out = {r.doc_id: r for r in L.identify(rows.unionAll(rows), model).collect()}
    assert [out[i].lang_pred for i in range(5)] == ["und"] * 5 and all(out[i].score == 0 for i in range(5))
    assert out[5].lang_pred in model.languages and out[7].lang_pred == "en"
    assert L.identify(rows.where("doc_id < 0"), model).collect() == []
    nothing = L.fit_languages(docs.where("doc_id < 0"))
    assert {r.lang_pred for r in L.identify(rows, nothing).collect()} == {"und"}


def test_single_language_and_single_family(spark):
    rows = [(i, "some words here", "en") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in L.identify(docs, L.fit_languages(docs)).collect()} == {"en"}
