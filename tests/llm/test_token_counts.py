from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from mercastar.llm import token_counts as T
from mercastar.llm.columns import tokenizer_path

ODD = ["a", " ", "  ", "\n", "\t", "'s", "é", "1", "<|endoftext|>", "!", "　", " ", "word", "\r", "\x85", "\x1c", "​", "..", "</s>", "日本"]


def library(name, texts):
    path = tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    from tokenizers import Tokenizer

    return [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def odd_texts(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_those_of_the_library(name):
    texts = odd_texts(5000) + ["", "x" * 5000, "word " * 3000]
    assert T.counter(name)(texts).tolist() == library(name, texts)


def test_memory_is_bounded(monkeypatch):
    memo = T._Memo(10)
    monkeypatch.setitem(T._memos, "byte_bpe_50k.json", memo)
    texts = odd_texts(500)
    assert T.counter("byte_bpe_50k.json")(texts).tolist() == library("byte_bpe_50k.json", texts)
    assert len(memo.young) + len(memo.old) <= 10 + max(len(set(t.split(" "))) for t in texts) * 2


def test_only_misses_are_encoded_and_kept(spark, documents, tmp_path):
    cache = T.CountCache(spark, str(tmp_path / "cache"))
    texts = ["one two", "one two", None, "", "three", "x " * 600]
    out = T.count_tokens(documents(*texts, n_tokens="old"), cache).orderBy("doc_id").collect()
    assert [r.n_tokens for r in out] == library("byte_bpe_50k.json", [t or "" for t in texts])
    assert [r.n_bytes for r in out] == [len((t or "").encode()) for t in texts]
    assert [r.over_limit for r in out] == [r.n_tokens > 512 for r in out]
    assert cache.read().count() == 4
    more = T.count_tokens(documents("three", "four"), cache)
    assert more.count() == 2 and cache.read().count() == 5


def test_a_second_call_encodes_nothing(spark, small, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    cache = T.CountCache(spark, str(tmp_path / "cache"))
    first = sorted(map(tuple, T.count_tokens(docs, cache).select("doc_id", "n_tokens").collect()))
    held = cache.read().count()
    assert held == docs.select(F.coalesce("text", F.lit(""))).distinct().count()

    def refusing(name):
        def encode(batches):
            for batch in batches:
                assert batch.num_rows == 0, "a stored text was encoded"
                yield batch.select(["digest"])

        return encode

    monkeypatch.setattr(T, "_encoder", refusing)
    again = sorted(map(tuple, T.count_tokens(docs, cache).select("doc_id", "n_tokens").collect()))
    assert again == first and cache.read().count() == held


def test_stored_counts_are_used_by_version(spark, documents, tmp_path):
    cache = T.CountCache(spark, str(tmp_path / "cache"))
    digest = F.sha2(F.lit("one").cast("binary"), 256).alias("digest")
    stale = spark.range(1).select(F.lit("another version").alias("tokenizer"), digest, F.lit(99).cast("bigint").alias("n_tokens"))
    cache.append(stale)
    assert T.count_tokens(documents("one"), cache).first().n_tokens == 1
    cache.append(stale.withColumn("tokenizer", F.lit(T.tokenizer_version("word_bpe_49k.json"))))
    assert T.count_tokens(documents("one"), cache, "word_bpe_49k.json").first().n_tokens == 99


def test_nulls_repeated_rows_and_empty(spark, documents, tmp_path):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b")], "doc_id bigint, text string")
    cache = T.CountCache(spark, str(tmp_path / "cache"))
    assert [r.n_tokens for r in T.count_tokens(docs, cache).collect()] == [2] * 4
    assert cache.read().count() == 1
    assert T.count_tokens(docs.where("doc_id < 0"), cache).collect() == []
