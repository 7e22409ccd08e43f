"""Token counts kept by digest of content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercastar.llm.columns import packed, quoted, tokenizer_path, unpacked, utf8_size

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens bigint"
LIMIT = 512
MEMO_PARTS = 250_000  # bound of each of two generations of remembered parts
BATCH_PARTS = 4096

Counter = Callable[[list[str]], np.ndarray]


def tokenizer_version(name: str) -> str:
    """Digest of the vocabulary file, so a changed file never meets old counts."""
    with open(tokenizer_path(name), "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def _whole_texts(count: Callable[[list[str]], list[int]]) -> Counter:
    return lambda texts: np.array(count(texts), np.int64)


class _Memo:
    """Counts of parts in two generations, of which the older is forgotten when the newer is full."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def counts(self, parts: set[str], count: Callable[[list[str]], list[int]]) -> dict[str, int]:
        """The table that holds all `parts`, after counting those that are in neither generation."""
        missing = [p for p in parts if p not in self.young]
        if len(self.young) + len(missing) > self.size:
            self.young, self.old = {}, self.young
            missing = list(parts)
        if missing:
            older = self.old
            self.young.update((p, older[p]) for p in missing if p in older)
            new = [p for p in missing if p not in older]
            for low in range(0, len(new), BATCH_PARTS):
                some = new[low : low + BATCH_PARTS]
                self.young.update(zip(some, count(some), strict=True))
        return self.young


# Kept while a Python worker serves tasks: the counts do not depend on the task.
_memos: dict[str, _Memo] = {}


def _by_parts(name: str, count: Callable[[list[str]], list[int]]) -> Counter:
    """Count parts between blanks and add them up, remembering frequent parts.

    For byte-level vocabularies whose pattern lets a blank only begin a piece or stand
    in a run of white space, a text may be cut before every single blank that follows
    a sign other than white space: no piece reaches over such a place. Texts with
    other white space before a blank are counted whole.
    """
    memo = _memos.setdefault(name, _Memo(MEMO_PARTS))

    def run(texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), np.int64)
        for at, text in enumerate(texts):
            first, *rest = text.split(" ")
            parts = [first, *[" " + p for p in rest]]
            distinct = set(parts)
            # A part before a blank must not be empty or end in white space.
            if any(p == " " or p[-1:].isspace() or not p for p in distinct):
                totals[at] = count([text])[0]
                continue
            totals[at] = sum(map(memo.counts(distinct, count).__getitem__, parts))
        return totals

    return run


def counter(name: str) -> Counter:
    """A function from texts to their token counts, as the library for the file gives them.

    No begin, end or added tokens; no truncation or padding.
    """
    path = tokenizer_path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def count(texts: list[str]) -> list[int]:
            return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        return _by_parts(name, count) if name.startswith("byte_bpe") else _whole_texts(count)
    if name.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return _whole_texts(lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)])
    raise ValueError(f"no library for {name}")


def _encoder(name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = counter(name)
        for batch in batches:
            counts = count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts)], ["digest", "n_tokens"]
            )

    return encode


class CountCache:
    """A Parquet table of counts by (tokenizer digest, content digest), only appended to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        empty = self.spark.createDataFrame([], CACHE_SCHEMA)
        files = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        there = files.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(files)
        # A count is a function of its key: copies left by a repeated append are equal.
        return self.spark.read.schema(CACHE_SCHEMA).parquet(self.path) if there else empty

    def append(self, counts: DataFrame) -> None:
        counts.write.mode("append").parquet(self.path)


def count_tokens(
    docs: DataFrame, cache: CountCache, tokenizer: str = "byte_bpe_50k.json",
    key: str = "doc_id", text: str = "text", limit: int = LIMIT,
) -> DataFrame:
    """Add `n_bytes`, `n_tokens` and `over_limit` to every document, through the cache.

    Content is normalised (NULL to empty) and named by its SHA-256. Digests that the
    cache lacks are reduced to one document each, only those texts are encoded, and
    their counts are appended; then all digests are joined with the cache. A run
    that is lost before the append leaves the cache as it was.

    The document of a digest is chosen on digests and keys alone: copies are collapsed
    before the shuffle, and the text of the chosen ones moves once, by key. NULL keys
    and rows that repeat key and text are encoded once for each row. Input columns
    with the names of results are replaced; an empty table gives no rows and appends
    nothing.
    """
    version = tokenizer_version(tokenizer)
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    digest = F.sha2(body.cast("binary"), 256)
    spot = F.xxhash64(F.col(quoted(key)))
    known = cache.read().where(F.col("tokenizer") == version).select("digest").distinct()
    chosen = docs.select(digest.alias("digest"), spot.alias("spot")).groupBy("digest").agg(
        F.min("spot").alias("spot")
    )
    missing = chosen.join(known, "digest", "left_anti")
    texts = docs.select(digest.alias("digest"), spot.alias("spot"), body.alias("text"))
    misses = texts.join(missing, ["spot", "digest"], "left_semi").select("digest", "text")
    counts = misses.mapInArrow(_encoder(tokenizer), "digest string, n_tokens bigint")
    cache.append(
        counts.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
        .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
    )
    stored = cache.read().where(F.col("tokenizer") == version)
    stored = stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    rows = packed(docs, _digest=digest, _bytes=utf8_size(F.col(quoted(text))))
    rows = rows.join(stored, F.col("_digest") == F.col("digest"), "left")
    return unpacked(
        rows,
        docs.columns,
        n_bytes=F.col("_bytes"),
        n_tokens=F.col("n_tokens"),
        over_limit=F.col("n_tokens") > limit,
    )
