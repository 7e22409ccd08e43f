"""Benchmark passages in training text: found, counted, and removed."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercastar.llm.columns import packed, quoted, unpacked

WINDOW = 13
PREFIX = 4
MIN_SHARE_PERCENT = 5

# Words of raw text; A-Z belong to words and are lower-cased for comparison.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Size of the table of prefixes: 128 bits for each, at most 2 MB.
BITS_PER_PREFIX = 128
LEAST_BITS, MOST_BITS = 1 << 14, 1 << 24

# Windows are broadcast up to this number (of at most some hundred bytes each).
BROADCAST_WINDOWS = 200_000

RESULTS = ("n_words", "n_hit", "items", "spans", "contaminated")


def _pieces(text: Column) -> Column:
    """Words of a text in order; the first and last piece may be empty."""
    return F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS, -1)


def _lowered(word: Column) -> Column:
    return F.translate(word, string.ascii_uppercase, string.ascii_lowercase)


def _word_count(pieces: Column) -> Column:
    n = F.size(pieces)
    first = (F.get(pieces, F.lit(0)) == "").cast("int")
    last = ((n > 1) & (F.get(pieces, n - 1) == "")).cast("int")
    return (n - first - last).cast("bigint")


def _gram(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(length)])


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """All windows `(item, phrase, n)`: 13 consecutive words, or all words of a shorter item."""
    words = F.filter(F.transform(_pieces(F.col(quoted(text))), _lowered), lambda w: w != "")
    items = benchmark.select(F.col(quoted(item)).cast("string").alias("item"), words.alias("w"))
    items = items.where(F.size("w") > 0)
    last = F.greatest(F.size("w") - WINDOW, F.lit(0))
    return (
        items.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select("item", F.slice("w", F.col("at") + 1, F.lit(WINDOW)).alias("w"))
        .select("item", F.array_join("w", " ").alias("phrase"), F.size("w").alias("n"), "w")
        .groupBy("item", "phrase", "n")
        .agg(F.any_value("w").alias("w"))
    )


def _prefix_bits(windows: DataFrame, length: int, bits: int) -> Column:
    """A table of `bits` bits, set where some window begins with a gram of that number.

    Its size does not depend on the windows: at most MOST_BITS / 64 numbers reach the
    driver. A full table lets more positions through to the exact comparison and
    loses none.
    """
    gram = F.pmod(_gram(F.transform("w", F.lower), F.lit(0), length), F.lit(bits))
    marks = windows.where(F.least("n", F.lit(PREFIX)) == length).select(gram.alias("g"))
    words = marks.groupBy(F.expr("CAST(g DIV 64 AS INT)").alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(g % 64 AS INT))")).alias("word")
    )
    table = [0] * (bits // 64)
    for row in words.collect():
        table[row["place"]] = row["word"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def find_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    benchmark_text: str = "text",
) -> DataFrame:
    """Verified hits of distinct texts: `(digest, spans, items)` for texts that have any.

    `digest` is the md5 of the text, so copies of a text are looked at as one from
    the first shuffle on. `spans` are sorted distinct (position among the pieces of
    the text, number of words); `items` are the sorted ids of the benchmark items
    that have a window in the text.

    A scan keeps the positions whose first four words fall on a set bit of a
    table of bounded size, writes out the words of the window there, and joins them,
    word for word, with the windows of the benchmark.
    """
    windows = benchmark_windows(benchmark, item, benchmark_text)
    shape = windows.agg(
        F.count_distinct("phrase").alias("phrases"),
        F.count(F.lit(1)).alias("rows"),
        F.collect_set("n").alias("lengths"),
    ).first()  # one row: two counts and at most 13 lengths
    lengths = sorted(shape["lengths"]) or [WINDOW]
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_PER_PREFIX * shape["phrases"]):
        bits *= 2
    grams = sorted({min(n, PREFIX) for n in lengths})
    tables = {g: _prefix_bits(windows, g, bits) for g in grams}

    pieces = docs.select(
        F.md5(F.col(quoted(text)).cast("binary")).alias("digest"),
        _pieces(F.col(quoted(text))).alias("w"),
    )
    low = pieces.select("digest", "w", F.transform("w", F.lower).alias("low"))

    def marked(at: Column) -> Column:
        found = F.lit(False)
        for g in grams:
            gram = F.pmod(_gram(F.col("low"), at, g), F.lit(bits)).cast("int")
            word = F.get(tables[g], F.shiftright(gram, 6))
            found = found | (F.getbit(word, gram.bitwiseAND(F.lit(63))) == 1)
        return found

    places = F.filter(F.sequence(F.lit(0), F.size("low") - 1), marked)
    sizes = F.array(*[F.lit(n) for n in lengths])
    spots = low.select("digest", "w", F.explode(places).alias("at"))
    phrase = F.transform(
        sizes, lambda n: F.array_join(F.transform(F.slice("w", F.col("at") + 1, n), _lowered), " ")
    )
    spots = spots.select("digest", "at", F.explode(phrase).alias("phrase"))

    wanted = windows.select("phrase", "n", "item")
    if shape["rows"] <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    # Copies of a text collapse in each task: the sets are of places and items of one text.
    return spots.join(wanted, "phrase").groupBy("digest").agg(
        F.array_sort(F.collect_set(F.struct(F.col("at"), F.col("n")))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )


def covered(spans: Column) -> Column:
    """Words covered by sorted spans, overlaps once."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("upto"))
    return F.aggregate(
        spans,
        start,
        lambda a, x: F.struct(
            (a["sum"] + F.greatest(F.lit(0), x["at"] + x["n"] - F.greatest(a["upto"], x["at"]))).alias("sum"),
            F.greatest(a["upto"], x["at"] + x["n"]).alias("upto"),
        ),
        lambda a: a["sum"].cast("bigint"),
    )


def mark_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    benchmark_text: str = "text", min_share_percent: int = MIN_SHARE_PERCENT,
) -> DataFrame:
    """Add what each document shares with a benchmark.

    Words are runs of 0-9, A-Z, a-z and all non-ASCII characters; A-Z compare as a-z.
    A window is 13 consecutive words of an item, or all words of a shorter item. A
    word of a document is hit when it lies in an occurrence of a window.

    Adds `n_words`, `n_hit`, `items` (sorted ids), `spans` (for `without_spans`) and
    `contaminated`: some word is hit, and at least `min_share_percent` of all words
    are. Input columns of these names are replaced. NULL or empty texts have no words
    and are never contaminated; NULL item ids hit words but are not listed; items
    without words are ignored; repeated rows are judged alike; an empty benchmark
    contaminates nothing.
    """
    hits = find_hits(docs, benchmark, text, item, benchmark_text)
    hits = hits.withColumn("hit", covered(F.col("spans")))
    body = F.col(quoted(text))
    rows = packed(docs, _digest=F.md5(body.cast("binary")), _n_words=_word_count(_pieces(body)))
    rows = rows.join(hits, F.col("_digest") == F.col("digest"), "left")
    hit = F.coalesce(F.col("hit"), F.lit(0).cast("bigint"))
    share = hit * 100 >= F.col("_n_words") * min_share_percent
    return unpacked(
        rows,
        docs.columns,
        n_words=F.col("_n_words"),
        n_hit=hit,
        items=F.coalesce(F.col("items"), F.array().cast("array<string>")),
        spans=F.coalesce(F.col("spans"), F.array().cast("array<struct<at:int,n:int>>")),
        contaminated=(hit > 0) & share,
    )


def without_documents(marked: DataFrame) -> DataFrame:
    """Drop contaminated documents and the columns `mark_contamination` added."""
    return marked.where(~F.col("contaminated")).drop(*RESULTS)


def without_spans(marked: DataFrame, text: str = "text") -> DataFrame:
    """Cut hit words, each with what follows it up to the next word, out of the texts."""
    body = F.col(quoted(text))
    gaps = F.regexp_extract_all(body, F.lit(f"({BETWEEN_WORDS})"), F.lit(1))
    pairs = F.zip_with(
        F.split(body, BETWEEN_WORDS, -1), gaps, lambda w, gap: F.concat(w, F.coalesce(gap, F.lit("")))
    )
    kept = F.filter(
        pairs,
        lambda x, i: ~F.exists("spans", lambda s: (i >= s["at"]) & (i < s["at"] + s["n"])),
    )
    cut = F.when(F.size("spans") > 0, F.array_join(kept, "")).otherwise(body)
    return marked.withColumn(text, cut).drop(*RESULTS)
