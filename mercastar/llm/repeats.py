"""Long byte strings that occur more than once in a corpus, found with run-length indexes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercastar.llm.bit_table import BitTable
from mercastar.llm.columns import quoted
from mercastar.llm.run_index import RunLengthIndex
from mercastar.llm.text_arrays import BASE, Slice, SpanHash, as_long, mix, slices
from mercastar.storage import durable

LENGTH = 400
ANCHOR = 64  # bytes that name an anchor
GRAM = 32  # bytes whose hash chooses it: long enough to be rare in a string of its own
SHARD_BYTES = 1 << 20
HOT_CONTEXTS = 4096  # distinct contexts of an anchor (at most 3 MB) beyond which its strings are split up

RANGES = "array<struct<low:int,high:int>>"
SPANS = "array<struct<low:bigint,high:bigint>>"
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_FACTORS = mix(np.arange(1, GRAM // 8 + 1, dtype=np.uint64) * BASE) | np.uint64(1)


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of `width` values, from block-wise running minima."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])


def anchors(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive LENGTH-byte strings that share their anchor.

    The anchor of a string is the leftmost place in it where the hash of GRAM bytes is
    least, among those that leave room for ANCHOR bytes. It depends on the string
    alone, so equal strings have their anchors at the same offset, with the same bytes
    there. Returns, for each run, its text, first start, last start, and anchor place.
    """
    n = len(piece.data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none
    eights = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(piece.data).data, strides=(1,))
    ranked = np.zeros(n - GRAM + 1, np.uint64)
    for step, factor in enumerate(_FACTORS):
        ranked += eights[8 * step : 8 * step + len(ranked)] * factor
    ranked = (ranked & _HIGH) | np.arange(len(ranked), dtype=np.uint64)
    least = _window_minima(ranked[: n - ANCHOR + 1], LENGTH - ANCHOR + 1)
    sizes = np.diff(piece.offsets)
    ends = np.repeat(piece.offsets[1:], sizes)[: len(least)]
    valid = np.arange(len(least)) + LENGTH <= ends
    place = (least & _LOW).astype(np.int64)
    # A run ends where the anchor changes; an invalid string never opens one.
    new = np.concatenate([[True], (place[1:] != place[:-1]) | ~valid[:-1]]) & valid
    first = np.flatnonzero(new)
    stop = np.flatnonzero(np.concatenate([new[1:] | ~valid[1:], [True]]) & valid)
    text = np.searchsorted(piece.offsets, first, side="right") - 1
    return text, first, stop, place[first]


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch.column("text")):
            _, first, _, place = anchors(piece)
            if len(first):
                names, counts = np.unique(SpanHash(piece.data).of(place, place + ANCHOR), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(as_long(names)), pa.array(counts)], ["anchor", "n"])


def _context_emitter(repeated: BitTable):
    """A row for each context of a text whose anchor may be repeated, with all its starts.

    A task hands on each text once, and the bytes of each context once.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            for piece in slices(batch.column("text")):
                text, first, last, place = anchors(piece)
                if not len(first):
                    continue
                spans = SpanHash(piece.data)
                names = as_long(spans.of(place, place + ANCHOR))
                fresh = np.zeros(len(piece), bool)
                for i in range(len(piece)):
                    digest = digests[piece.first + i]
                    fresh[i] = digest not in met
                    met.add(digest)
                keep = repeated.holds(names) & fresh[text]
                if not keep.any():
                    continue
                text, first, stop, names = text[keep], first[keep], last[keep] + LENGTH, names[keep]
                contexts = as_long(spans.of(first, stop))
                line = np.lexsort((first, contexts, names, text))
                text, first, stop, names, contexts = (x[line] for x in (text, first, stop, names, contexts))
                new = (text[1:] != text[:-1]) | (names[1:] != names[:-1]) | (contexts[1:] != contexts[:-1])
                head = np.flatnonzero(np.concatenate([[True], new]))
                starts = pa.ListArray.from_arrays(
                    pa.array(np.append(head, len(first)), pa.int32()), pa.array(first - piece.offsets[text])
                )
                raw = []
                for i in head:
                    key = (int(names[i]), int(contexts[i]))
                    raw.append(None if key in sent else piece.data[first[i] : stop[i]].tobytes())
                    sent.add(key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digests[piece.first + i] for i in text[head]], pa.binary()),
                        starts,
                        pa.array(names[head]),
                        pa.array((stop[head] - LENGTH - first[head] + 1).astype(np.int32)),
                        pa.array(contexts[head]),
                        pa.array(raw, pa.binary()),
                    ],
                    ["digest", "starts", "anchor", "strings", "context", "bytes"],
                )

    return emit


def _ranges(marks: np.ndarray) -> list[dict]:
    """Runs of true values as inclusive ranges."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [{"low": int(a), "high": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _index_shard(group: pa.Table) -> pa.Table:
    """Index the contexts of one shard and mark their strings that occur elsewhere."""
    names = np.array([group.column(c).to_numpy() for c in ("anchor", "context")])
    line = np.lexsort(names[::-1])
    raw = group.column("bytes").to_pylist()
    texts = [np.frombuffer(raw[i], np.uint8) for i in line]
    index = RunLengthIndex(texts)
    long = index.matches() >= LENGTH
    strings = group.column("strings").to_numpy()[line]
    found = [_ranges(long[a : a + n]) for a, n in zip(index.starts, strings, strict=True)]
    return pa.table(
        {
            "anchor": names[0][line],
            "context": names[1][line],
            "ranges": pa.array(found, pa.list_(pa.struct({"low": pa.int32(), "high": pa.int32()}))),
        }
    )


def _emit_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every LENGTH-byte string of a context, by its place and a hash."""
    for batch in batches:
        for row, piece in ((p.first, p) for p in slices(batch.column("bytes"), 1)):
            n = batch.column("strings")[row].as_py()
            at = np.arange(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch.column("anchor")[row].as_py())),
                    pa.array(np.full(n, batch.column("context")[row].as_py())),
                    pa.array(at.astype(np.int32)),
                    pa.array(as_long(SpanHash(piece.data).of(at, at + LENGTH))),
                ],
                ["anchor", "context", "at", "string"],
            )


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Byte ranges of each distinct text that are covered by repeated LENGTH-byte strings.

    Returns `digest` (SHA-256 of the text as UTF-8) and `spans`, sorted disjoint ranges
    `[low, high)` that do not touch, for texts that have any. A string is repeated if
    it starts at two places of the corpus, which may lie in one text and may overlap;
    copies of a text are places of their own. NULL counts as empty.

    1. Strings are grouped into runs by their anchor (`anchors`), and anchors counted.
       Only runs with a repeated anchor can hold a repeated string. A run goes on as
       its context: the bytes of all its strings. Equal contexts collapse to one with
       the number of their places; from two places on, all strings are repeated.
    2. The other contexts of an anchor, and those they may match, go to the shard of
       the anchor. Each shard builds a run-length index of its contexts and streams
       the matching statistics of the contexts from it.
    3. An anchor with more than HOT_CONTEXTS different contexts would outgrow its
       shard. Its strings are counted by hash instead, which spreads over all tasks.
    """
    body = docs.select(F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    counted = body.mapInArrow(_emit_anchors, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    repeated = durable(counted.where("n > 1").select("anchor"))
    named = body.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "text")
    emitted = named.mapInArrow(
        _context_emitter(BitTable.of(repeated, "anchor")),
        "digest binary, starts array<bigint>, anchor bigint, strings int, context bigint, bytes binary",
    )
    places = durable(emitted)

    copies = named.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    narrow = places.select("digest", "starts", "anchor", "strings", "context").distinct()
    narrow = durable(
        narrow.join(copies, "digest", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    )
    contexts = narrow.groupBy("anchor", "context").agg(
        F.sum(F.col("copies") * F.size("starts")).alias("places"), F.any_value("strings").alias("strings")
    )
    contexts = durable(contexts)
    kinds = contexts.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("places") == 1).alias("single")
    )
    # Where every context is repeated, nothing is left to look for.
    unsettled = durable(kinds.where("kinds > 1 AND single > 0"))
    known = contexts.where("places > 1").select(
        "anchor",
        "context",
        F.array(F.struct(F.lit(0).alias("low"), (F.col("strings") - 1).alias("high"))).cast(RANGES).alias("ranges"),
    )

    texts = durable(
        places.where(F.col("bytes").isNotNull()).join(unsettled, "anchor").groupBy("anchor", "context")
        .agg(F.any_value("bytes").alias("bytes"), F.any_value("strings").alias("strings"), F.any_value("kinds").alias("kinds"))
    )
    calm = texts.where(F.col("kinds") <= HOT_CONTEXTS)
    total = calm.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_BYTES))
    dealt = calm.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    indexed = dealt.select("shard", "anchor", "context", "strings", "bytes").groupBy("shard").applyInArrow(
        _index_shard, f"anchor bigint, context bigint, ranges {RANGES}"
    )
    strings = texts.where(F.col("kinds") > HOT_CONTEXTS).mapInArrow(
        _emit_strings, "anchor bigint, context bigint, at int, string bigint"
    )
    twice = strings.groupBy("anchor", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    split = strings.join(twice, ["anchor", "string"]).select(
        "anchor", "context", F.array(F.struct(F.col("at").alias("low"), F.col("at").alias("high"))).alias("ranges")
    )
    found = known.unionByName(indexed).unionByName(split)

    covered = narrow.join(found, ["anchor", "context"]).where(F.size("ranges") > 0)
    covered = covered.select("digest", "starts", "ranges").mapInArrow(_placed, f"digest binary, spans {SPANS}")
    # All ranges of one text: as many as its bytes allow.
    gathered = covered.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return durable(gathered.mapInArrow(_gathered, f"digest binary, spans {SPANS}"))


def _joined(spans: np.ndarray) -> list[tuple[int, int]]:
    """Sorted disjoint ranges that cover the same bytes; ranges that touch are joined."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    opens = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    lows = spans[opens, 0]
    highs = reach[np.append(np.flatnonzero(opens)[1:] - 1, len(spans) - 1)]
    return list(zip(lows.tolist(), highs.tolist(), strict=True))


def _spans_column(lists: list[list[tuple[int, int]]]) -> pa.Array:
    found = [[{"low": a, "high": b} for a, b in spans] for spans in lists]
    return pa.array(found, pa.list_(pa.struct({"low": pa.int64(), "high": pa.int64()})))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges of a context, moved to each of its starts in a text."""
    for batch in batches:
        lists = []
        for starts, ranges in zip(batch.column("starts").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            own = np.array([(r["low"], r["high"] + LENGTH) for r in ranges], np.int64).reshape(-1, 2)
            moved = (np.array(starts, np.int64)[:, None, None] + own[None, :, :]).reshape(-1, 2)
            lists.append(_joined(moved) if len(moved) else [])
        yield pa.RecordBatch.from_arrays([batch.column("digest"), _spans_column(lists)], ["digest", "spans"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [
            _joined(np.array([(s["low"], s["high"]) for s in spans], np.int64))
            for spans in batch.column("spans").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), _spans_column(lists)], ["digest", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, digests = [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes()
            at, parts = 0, []
            for span in spans:
                parts.append(raw[at : span["low"]])
                at = span["high"]
            kept.append(b"".join([*parts, raw[at:]]))
            digests.append(hashlib.sha256(kept[-1]).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), pa.array(kept, pa.binary()), pa.array(digests)],
            ["digest", "kept", "kept_sha256"],
        )


def _wanted_texts(affected: BitTable):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.frombuffer(b"".join(d[:8] for d in batch.column("digest").to_pylist()), ">i8").astype(np.int64)
            keep = pa.array(affected.holds(names))
            yield batch.filter(keep)

    return emit


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", bytes_too: bool = True) -> DataFrame:
    """Cut every byte covered by a repeated LENGTH-byte string out of the texts.

    Returns for every row `key`, `n_bytes`, `spans` (removed ranges), `n_removed`,
    `n_spans`, `kept_sha256` (hexadecimal digest of the bytes that stay) and, with
    `bytes_too`, `kept` (those bytes; they need not be valid UTF-8). Repetition is
    judged on the input, not on what is left. NULL and empty texts keep nothing and
    lose nothing; repeated rows are copies, so they lose all bytes from LENGTH on; an
    empty table gives no rows; other columns are ignored.

    Texts are cut once for each distinct text and joined back by digest.
    """
    spans = repeated_spans(docs, text)
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    named = docs.select(
        F.col(quoted(key)).alias("key"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), body.cast("binary").alias("text")
    )
    front = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint")
    affected = BitTable.of(spans.select(front.alias("front")), "front")
    some = named.select("digest", "text").mapInArrow(_wanted_texts(affected), "digest binary, text binary")
    once = some.groupBy("digest").agg(F.any_value("text").alias("text"))
    cut = once.join(spans, "digest").select("digest", "text", "spans")
    cut = cut.mapInArrow(_cut, "digest binary, kept binary, kept_sha256 string")
    if not bytes_too:
        cut = cut.drop("kept")
    done = cut.join(spans, "digest").withColumnRenamed("digest", "cut_digest")
    size = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["high"] - x["low"])
    rows = named.select(
        "key", "digest", F.octet_length("text").cast("bigint").alias("n_bytes"),
        *([F.col("text")] if bytes_too else []),
    )
    rows = rows.join(done, F.col("digest") == F.col("cut_digest"), "left")
    return rows.select(
        F.col("key").alias(key),
        "n_bytes",
        F.coalesce(size, F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("digest"))).alias("kept_sha256"),
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
        *([F.coalesce("kept", "text").alias("kept")] if bytes_too else []),
    )
