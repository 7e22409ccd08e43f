"""Similarity join of documents on word shingles, by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercastar.llm.columns import quoted
from mercastar.llm.components import components
from mercastar.llm.shingles import Shingles, shingles
from mercastar.llm.text_arrays import BASE, MIX_1, MIX_2, as_long, mix, slices
from mercastar.storage import durable

# Similarity of at least 4 / 5. Two such sets differ in at most (|A| + |B|) / 9 elements.
SIMILAR, OF, DIFFERING = 4, 5, 9

SEEDS = 6  # numbers of partitions tried for sets that fall into too few parts
FILTER_BITS = 1 << 24
LARGEST_BAND = 1 << 40


def _bands() -> np.ndarray:
    """Least sizes of the bands; partners of a set lie in its own band or a neighbour."""
    starts = [1]
    while starts[-1] < LARGEST_BAND:
        starts.append(starts[-1] * OF // SIMILAR + 1)
    return np.array(starts, np.int64)


BANDS = _bands()


def _signatures(sets: Shingles, rows: np.ndarray, up: int, seed: int):
    """Signatures of some sets towards their own band (`up` = 0) or the next (1).

    The domain of shingles is cut into as many partitions as band `b` asks for. With
    k the most elements in which a set may differ from a partner, there are more than
    k partitions, so two linked sets agree on one of them. The signature of a
    partition is a hash of the elements in it.

    Returns (row, signature, spare) of the nonempty partitions, and the rows that are
    too concentrated for the argument: those with at most k nonempty partitions.
    `spare` is how many signatures a set can do without: all nonempty ones but k + 1.
    """
    sizes = sets.sizes[rows]
    band = np.searchsorted(BANDS, sizes, side="right") - 1 + up
    largest = BANDS[np.minimum(band + 1, len(BANDS) - 1)] - 1
    differ = (sizes + np.minimum(largest, sizes * OF // SIMILAR)) // DIFFERING
    # A set alone in its reach is linked with equal sets only, or has no partner above.
    useful = (differ > 0) & (sizes * OF // SIMILAR >= BANDS[band])
    rows, sizes, band, largest, differ = (x[useful] for x in (rows, sizes, band, largest, differ))
    most = 2 * largest // DIFFERING
    parts = (most + 1) * 6 // 5 + 2
    base = np.concatenate([[0], np.cumsum(parts)])
    which = np.repeat(np.arange(len(rows)), sizes)
    if not len(which):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), rows[:0]
    inside = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    elements = sets.hashes[sets.offsets[rows][which] + inside]
    salt = np.uint64((seed + 1) * int(MIX_1) & 0xFFFFFFFFFFFFFFFF)
    spread = mix(elements ^ salt) >> np.uint64(32)
    part = ((spread * parts[which].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    slot = base[which] + part
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, slot, mix(elements + MIX_2))
    filled = np.bincount(slot, minlength=base[-1]) > 0
    owner = np.repeat(np.arange(len(rows)), parts)
    number = (np.arange(base[-1]) - np.repeat(base[:-1], parts)).astype(np.uint64)
    spare = np.bincount(owner, weights=filled).astype(np.int64) - differ - 1
    place = mix((band[owner].astype(np.uint64) * MIX_1) ^ (number * BASE) ^ np.uint64(seed + 1))
    signature = mix(sums ^ place)[filled]
    weak = spare < 0
    spare = np.maximum(spare, 0)
    owner = owner[filled]
    if seed + 1 < SEEDS or not weak.any():
        return rows[owner], signature, spare[owner], rows[weak]
    # Sets that stay concentrated under every seed meet in one signature of their band.
    last = mix((band[weak].astype(np.uint64) * MIX_2) ^ np.uint64(SEEDS + 1))
    return (
        np.concatenate([rows[owner], rows[weak]]),
        np.concatenate([signature, last]),
        np.concatenate([spare[owner], np.zeros(weak.sum(), np.int64)]),
        rows[:0],
    )


def signatures(sets: Shingles, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, spare) of all signatures of some sets.

    Sets too concentrated under one seed have signatures under the next as well. Of
    two linked sets take the first seed under which at least one is not too
    concentrated: both have signatures there, and the argument holds for that one.
    """
    out = []
    for up in (0, 1):
        left = rows
        for seed in range(SEEDS):
            if not len(left):
                break
            who, signature, spare, left = _signatures(sets, left, up, seed)
            out.append((who, signature, spare))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _emit_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    met: set[int] = set()  # sets this task has already handed on; 8 bytes for a text
    for batch in batches:
        for piece in slices(batch.column("text")):
            sets = shingles(piece)
            names = as_long(sets.names())
            rows = []
            for i in np.flatnonzero(sets.sizes > 0):
                if (name := int(names[i])) not in met:
                    met.add(name)
                    rows.append(i)
            who, signature, spare = signatures(sets, np.array(rows, np.int64))
            if len(who):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(signature)), pa.array(names[who]), pa.array(spare.astype(np.int32))],
                    ["sig", "class", "spare"],
                )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, class), the distinct ones whose sig has two classes or more.

    Holds one row back: the first of a group goes out when a second class appears.
    """
    held = None  # (sig, class, spare) of the first row of the open group, until it goes out
    last = None  # (sig, class) of the last row
    for batch in batches:
        sig, name, spare = (batch.column(c).to_numpy() for c in ("sig", "class", "spare"))
        if not len(sig):
            continue
        before = np.array([last[0] if last else 0, last[1] if last else 0], np.int64)
        old_sig = np.concatenate([before[:1], sig[:-1]])
        old_name = np.concatenate([before[1:], name[:-1]])
        starts = sig != old_sig
        if last is None:
            starts[0] = True
        new = starts | (name != old_name)
        sig, name, spare, starts = sig[new], name[new], spare[new], starts[new]
        last = (int(batch.column("sig")[-1].as_py()), int(batch.column("class")[-1].as_py()))
        if not len(sig):
            continue
        followed = np.concatenate([~starts[1:], [False]])
        keep = ~starts | followed
        parts = [sig[keep]], [name[keep]], [spare[keep]]
        if held is not None and not starts[0]:
            for part, value in zip(parts, held, strict=True):
                part.insert(0, np.array([value]))
            held = None
        if starts[-1]:
            held = (sig[-1], name[-1], spare[-1])
        elif starts.any() or held is not None:
            held = None
        out = [np.concatenate(p) for p in parts]
        if len(out[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0]), pa.array(out[1]), pa.array(out[2].astype(np.int32))],
                ["sig", "class", "spare"],
            )


def _slots(names: np.ndarray) -> np.ndarray:
    return (names.astype(np.int64) & (FILTER_BITS - 1)).astype(np.int64)


def _filter_table(names: DataFrame) -> np.ndarray:
    """A table of FILTER_BITS bits, set for the low bits of each `class`.

    At most FILTER_BITS / 64 rows reach the driver. A full table lets all sets
    through, which costs work and changes no result.
    """
    slot = names.select(F.col("class").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("s"))
    words = slot.groupBy(F.expr("s DIV 64").alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(s % 64 AS INT))")).alias("word")
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.collect():
        table[row["place"]] = row["word"]
    return table


def _set_emitter(table: np.ndarray):
    """Name and size of every set; its elements where `table` asks for them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column("text")):
                sets = shingles(piece)
                names = as_long(sets.names())
                slot = _slots(names)
                wanted = (table[slot >> 6] >> (slot & 63)) & 1 == 1
                bounds = zip(sets.offsets[:-1], sets.offsets[1:], wanted, strict=True)
                elements = [sets.hashes[a:b].tobytes() if w and b > a else None for a, b, w in bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(piece.first, len(piece)),
                        pa.array(names, mask=sets.sizes == 0),
                        pa.array(sets.sizes),
                        pa.array(elements, pa.binary()),
                    ],
                    ["key", "class", "n", "elements"],
                )

    return emit


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a = np.frombuffer(left[i].as_buffer(), np.uint64)
            b = np.frombuffer(right[i].as_buffer(), np.uint64)
            both = len(a) + len(b)
            common = both - len(np.union1d(a, b))
            keep[i] = OF * common >= SIMILAR * (both - common)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"]
        )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs `(a, b)` of classes whose sets are similar, by exact comparison."""
    left = sets.select(F.col("class").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("elements").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return durable(both.mapInArrow(_linked, "a bigint, b bigint"))


def _rarest(parts: DataFrame) -> DataFrame:
    """`parts` without the most frequent ones a class can spare.

    `parts` are distinct (part, class, spare, ...) of the parts that several classes
    have; those of one class alone come first in the order and need not be listed. If
    two classes share more parts than either can spare, then in any common order what
    is left of the two still shares one. Adds `place`: how far a part is from the most
    frequent one of its class, and `shared`: the parts a class is listed with.
    """
    often = parts.groupBy("part").agg(F.count(F.lit(1)).alias("classes"))
    own = Window.partitionBy("class", "spare")
    ranked = parts.join(often, "part").withColumns(
        {
            "place": F.row_number().over(own.orderBy(F.col("classes").desc(), "part")),
            "shared": F.count(F.lit(1)).over(own),
        }
    )
    return durable(ranked.where(F.col("place") > F.col("spare")).drop("classes"))


def _stars(kept: DataFrame) -> DataFrame:
    """One pair `(a, b)` for each class of a part: with the least class of the part."""
    hubs = kept.groupBy("part").agg(F.min("class").alias("hub"))
    pairs = kept.join(hubs, "part").where(F.col("hub") < F.col("class"))
    return durable(pairs.select(F.col("hub").alias("a"), F.col("class").alias("b")).distinct())


def _rooted(kept: DataFrame, roots: DataFrame) -> DataFrame:
    """`kept` with the component of each class, for the parts that lie in several components."""
    labelled = kept.join(roots, kept["class"] == roots["node"], "left").select(
        *kept.columns, F.coalesce("root", "class").alias("root")
    )
    several = labelled.groupBy("part").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return durable(labelled.join(several.where(F.col("low") != F.col("high")).select("part"), "part"))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every shingle of a class as a part of its own.

    A partner shares at least 4 / 5 of the shingles, so all but a fifth and one can be
    spared.
    """
    for batch in batches:
        raw = [b.as_buffer() for b in batch.column("elements")]
        sizes = np.array([len(b) // 8 for b in raw], np.int64)
        spare = -(-SIMILAR * sizes // OF) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.frombuffer(b, np.int64) for b in raw] or [np.zeros(0, np.int64)])),
                pa.array(np.repeat(batch.column("class").to_numpy(), sizes)),
                pa.array(np.repeat(spare, sizes).astype(np.int32)),
                pa.array(np.repeat(sizes, sizes)),
            ],
            ["part", "class", "spare", "size"],
        )


def _possible(a: str, b: str) -> Column:
    """Two sets may be similar, if this is the rarest shingle that both have.

    Of each set only this shingle and its more frequent ones, `place` in number, can
    then be in the intersection; linked sets share at least 4 / 9 of the sum of their
    sizes. Of a linked pair this holds at its rarest common shingle.
    """
    common = F.least(f"place{a}", f"place{b}")
    return common * DIFFERING >= (F.col(f"size{a}") + F.col(f"size{b}")) * SIMILAR


def _named(rows: DataFrame, mark: str) -> DataFrame:
    kept = ("class", "size", "place", *(["root"] if "root" in rows.columns else []))
    return rows.select("part", *[F.col(c).alias(f"{c}{mark}") for c in kept])


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(f"class{a}", f"class{b}").alias("a"), F.greatest(f"class{a}", f"class{b}").alias("b")]


def _centred_stars(kept: DataFrame) -> DataFrame:
    """Pairs of each class with the class of the part that has the fewest shingles of its own.

    Among near copies of one text that is the least edited one, which most others are
    similar to.
    """
    apart = ((F.col("size") - F.col("shared")) * 1_000_000 / F.col("size")).cast("bigint")
    hub = F.min(F.struct(apart.alias("apart"), "class", "size", "place")).alias("hub")
    hubs = kept.groupBy("part").agg(hub).select(
        "part", *[F.col(f"hub.{c}").alias(f"{c}_b") for c in ("class", "size", "place")]
    )
    pairs = _named(kept, "_a").join(hubs, "part")
    pairs = pairs.where(F.col("class_a") != F.col("class_b"))
    return durable(pairs.select(*_pair("_a", "_b")).distinct())


def _across(kept: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of classes of one part in different components that may be similar."""
    open_ = _rooted(kept, roots)
    pairs = _named(open_, "_a").join(_named(open_, "_b"), "part")
    pairs = pairs.where((F.col("root_a") < F.col("root_b")) & _possible("_a", "_b"))
    return pairs.select(*_pair("_a", "_b")).distinct()


def _links(kept: DataFrame, sets: DataFrame) -> DataFrame:
    """Links enough to connect all similar classes, from candidates that share a signature.

    A signature ties its classes to its least class: one pair for each member, never
    all pairs of a group. Only where it still joins several components, its classes
    are looked at more finely: each shingle is a partition of its own, and a class
    keeps its rarest fifth of them (and one). Each shingle ties its classes to the one
    that is least apart from the rest. What then still lies across components, and is
    not ruled out by the place of the common shingle, is compared pair by pair.
    """
    stars = _stars(kept)
    links = _verified(stars, sets)
    open_ = _rooted(kept, components(links)).select("class").distinct()
    fine = sets.join(open_, "class").select("class", "elements")
    parts = durable(fine.mapInArrow(_elements, "part bigint, class bigint, spare int, size bigint"))
    several = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("part")
    kept = _rarest(parts.join(several, "part"))
    more = durable(_centred_stars(kept).join(stars, ["a", "b"], "left_anti"))
    links = durable(links.unionByName(_verified(more, sets)))
    rest = _across(kept, components(links))
    rest = rest.join(stars.unionByName(more), ["a", "b"], "left_anti")
    return links.unionByName(_verified(rest, sets))


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Components of the documents whose shingle sets have a Jaccard similarity of 0.8 or more.

    Returns for every row `key, n_shingles, component_id`: the least key reachable by
    links, its own included. Equal sets form a class (named by a 64-bit hash) and are
    joined as one. Texts that are NULL or have no words have an empty set and are
    linked with nothing; a text of fewer than five words is one shingle. NULL keys are
    never the least unless all are NULL. Repeated rows are linked with each other. An
    empty table gives no rows.

    PartEnum: every class gets one signature for each nonempty partition of the shingle
    domain; linked classes share one. Of the shared signatures a class may leave out
    as many as it has to spare, and leaves out the most frequent (`_rarest`). What
    shares one of the rest is compared exactly (`_links`), as far as components need
    it, so that no link between different components is lost.
    """
    body = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    emitted = body.select("text").mapInArrow(_emit_signatures, "sig bigint, class bigint, spare int")
    dealt = emitted.repartition("sig").sortWithinPartitions("sig", "class")
    shared = durable(dealt.mapInArrow(_shared, "sig bigint, class bigint, spare int"))
    kept = _rarest(shared.withColumnRenamed("sig", "part"))

    # Only sets that some pair names have to move.
    named = kept.select("class").distinct()
    kind = docs.schema[key].dataType.simpleString()
    members = durable(
        body.mapInArrow(
            _set_emitter(_filter_table(named)), f"key {kind}, class bigint, n bigint, elements binary"
        )
    )
    sets = durable(
        members.where(F.col("elements").isNotNull()).groupBy("class").agg(F.any_value("elements").alias("elements"))
    )

    roots = components(_links(kept, sets))

    least = members.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("key").alias("key"))
    rooted = durable(
        least.join(roots, least["class"] == roots["node"], "left").select(
            "class", "key", F.coalesce("root", "class").alias("root")
        )
    )
    first = rooted.groupBy("root").agg(F.min("key").alias("component_id"))
    named = rooted.join(first, "root").select("class", "component_id")
    return members.join(named, "class", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "key").alias("component_id"),
    )
