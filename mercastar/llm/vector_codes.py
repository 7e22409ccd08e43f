"""Vectors as short codes: one byte for each part, the nearest entry of a codebook."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from mercastar.llm.columns import ROW, packed, quoted, unpacked
from mercastar.storage import drop_steps, durable, steps_mark

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

# A lower bound is kept for each group of entries of a part: 8 of 32 entries.
GROUPS = 8
# Bounds are compared with this slack, far above the rounding of square roots.
SLACK = 1e-9
# Numbers in one table of distances.
TABLE = 1 << 21
# Codebooks are kept for each vector length; the driver holds those of all lengths.
MOST_LENGTHS = 16

RESULTS = ("code", "error", "label_error", "codebooks_sha256")


def usable(vector: Column) -> Column:
    """True for vectors without NULL and non-finite components; empty ones are usable."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False))


def layout(parts: int) -> np.dtype:
    """What is kept of a vector between rounds: for each part its entry, and for each
    group of entries a lower bound on the distance to the others, with the number of
    the codebook the bound was measured with."""
    return np.dtype(
        [("entry", "u1", (parts,)), ("stamp", "u1", (parts, GROUPS)), ("low", "<f4", (parts, GROUPS))]
    )


def _below(x: np.ndarray) -> np.ndarray:
    """The next smaller or equal 32-bit floats."""
    out = x.astype(np.float32)
    return np.where(out > x, np.nextafter(out, np.float32(-np.inf)), out)


class PartHistory:
    """The codebooks of one part of the vectors, of all rounds so far."""

    def __init__(self, books: list[np.ndarray], biggest: int):
        width = books[0].shape[1]
        # Whole numbers below 2**53 are exact as floats, which multiply much faster.
        self.kind = np.float64 if width * (2 * biggest + 2) ** 2 < 1 << 53 else np.int64
        self.far = np.inf if self.kind is np.float64 else np.iinfo(np.int64).max
        self.books = [b.astype(self.kind) for b in books]
        self.now = len(books) - 1
        self.edges = np.linspace(0, len(books[0]), GROUPS + 1).astype(int)
        self.group = np.searchsorted(self.edges, np.arange(len(books[0])), side="right") - 1
        self.group = np.minimum(self.group, GROUPS - 1)
        self.compared = 0
        self._net_moves()

    def _net_moves(self) -> None:
        """The largest net displacement of each group since each earlier round, the entry
        that has it, and the largest of the others."""
        self.most = np.zeros((self.now, GROUPS))
        self.who = np.full((self.now, GROUPS), -1)
        self.next = np.zeros((self.now, GROUPS))
        last = self.books[self.now].astype(np.float64)
        for t in range(self.now):
            move = np.sqrt(((last - self.books[t].astype(np.float64)) ** 2).sum(axis=1))
            for g in range(GROUPS):
                own = move[self.edges[g] : self.edges[g + 1]]
                if len(own):
                    order = np.argsort(own)
                    self.most[t, g], self.who[t, g] = own[order[-1]], self.edges[g] + order[-1]
                    self.next[t, g] = own[order[-2]] if len(own) > 1 else 0

    def squares(self, x: np.ndarray, entries: slice) -> np.ndarray:
        """Squared distances of all rows to some entries of the present codebook."""
        c = self.books[self.now][entries]
        self.compared += len(x) * len(c)
        return (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)

    def _scan(self, x: np.ndarray, g: int, rows: np.ndarray, without: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of a group and its squared distance, one entry left out."""
        lo, hi = self.edges[g], self.edges[g + 1]
        square = self.squares(x[rows], slice(lo, hi))
        own = np.flatnonzero((without >= lo) & (without < hi))
        square[own, without[own] - lo] = self.far
        place = square.argmin(axis=1)
        return place + lo, square[np.arange(len(rows)), place]

    def first(self, x: np.ndarray, state: np.ndarray, part: int) -> np.ndarray:
        """Assign rows that have no bounds yet; returns the squared distances."""
        square = self.squares(x, slice(None))
        entry = square.argmin(axis=1)
        rows = np.arange(len(x))
        best = square[rows, entry]
        square[rows, entry] = self.far
        for g in range(GROUPS):
            lo, hi = self.edges[g], self.edges[g + 1]
            least = square[:, lo:hi].min(axis=1) if hi > lo else np.full(len(x), self.far)
            state["low"][:, part, g] = _below(self._root(least))
        state["entry"][:, part] = entry
        state["stamp"][:, part] = self.now
        return best

    def _root(self, square: np.ndarray) -> np.ndarray:
        return np.where(square == self.far, np.inf, np.sqrt(np.asarray(square, np.float64)))

    def again(self, x: np.ndarray, state: np.ndarray, part: int) -> np.ndarray:
        """Assign rows anew; returns the squared distances.

        A group is scanned only where its lower bound, less the net displacement of
        its entries since the bound's round, does not exceed the distance to the
        present entry. Equal distances are scanned, so ties go to the lower index.
        """
        entry = state["entry"][:, part].astype(np.int64)
        stamp, low = state["stamp"][:, part], state["low"][:, part]
        gap = x - self.books[self.now][entry]
        best = (gap * gap).sum(axis=1)
        groups = np.arange(GROUPS)
        moved = np.where(
            self.who[stamp, groups] == entry[:, None], self.next[stamp, groups], self.most[stamp, groups]
        )
        reach = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
        doubt = low.astype(np.float64) * (1 - SLACK) - moved * (1 + SLACK) <= reach[:, None]
        chosen, nearest = entry.copy(), best.copy()
        for g in range(GROUPS):
            rows = np.flatnonzero(doubt[:, g])
            if not len(rows) or self.edges[g] == self.edges[g + 1]:
                continue
            place, square = self._scan(x, g, rows, entry[rows])
            low[rows, g], stamp[rows, g] = _below(self._root(square)), self.now
            better = (square < nearest[rows]) | ((square == nearest[rows]) & (place < chosen[rows]))
            chosen[rows[better]], nearest[rows[better]] = place[better], square[better]
        # A new entry leaves the bound of its group, and the old one joins that of its own.
        changed = np.flatnonzero(chosen != entry)
        for g in range(GROUPS):
            rows = changed[(self.group[entry[changed]] == g) | (self.group[chosen[changed]] == g)]
            if len(rows):
                _, square = self._scan(x, g, rows, chosen[rows])
                low[rows, g], stamp[rows, g] = _below(self._root(square)), self.now
        state["entry"][:, part] = chosen
        return nearest


class Codebooks:
    """All codebooks so far, for each vector length and part; small enough for every task."""

    def __init__(self, parts: int):
        self.parts = parts
        self.books: dict[int, list[np.ndarray]] = {}  # by length, of each round (part, entry, place)
        self.biggest: dict[int, int] = {}

    def assign(self, x: np.ndarray, state: np.ndarray, fresh: bool) -> np.ndarray:
        """Assign all parts of some vectors of one length; returns squared distances."""
        books = self.books[x.shape[1]]
        width = books[0].shape[2]
        out = np.zeros((len(x), self.parts), np.int64)
        step = max(1, TABLE // max(books[0].shape[1], x.shape[1]))
        for p in range(self.parts):
            history = PartHistory([b[p] for b in books], self.biggest[x.shape[1]])
            mine = x[:, p * width : (p + 1) * width].astype(history.kind)
            for at in range(0, len(x), step):
                piece = slice(at, at + step)
                work = history.first if fresh else history.again
                out[piece, p] = work(mine[piece], state[piece], p)
        return out

    def sha256(self, length: int) -> str:
        numbers = ",".join(map(str, self.books[length][-1].ravel().tolist()))
        return hashlib.sha256(numbers.encode()).hexdigest()


def _by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length among the vectors of a batch."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[offsets[rows][:, None] + np.arange(size)]


def _states(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).copy()


def _assigning(books: Codebooks, fresh: bool) -> Callable:
    kind = layout(books.parts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = np.zeros(batch.num_rows, kind) if fresh else _states(batch.column("_state"), kind)
            for rows, x in _by_length(batch.column("_x")):
                mine = state[rows]
                books.assign(x, mine, fresh)
                state[rows] = mine
            kept = pa.array([s.tobytes() for s in state], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("_label"), batch.column("_x"), kept],
                [ROW, "_label", "_x", "_state"],
            )

    return work


def _coding(books: Codebooks) -> Callable:
    kind = layout(books.parts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = _states(batch.column("_state"), kind)
            error = np.zeros(batch.num_rows, np.int64)
            length = np.zeros(batch.num_rows, np.int64)
            for rows, x in _by_length(batch.column("_x")):
                mine = state[rows]
                error[rows] = books.assign(x, mine, fresh=False).sum(axis=1)
                state[rows], length[rows] = mine, x.shape[1]
            code = pa.array([e.tobytes().hex() for e in state["entry"]], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("_label"), code, pa.array(error), pa.array(length)],
                [ROW, "_label", "_code", "_error", "_length"],
            )

    return work


def _summing(parts: int, entries: int) -> Callable:
    """Component sums of the parts of each entry: a task sends one row for an entry it met."""
    kind = layout(parts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            state = _states(batch.column("_state"), kind)
            for rows, x in _by_length(batch.column("_x")):
                width = x.shape[1] // parts
                # One more place than components holds the number of parts.
                sums = total.setdefault(x.shape[1], np.zeros((parts, entries, width + 1), np.int64))
                for p in range(parts):
                    entry = state["entry"][rows, p]
                    np.add.at(sums[p, :, :width], entry, x[:, p * width : (p + 1) * width])
                    sums[p, :, width] += np.bincount(entry, minlength=entries)
        for length, sums in total.items():
            p, e = np.nonzero(sums[:, :, -1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(p), length, np.int64)),
                    pa.array(p.astype(np.int64)),
                    pa.array(e.astype(np.int64)),
                    pa.array(list(sums[p, e]), pa.list_(pa.int64())),
                ],
                ["length", "part", "entry", "sums"],
            )

    return work


def _start(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The first codebooks: the vectors of the smallest keys, for each length."""
    size = F.size("_x").cast("bigint")
    biggest = F.max(F.coalesce(F.array_max(F.transform("_x", F.abs)), F.lit(0)))
    found = rows.groupBy(size.alias("length")).agg(biggest.alias("biggest")).limit(MOST_LENGTHS + 1).collect()
    if len(found) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    books = Codebooks(parts)
    for length, most in sorted((r["length"], r["biggest"]) for r in found):
        if length * (2 * most + 2) ** 2 >= 1 << 63:
            raise ValueError(f"components up to {most} / {SCALE} make errors that no long can hold")
        first = rows.where(size == length).orderBy(F.asc_nulls_last("_key"), "_x").select("_x").limit(entries)
        chosen = [r["_x"] for r in first.collect()]
        x = np.array(chosen, np.int64).reshape(len(chosen), length)
        books.books[length] = [x.reshape(len(x), parts, length // parts).transpose(1, 0, 2).copy()]
        books.biggest[length] = most
    return books


def _replace_entries(state: DataFrame, books: Codebooks, entries: int) -> None:
    """Add the codebook of the next round: the floored means of the assigned parts."""
    partial = state.select("_x", "_state").mapInArrow(
        _summing(books.parts, entries), "length bigint, part bigint, entry bigint, sums array<bigint>"
    )
    longest = max(books.books) // books.parts + 1
    by_place = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(longest)]
    total = partial.groupBy("length", "part", "entry").agg(*by_place).collect()  # one row an entry
    for length, rounds in books.books.items():
        rounds.append(rounds[-1].copy())
        width = length // books.parts
        for r in total:
            if r["length"] == length:
                sums = [r[f"s{i}"] for i in range(width + 1)]
                rounds[-1][r["part"], r["entry"]] = [s // sums[width] for s in sums[:width]]


def compress(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Codes of vectors by codebooks fitted over all of them.

    A component x counts as the whole number floor(1024 x); vectors are cut into
    `parts` equal parts. The codebook of a part starts as that part of the vectors
    with the `entries` smallest keys. Each round assigns every part to its nearest
    entry (squared Euclidean distance, ties to the lower index) and replaces entries
    by the floored means of their parts; unused ones stay. A last assignment follows.
    All of it is exact.

    Rounds after the first keep what is known: for each part and each of 8 groups of
    entries a lower bound on the distance, stamped with the round it was measured in.
    Since the codebooks of all rounds are kept, the bound shrinks by the true net
    displacement of the group's entries from that round to now (a norm of a sum of
    steps), which is at most the sum of the steps' norms. A group is compared exactly
    only where that bound does not settle it.

    Returns the columns of `df` without the vector, then `code` (two hex digits a
    part), `error` (squared distances summed over the parts), `label_error` (error
    summed over equal labels, NULLs together) and `codebooks_sha256` (all final
    entries); columns of those names in `df` are replaced.

    Vectors that are NULL or hold NULL or non-finite components are left out. Fewer
    vectors than entries make a smaller codebook. Repeated keys and rows are rows of
    their own (the first entries are chosen by key, then components; NULL keys come
    last). Each vector length has codebooks of its own, for up to 16 lengths; a length
    that `parts` does not divide is filled up with zeros, empty vectors have code 00...
    and no error. An empty table gives no rows. Components so large that an error
    could leave the range of a long are refused.

    A round is one scan that writes vectors and bounds, and one that sends a row for
    each entry from each task; only codebooks reach the driver. No rows are grouped.
    """
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("entries must be 1 to 256 and parts positive")
    mark = steps_mark()
    kept = [c for c in df.columns if c != vector]
    value = F.col(quoted(vector)).cast("array<double>")
    missing = F.pmod(-F.size(value), F.lit(parts))
    filled = F.concat(value, F.array_repeat(F.lit(0.0), missing))
    # Beyond 2**40 floor() is not asked: such vectors are refused by their size.
    whole = F.transform(filled, lambda x: F.floor(F.greatest(F.least(x, F.lit(2.0**40)), F.lit(-(2.0**40))) * SCALE))
    good = df.where(usable(F.col(quoted(vector)).cast("array<double>")))
    rows = packed(good, _key=F.col(quoted(key)), _label=F.col(quoted(label)), _x=whole).withColumn(
        ROW, F.struct(*[F.col(ROW)[c].alias(c) for c in kept])
    )
    rows = durable(rows)
    books = _start(rows, parts, entries)
    if not books.books:
        nothing = dict.fromkeys(RESULTS, F.lit(None).cast("string")) | {
            "error": F.lit(None).cast("bigint"), "label_error": F.lit(None).cast("bigint")
        }
        return unpacked(rows, kept, **nothing)

    rows = rows.drop("_key")
    shape = StructType([*rows.schema.fields, StructField("_state", BinaryType())])
    state = durable(rows.mapInArrow(_assigning(books, fresh=True), shape))
    for done in range(rounds):
        if done:
            state = durable(state.mapInArrow(_assigning(books, fresh=False), shape))
        drop_steps(df.sparkSession, mark, keep=1)
        _replace_entries(state, books, entries)

    final = StructType(
        [
            *rows.schema.fields[:2],
            StructField("_code", StringType()),
            StructField("_error", LongType()),
            StructField("_length", LongType()),
        ]
    )
    coded = durable(state.mapInArrow(_coding(books), final))
    by_label = durable(coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("_error").alias("_label_error")))
    digest = F.coalesce(*[F.when(F.col("_length") == n, books.sha256(n)) for n in books.books])
    joined = coded.join(by_label, F.col("_label").eqNullSafe(F.col("_of")))
    drop_steps(df.sparkSession, mark, keep=2)
    return unpacked(
        joined,
        kept,
        code=F.col("_code"),
        error=F.col("_error"),
        label_error=F.col("_label_error"),
        codebooks_sha256=digest,
    )
