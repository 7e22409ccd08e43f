"""Global ranks without a single-task sort, and tiles without a sort."""

from __future__ import annotations

import os
from collections.abc import Hashable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from mercastar.storage import durable

# monotonically_increasing_id keeps the partition above these bits.
ROW_BITS = 33

# Cells of one histogram, and texts that are looked at one by one.
CELLS = 1 << 14
FEW = 20_000
# Larger numbers are divided as decimals: doubles and longs would not be exact.
WIDE = 1 << 52


def global_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Zero-based position of every row in the total order given by `order`.

    Rows are range-partitioned and sorted in place, so the position is the row's
    place in its partition plus the sizes of the partitions before it. `order`
    must be unique over the rows; then ties in its first columns, however many,
    are still spread over partitions. Range bounds come from a sample, so the
    placed rows are stored before they are read twice.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_slot", ROW_BITS).alias("_part")
    placed = placed.select("*", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: at most `parts` rows are windowed and broadcast.
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + inside).alias(name)
    )


def _tile_starts(size: int, tiles: int) -> list[int]:
    """Zero-based positions at which tiles 2 to `tiles` begin, as NTILE cuts them."""
    base, larger = divmod(size, tiles)
    return [t * base + min(t, larger) for t in range(1, tiles) if t * base + min(t, larger) < size]


@dataclass
class _Search:
    """The row at `rank` (from 0) of a group, by a whole number between `low` and `high`."""

    group: int
    low: int
    high: int
    rank: int
    ties: int = 0  # rows with the number found


def _counts(df: DataFrame, cells: dict[Hashable, tuple[Column, Column]]) -> dict[Hashable, dict]:
    """For each (condition, cell): rows by cell. All are counted in one job."""
    out: dict[Hashable, dict] = {name: {} for name in cells}
    if not cells:
        return out
    names = list(cells)
    met = [
        F.struct(F.lit(i).alias("of"), F.when(among, cell).alias("cell")) for i, (among, cell) in enumerate(cells.values())
    ]
    rows = df.select(F.inline(F.array(*met))).where(F.col("cell").isNotNull())
    counted = rows.groupBy("of", "cell").agg(F.count(F.lit(1)).alias("n")).toArrow()
    for of, cell, n in zip(*(counted.column(c).to_pylist() for c in ("of", "cell", "n")), strict=True):
        out[names[of]][cell] = n
    return out


def _walk(counts: dict, rank: int, key=None) -> tuple:
    """The cell that holds the row at `rank`, and its rank and the rows in that cell."""
    for cell in sorted(counts, key=key):
        if rank < counts[cell]:
            return cell, rank, counts[cell]
        rank -= counts[cell]
    raise ValueError("fewer rows than the rank")


def _find_numbers(df: DataFrame, groups: list[tuple[Column, Column]], searches: list[_Search]) -> None:
    """Narrow each search down to one number, CELLS cells at a time, all in one job a step.

    `groups` are (condition, number); searches of one group and range share its counts.
    """
    while open_ones := [s for s in searches if s.low < s.high or not s.ties]:
        cells = {}
        for s in open_ones:
            among, x = groups[s.group]
            width = (s.high - s.low) // CELLS + 1
            inside = among & x.between(F.lit(s.low), F.lit(s.high))
            cells[s.group, s.low, s.high] = (inside, F.floor((x - F.lit(s.low)) / F.lit(width)).cast("int"))
        counts = _counts(df, cells)
        for s in open_ones:
            width = (s.high - s.low) // CELLS + 1
            cell, s.rank, s.ties = _walk(counts[s.group, s.low, s.high], s.rank)
            s.low += cell * width
            s.high = min(s.high, s.low + width - 1)


def _find_texts(df: DataFrame, text: Column, groups: list[tuple[Column, int]], wanted: list[tuple[int, int]]) -> list[str]:
    """For each wanted (group, rank): the text at that rank, by its first characters.

    `groups` are (condition, rows). Characters that all texts of a group share are
    passed over; then two at a time are counted, until few enough texts are left to be
    looked at.
    """
    found: dict[tuple[int, int], str] = {}
    # Where each search stands: its group, the characters it has so far, rank and rows left.
    now = {w: (w[0], "", w[1], groups[w[0]][1]) for w in wanted}

    def among(group: int, prefix: str) -> Column:
        return groups[group][0] & text.startswith(prefix) if prefix else groups[group][0]

    while now:
        places = {(g, prefix): n for g, prefix, _, n in now.values()}
        few = {p: (among(*p), text) for p, n in places.items() if n <= FEW}
        texts = _counts(df, few)  # at most FEW texts a place
        many = [p for p in places if p not in few]
        if many:
            facts = [f(F.when(among(*p), text)).alias(f"{f.__name__}{i}") for i, p in enumerate(many) for f in (F.min, F.max)]
            seen = df.agg(*facts).first()
            shared = {p: os.path.commonprefix([seen[f"min{i}"], seen[f"max{i}"]]) for i, p in enumerate(many)}
            cells = _counts(df, {p: (among(*p), F.substring(text, len(shared[p]) + 1, 2)) for p in many})
        for w, (group, prefix, rank, _) in list(now.items()):
            place = (group, prefix)
            if place in few:
                found[w] = _walk(texts[place], rank, str.encode)[0]
                continue
            cell, rank, n = _walk(cells[place], rank, str.encode)
            now[w] = (group, shared[place] + cell, rank, n)
            if len(cell) < 2:  # a text that ends here; it is the only one
                found[w] = shared[place] + cell
        now = {w: state for w, state in now.items() if w not in found}
    return [found[w] for w in wanted]


def _find_entities(df: DataFrame, entity: str, groups: list[tuple[Column, int]], wanted: list[tuple[int, int]]) -> list:
    """For each wanted (group, rank): the entity at that rank, in ascending order."""
    if not wanted:
        return []
    kind = df.schema[entity].dataType
    column = F.col(entity)
    if isinstance(kind, StringType):
        return _find_texts(df, column, groups, wanted)
    if not isinstance(kind, IntegralType):
        raise TypeError(f"no tiles by entities of {kind.simpleString()}")
    bounds = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    wide = max(abs(bounds["low"]), abs(bounds["high"])) >= WIDE
    number = column.cast("decimal(30,0)" if wide else "bigint")
    searches = [_Search(g, bounds["low"], bounds["high"], rank) for g, rank in wanted]
    _find_numbers(df, [(among, number) for among, _ in groups], searches)
    return [s.low for s in searches]


def global_ntile(
    df: DataFrame, entity: str, scores: dict[str, tuple[str, bool]], tiles: int
) -> DataFrame:
    """Add NTILE columns over the whole table, without sorting or moving it.

    `scores` maps an output column to (numeric column, ascending). Ties are ordered by
    `entity`, which must be unique and a whole number or a text. The rows at which tiles
    begin, at most `tiles - 1` for a score, are found by counting: histograms of the
    values, each over the cell of the one before, lead to the value of such a row, and
    histograms of the entities among its ties to the entity. Every other row finds its
    tile by comparing itself with them, where it is. A step is one scan with at most
    CELLS counts for each search, whatever the values are, and a value shared by most
    rows is one cell among others. `df` is read several times, so store it if it is
    costly.
    """
    cents = {}  # values in hundredths, in the order of the score; NULL comes first
    for out, (column, ascending) in scores.items():
        value = (F.col(column).cast("decimal(20,2)") * 100).cast("decimal(22,0)")
        cents[out] = value if ascending else -value
    facts = [F.count(F.lit(1)).alias("rows")]
    for i, value in enumerate(cents.values()):
        facts += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"low{i}"), F.max(value).alias(f"high{i}")]
    seen = df.agg(*facts).first()
    starts = _tile_starts(seen["rows"], tiles)
    missing = {out: seen["rows"] - seen[f"n{i}"] for i, out in enumerate(scores)}

    searches = [
        _Search(i, int(seen[f"low{i}"]), int(seen[f"high{i}"]), start - missing[out])
        for i, out in enumerate(scores)
        for start in starts
        if start >= missing[out]
    ]
    wide = any(max(abs(s.low), abs(s.high)) >= WIDE for s in searches)
    cents = {out: value.cast("decimal(30,0)" if wide else "bigint") for out, value in cents.items()}
    _find_numbers(df, [(value.isNotNull(), value) for value in cents.values()], searches)

    # Where tiles begin: (score, value, rank among its ties, ties).
    cuts = [(out, None, start, missing[out]) for out in scores for start in starts if start < missing[out]]
    cuts += [(list(scores)[s.group], s.low, s.rank, s.ties) for s in searches]

    def tied(out: str, value: int | None) -> Column:
        return cents[out].isNull() if value is None else cents[out].eqNullSafe(F.lit(value))

    # A tile that begins with the first of its ties takes all of them.
    inner = [c for c in cuts if c[2] > 0]
    groups = list(dict.fromkeys((out, value, ties) for out, value, _, ties in inner))
    wanted = [(groups.index((out, value, ties)), rank) for out, value, rank, ties in inner]
    entities = _find_entities(df, entity, [(tied(out, value), ties) for out, value, ties in groups], wanted)
    firsts = dict(zip(inner, entities, strict=True))
    tiled = df
    for out in scores:
        tile = F.lit(1)
        for cut in (c for c in cuts if c[0] == out):
            value = cents[out]
            above = value.isNotNull() if cut[1] is None else value > F.lit(cut[1])
            first = tied(out, cut[1])
            if cut in firsts:
                first = first & (F.col(entity) >= F.lit(firsts[cut]))
            tile = tile + (F.coalesce(above, F.lit(False)) | F.coalesce(first, F.lit(False))).cast("int")
        tiled = tiled.withColumn(out, tile)
    return tiled
