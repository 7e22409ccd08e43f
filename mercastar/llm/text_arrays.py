"""Whole Arrow columns of text as flat byte arrays, for the operators that run numpy.

All functions work on a slice of a column: the bytes of its texts laid end to end,
and the offsets of the texts in them. Slices are cut by bytes, so that memory does
not depend on how long the texts of a batch are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Arrays over a slice hold 8 bytes or more for a byte of text, a dozen of them at once.
SLICE_BYTES = 1 << 18

# Multipliers of the 64-bit hashes: odd, arbitrary, fixed so that results repeat.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


@dataclass
class Slice:
    """Rows `first` to `first + len(offsets) - 1` of a column."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string or binary column into slices of about `limit` bytes.

    NULL counts as empty. A text longer than `limit` is a slice of its own.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, raw, body = column.buffers()
    offsets = np.frombuffer(raw, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        low, high = int(offsets[row]), int(offsets[end])
        yield Slice(row, data[low:high], offsets[row : end + 1] - low)
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n, kept for later calls."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 4096)
        for name, base in (("up", BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class SpanHash:
    """64-bit hashes of any spans of one byte array, by prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self._down = _power(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * MIX_1)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False


def words(piece: Slice, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and how many each text has.

    `inside[b]` tells whether byte b belongs to a word. Texts are separate: a word
    never runs over the end of its text.
    """
    n = len(piece.data)
    mask = np.zeros(n + 2, bool)
    mask[1:-1] = inside[piece.data]
    change = mask[1:] != mask[:-1]
    borders = piece.offsets[(piece.offsets > 0) & (piece.offsets < n)]
    split = np.unique(borders[mask[borders] & mask[borders + 1]])  # a word on both sides
    starts = np.flatnonzero(change[:-1] & mask[1:-1])
    ends = np.flatnonzero(change & mask[:-1])
    if len(split):
        starts = np.union1d(starts, split)
        ends = np.union1d(ends, split)
    counts = np.diff(np.searchsorted(starts, piece.offsets, side="left"))
    return starts, ends, counts


def as_long(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed number, as Spark stores it."""
    return x.astype(np.uint64, copy=False).view(np.int64)
