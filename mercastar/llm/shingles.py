"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from mercastar.llm.text_arrays import BASE, LOWER, MIX_2, NOT_SPACE, Slice, SpanHash, mix, words

WORDS = 5
_STEPS = mix(np.arange(101, 101 + WORDS, dtype=np.uint64) * BASE) | np.uint64(1)


@dataclass
class Shingles:
    """Distinct shingle hashes of each text of a slice, ascending within a text."""

    hashes: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of `values`, one for each hash, over each text."""
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def names(self) -> np.ndarray:
        """A 64-bit name of each set: equal for equal sets."""
        first = self.sums(mix(self.hashes))
        second = self.sums(mix(self.hashes ^ MIX_2))
        return mix(first ^ mix(second + self.sizes.astype(np.uint64)))


def shingles(piece: Slice) -> Shingles:
    """Sets of WORDS-word shingles; a shorter text is one shingle, an empty one none.

    Words are runs of bytes other than blank and 0x09 to 0x0D; A-Z count as a-z.
    """
    data = LOWER[piece.data]
    starts, ends, counts = words(Slice(piece.first, data, piece.offsets), NOT_SPACE)
    word = SpanHash(data).of(starts, ends)
    n = len(word)
    long = np.zeros(max(n - WORDS + 1, 0), np.uint64)
    for step, factor in enumerate(_STEPS):
        long += word[step : step + len(long)] * factor
    long = mix(long + np.uint64(WORDS))
    first = np.concatenate([[0], np.cumsum(counts)])
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            own = np.sort(long[a : b - WORDS + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            total = (word[a:b] * _STEPS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix(np.array([total], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return Shingles(np.concatenate(sets) if sets else np.zeros(0, np.uint64), offsets)
