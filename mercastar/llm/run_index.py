"""A run-length index of a collection of short texts, and matches read from it."""

from __future__ import annotations

import numpy as np

END = 0xFF  # ends each text; not a byte of UTF-8
FIRST = 4  # bytes compared by the first sort


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform with samples at the ends of its runs.

    Texts are laid end to end, each closed by an end mark of its own rank, so no match
    runs over the end of a text. The transform is kept as `symbols` and `lengths` of
    its runs; for the first and last place of each run the text position is sampled,
    with the length of the match to the lexicographic neighbour outside the run.
    Inside a run those lengths follow from the text position before: each is one less.
    """

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        self.starts = np.cumsum(lengths) - lengths
        self.text = np.full(int(lengths.sum()), END, np.uint8)
        for start, text in zip(self.starts, texts, strict=True):
            self.text[start : start + len(text)] = text
        self._owner = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
        self._left = np.repeat(self.starts + lengths - 1, lengths) - np.arange(len(self.text))
        order = self._sorted()
        symbols = self.text[order - 1]
        breaks = (symbols[1:] != symbols[:-1]) | (symbols[1:] == END)
        heads = np.flatnonzero(np.concatenate([[True], breaks]))
        tails = np.concatenate([heads[1:], [len(order)]]) - 1
        self.symbols, self.lengths = symbols[heads], tails - heads + 1
        self.head_at, self.tail_at = order[heads], order[tails]
        self.head_match = np.zeros(len(heads), np.int64)
        self.head_match[1:] = self._common(order[heads[1:]], order[heads[1:] - 1])
        self.tail_match = np.concatenate([self.head_match[1:], [0]])
        del self._ranks, self._owner, self._left

    def _sorted(self) -> np.ndarray:
        """Text positions in the order of their suffixes, by ranks of growing prefixes."""
        n = len(self.text)
        padded = np.concatenate([self.text, np.full(FIRST, END, np.uint8)]).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for i in range(FIRST):
            byte = np.where(self._left >= i, padded[i : i + n], np.uint64(END))
            key = (key << np.uint64(8)) | byte
        # A prefix that holds an end mark belongs to one text.
        key = (key << np.uint64(32)) | np.where(self._left < FIRST, self._owner + np.uint64(1), np.uint64(0))
        self._ranks: list[tuple[int, np.ndarray]] = []
        width = FIRST
        fold, shift = (3, 21) if n < 1 << 21 else (2, 31)
        while True:
            order = np.argsort(key)
            new = key[order]
            rank = np.zeros(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(new[1:] != new[:-1])])
            self._ranks.append((width, rank.astype(np.int32)))
            if rank[order[-1]] == n - 1:
                return order
            key = rank.astype(np.uint64)
            for step in range(1, fold):
                later = np.zeros(n, np.uint64)
                if step * width < n:
                    later[: n - step * width] = rank[step * width :]
                # Beyond the end of its text a prefix is already told apart.
                key = (key << np.uint64(shift)) | later
            width *= fold

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and at b."""
        n = len(self.text)
        length = np.zeros(len(a), np.int64)
        for width, rank in reversed(self._ranks):
            going = np.arange(len(a))
            while len(going):
                i, j = a[going] + length[going], b[going] + length[going]
                inside = (i < n) & (j < n)
                going, i, j = going[inside], i[inside], j[inside]
                going = going[rank[i] == rank[j]]
                length[going] += width
        for _ in range(FIRST - 1):
            i, j = a + length, b + length
            same = (i < n) & (j < n)
            i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
            same &= (self.text[i] == self.text[j]) & (self.text[i] != END)
            if not same.any():
                break
            length += same
        return length

    def matches(self) -> np.ndarray:
        """Matching statistics of the texts, each against all the rest.

        For every text position the length of the longest match that also starts
        elsewhere. The text is streamed once from left to right: a sampled position
        takes its sampled length, any other one less than the position before.
        """
        place = np.arange(len(self.text))
        longest = np.zeros(len(self.text), np.int64)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            reach = np.full(len(self.text), -1, np.int64)
            reach[at] = match + at
            longest = np.maximum(longest, np.maximum.accumulate(reach) - place)
        return longest
