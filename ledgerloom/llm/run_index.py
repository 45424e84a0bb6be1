"""A run-length index: run-compressed Burrows-Wheeler transform of some texts with sampled run ends.

Within a run of equal symbols of the transform, the suffixes one symbol longer are neighbours too, so
neighbour and common length of a suffix need to be kept at the starts of runs only: going on in a
text, the neighbour moves along and the common length falls by one, until the next sampled place. In
repetitive texts there are far fewer runs than symbols.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

class RunIndex:
    """The index of a list of byte strings; a separator smaller than any byte ends each of them."""

    def __init__(self, texts: Sequence[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        n = int(sizes.sum()) + len(texts)
        whole = b"\0".join(texts) + b"\0"
        symbols = np.frombuffer(whole, np.uint8).astype(np.int16) + 1
        symbols[self.starts + sizes] = 0
        self.symbols = symbols
        padded = whole + b"\0" * 8
        self.words = np.ndarray(n, "<u8", padded, 0, (1,)).astype(np.uint64)
        self.rest = np.repeat(self.starts + sizes, sizes + 1) - np.arange(n)
        order = self._suffixes()
        before = symbols[order - 1]  # the transform; the first text is preceded by the last separator
        head = np.r_[True, (before[1:] != before[:-1]) | (before[1:] == 0)]
        rows = np.flatnonzero(head)
        self.runs = len(rows)
        self.sampled = order[rows]
        self.neighbour = np.r_[order[:1], order[rows[1:] - 1]]
        self.common = self._common(self.sampled, self.neighbour)
        self.common[0] = 0

    def _suffixes(self) -> np.ndarray:
        """Suffix array by prefix doubling; equal suffixes are ordered by position, as separators
        that grow with the position would have it. The first sort compares as many symbols as one
        integer holds."""
        n = len(self.symbols)
        used = np.unique(self.symbols)
        dense = np.zeros(257, np.int64)
        dense[used[used > 0]] = np.arange(1, (used > 0).sum() + 1)
        code = dense[self.symbols]
        bits = int(code.max(initial=1)).bit_length()
        reach = 62 // bits
        key, alive = code.copy(), code > 0
        for t in range(1, reach):
            symbol = np.zeros(n, np.int64)
            symbol[:n - t] = code[t:]
            symbol *= alive
            key = (key << bits) | symbol
            alive = symbol > 0
        # a rank is the first place of equal ones; only those that are not alone are sorted again
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        places, first = np.arange(n), self._first(ordered)
        rank[order] = first
        while True:
            alone = np.diff(first, prepend=-1) != 0
            alone &= np.diff(first, append=n) != 0
            places = places[~alone]
            places = places[self.rest[order[places]] >= reach]  # shorter ones are equal to the end
            if not len(places):
                break
            open_ = order[places]
            key = rank[open_] * (n + 1) + rank[open_ + reach] + 1
            by = np.argsort(key)
            order[places] = open_ = open_[by]
            first = places[self._first(key[by])]
            rank[open_] = first
            reach *= 2
        return np.argsort(rank * n + np.arange(n))

    @staticmethod
    def _first(ordered: np.ndarray) -> np.ndarray:
        """For each value of a sorted list the place of its first equal."""
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))

    def _common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the common start of pairs of suffixes, up to the separators, by eight bytes."""
        length = np.zeros(len(left), np.int64)
        most = np.minimum(self.rest[left], self.rest[right])
        at = np.flatnonzero((left != right) & (most > 0))
        while len(at):
            differ = self.words[left[at] + length[at]] ^ self.words[right[at] + length[at]]
            lowest = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1).astype(float)).astype(np.int64) // 8)
            length[at] += same
            at = at[(differ == 0) & (length[at] < most[at])]
        return np.minimum(length, most)

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the texts, the place of the suffix sorted before it and the length that
        both have in common, streamed from the samples."""
        n = len(self.symbols)
        sample = np.full(n, -1, np.int64)
        sample[self.sampled] = np.arange(self.runs)
        last = np.maximum.accumulate(np.where(sample >= 0, np.arange(n), -1))
        gone = np.arange(n) - last
        sample = sample[last]
        return self.neighbour[sample] + gone, self.common[sample] - gone

    def repeated(self, length: int) -> np.ndarray:
        """The places, ascending, whose next `length` bytes also stand at an earlier place."""
        place, common = self.statistics()
        n = len(self.symbols)
        root = np.where(common >= length, place, np.arange(n))
        while True:  # all places with the same bytes hang together, one before the other
            above = root[root]
            if (above == root).all():
                break
            root = above
        places = np.flatnonzero(self.rest >= length)
        _, first = np.unique(root[places], return_index=True)
        return np.delete(places, first)
