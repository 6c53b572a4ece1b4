"""Words of slices of UTF-8 text for the classifiers: distinct words, and hashed features of each."""

from __future__ import annotations

import numpy as np

from bookflow.llm.common import Rolling, mix, runs

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the accented letters of Western European languages."""
    out = _LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[accented] += 0x20
    return out


class Words:
    """The words (runs of letters; all characters beyond ASCII count as letters) of the texts of a slice."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data = fold(data)
        self.start, self.end, self.row = runs(_LETTER[data], off)
        self.rolling = Rolling(self.data)
        hashes = self.rolling.ranges(self.start, self.end)
        self.hash, first, self.inverse = np.unique(hashes, return_index=True, return_inverse=True)
        self.first, self.last = self.start[first], self.end[first]  # a place of each distinct word
        self.count = np.bincount(self.row, minlength=len(off) - 1)

    def affixes(self, sizes, kind: int, suffix: bool = False) -> np.ndarray:
        """A column of hashes for each size: the distinct words' first (or last) bytes, the whole of shorter words."""
        size = self.last - self.first
        out = []
        for s in sizes:
            n = np.minimum(s, size)
            h = self.rolling.ranges(self.last - n, self.last) if suffix else self.rolling.ranges(self.first, self.first + n)
            out.append(mix(h + np.uint64(1000 * (kind + 1) + s)))
        return np.stack(out, axis=1)

    def ngrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all byte trigrams of the distinct words, with a mark before and after; and where each word's begin."""
        size = self.last - self.first
        padded = np.concatenate(([0], self.data, [0])).astype(np.uint64)
        begin = np.cumsum(size) - size
        index = np.arange(size.sum()) - np.repeat(begin, size)
        at = np.repeat(self.first, size) + index + 1
        left = np.where(index == 0, 0, padded[at - 1])
        right = np.where(index == np.repeat(size - 1, size), 0, padded[at + 1])
        return mix((left.astype(np.uint64) << np.uint64(16)) | (padded[at] << np.uint64(8)) | right.astype(np.uint64)), begin
