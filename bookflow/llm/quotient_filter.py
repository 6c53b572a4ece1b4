"""Counting quotient filters over packed n-grams of 64-bit word ids: lossless, sorted, compact, merged by one pass.

An n-gram is 64 * n bits. An invertible permutation (a Feistel network) spreads it evenly; its leading bits are the
block (which filter) and the quotient (which run of that filter), both implied by the place, and only the full
remainder of the bits is stored, so every n-gram is read back exactly. Counters take a byte; the few beyond that have
wide ones of their own.
"""

from __future__ import annotations

import numpy as np

from bookflow.llm.common import mix

_ROUND = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD)]


def permute(words: list[np.ndarray]) -> list[np.ndarray]:
    """The n-grams (a column of ids for each word) as well mixed limbs; one-to-one. The first limb is worked out last."""
    limbs, n = [w.copy() for w in words], len(words)
    if n == 1:
        return [mix(limbs[0])]
    for k in range(2 * n):
        i = (k + 1) % n
        limbs[i] ^= mix((limbs[(i + 1) % n] ^ _ROUND[k]) + (limbs[(i + 2) % n] if n > 2 else np.uint64(0)))
    return limbs


def restore(limbs: list[np.ndarray]) -> list[np.ndarray]:
    """The n-grams that ``permute`` made ``limbs`` of (two words or more)."""
    words, n = [x.copy() for x in limbs], len(limbs)
    for k in reversed(range(2 * n)):
        i = (k + 1) % n
        words[i] ^= mix((words[(i + 1) % n] ^ _ROUND[k]) + (words[(i + 2) % n] if n > 2 else np.uint64(0)))
    return words


class Filter:
    """Distinct permuted n-grams in ascending order with their counts."""

    def __init__(self, limbs: list[np.ndarray], counts: np.ndarray):
        self.limbs, self.counts = limbs, counts

    @classmethod
    def of(cls, limbs: list[np.ndarray], counts: np.ndarray | None = None) -> Filter:
        """The filter of permuted n-grams in any order, repeats added up."""
        order = np.argsort(limbs[0], kind="stable")
        limbs = [x[order] for x in limbs]
        first = limbs[0][1:] != limbs[0][:-1]
        same = np.ones(len(first), bool)
        for x in limbs[1:]:
            same &= x[1:] == x[:-1]
        if (~first & ~same).any():  # equal first limbs of different n-grams
            again = np.lexsort(limbs[::-1])
            limbs, order = [x[again] for x in limbs], order[again]
            same = np.ones(len(first), bool)
            for x in limbs:
                same &= x[1:] == x[:-1]
            first = ~same
        start = np.flatnonzero(np.concatenate(([True], first))) if len(order) else np.zeros(0, np.int64)
        if counts is None:
            total = np.diff(np.append(start, len(order)))
        else:
            total = np.add.reduceat(counts[order], start) if len(start) else counts[:0]
        return cls([x[start] for x in limbs], total.astype(np.int64))

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        return cls.of([np.concatenate(x) for x in zip(*(f.limbs for f in filters))], np.concatenate([f.counts for f in filters]))

    def blocks(self, bits: int):
        """(block, filter) of each block that has an n-gram; a block is the first ``bits`` bits."""
        if not len(self.counts):
            return
        block = (self.limbs[0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(self.counts), np.int64)
        start = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        for a, b in zip(start.tolist(), np.append(start[1:], len(block)).tolist()):
            yield int(block[a]), Filter([x[a:b] for x in self.limbs], self.counts[a:b])

    def pack(self, bits: int) -> bytes:
        """The filter of one block of ``bits`` bits: a run length for each quotient, remainders, counters."""
        n = len(self.counts)
        q = max(0, min(int(n).bit_length() - 1, 64 - bits - 8))
        rest = 64 - bits - q
        low = self.limbs[0] << np.uint64(bits) >> np.uint64(bits) if bits else self.limbs[0]
        quotient = (low >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(n, np.int64)
        length = np.bincount(quotient, minlength=1 << q)
        wide = 1 if length.max(initial=0) < 256 else 8
        size = -(-rest // 8)
        remainder = (low if rest == 64 else low & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :size]
        over = np.flatnonzero(self.counts > 255)
        small = np.minimum(self.counts, 255).astype(np.uint8)
        head = np.array([len(self.limbs), n, q, rest, wide, len(over)], "<u4")
        return b"".join([head.tobytes(), length.astype(f"<u{wide}").tobytes(), np.ascontiguousarray(remainder).tobytes(),
                         *(x.astype("<u8").tobytes() for x in self.limbs[1:]), small.tobytes(),
                         over.astype("<u4").tobytes(), self.counts[over].astype("<i8").tobytes()])

    @classmethod
    def unpack(cls, raw: bytes, block: int, bits: int) -> Filter:
        words, n, q, rest, wide, many = np.frombuffer(raw, "<u4", 6).tolist()
        at = 24

        def take(kind, number):
            nonlocal at
            out = np.frombuffer(raw, kind, number, at)
            at += out.nbytes
            return out

        length = take(f"<u{wide}", 1 << q)
        size = -(-rest // 8)
        remainder = np.zeros((n, 8), np.uint8)
        remainder[:, :size] = take(np.uint8, n * size).reshape(n, size)
        first = remainder.view("<u8").ravel().copy()
        if rest < 64:
            first |= np.repeat(np.arange(1 << q, dtype=np.uint64), length) << np.uint64(rest)
        if bits:
            first |= np.uint64(block) << np.uint64(64 - bits)
        limbs = [first, *(take("<u8", n).copy() for _ in range(words - 1))]
        counts = take(np.uint8, n).astype(np.int64)
        over = take("<u4", many)
        counts[over] = take("<i8", many)
        return cls(limbs, counts)
