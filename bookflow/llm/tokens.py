"""Token ids of whole texts, as the ``tokenizers`` library gives them for a byte-level BPE file, once per distinct piece.

The file's pre-tokenizer cuts a text into pieces (a contraction; letters, digits or other signs with a space
before them; white space) and BPE never crosses a piece. So the pieces of a slice are cut here all at once, each
distinct piece is merged once, and a bounded cache keeps the ids for later slices. Merging single pieces is left to
``tiktoken``, which takes the file's ids as ranks and costs a third of the library's time a piece. The classes of
characters are asked of the library, and texts with a special token's string go to it whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from bookflow.llm.common import Rolling

#: Pieces that a worker keeps at most; beyond it the cache starts anew.
CACHE = 1 << 18

LETTER, NUMBER, OTHER, SPACE = range(4)
#: Fixed values of the vocabulary's pre-tokenizer.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


class Pieces:
    """Tokenizer of slices of UTF-8 text; one per worker and vocabulary file."""

    _made: dict[str, "Pieces"] = {}

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self._asks = [(k, pre_tokenizers.Split(Regex(p), "removed")) for k, p in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s"))]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values: these bytes stand for themselves
        hidden = (b for b in range(256) if b not in printable)
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in t): i for t, i in self.library.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)}
        ranks = {t: i for t, i in ranks.items() if t not in self.special}
        self.merge = Encoding("pieces", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.classes = np.full(0x110000, 255, np.uint8)
        self._learn(np.arange(128))
        self._clear()

    def _clear(self):
        self.hashes = np.zeros(0, np.uint64)  # sorted, with the place of each piece's ids
        self.places = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, points: np.ndarray):
        for p in points.tolist():
            c = chr(p)
            self.classes[p] = next((k for k, ask in self._asks if not ask.pre_tokenize_str(c)), OTHER)

    def _cut(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where the pieces of the texts start (in bytes)."""
        text = data.tobytes().decode()
        point = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # the byte of each character
        kind = self.classes[point]
        if (new := np.unique(point[kind == 255])).size:
            self._learn(new)
            kind = self.classes[point]
        n = len(point)
        begin = np.zeros(n + 1, bool)
        begin[np.searchsorted(at, off[:-1])] = True  # of a text
        begin[n] = True
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        change |= begin[:-1]
        space = kind == SPACE
        ends = np.append(change[1:], True)  # the last of its run
        before_text_end = begin[1:]
        # the last space of a run that has another character after it: ' ' goes with that, others stand alone
        last = space & ends & ~before_text_end
        blank = last & (point == 32)
        start = change & ~space
        joined = np.zeros(n, bool)
        joined[1:] = blank[:-1]
        start &= ~joined
        start |= blank | last | (change & space)
        # an apostrophe that is a run of its own, with no space joined, begins a contraction
        quote = np.flatnonzero((point[:-1] == 39) & change[:-1] & ends[:-1] & ~joined[:-1] & (kind[1:] == LETTER) & ~before_text_end[:-1])
        if len(quote):
            padded = np.concatenate((point, [0, 0]))
            for q in quote.tolist():
                two = bytes(int(x) if x < 128 else 0 for x in padded[q + 1:q + 3])
                size = next((len(c) for c in CONTRACTIONS if two.startswith(c) and not begin[q + 1:q + len(c)].any()
                             and (kind[q + 1:q + 1 + len(c)] == LETTER).all()), 0)
                if size:
                    start[q + 1:q + 1 + size] = False
                    if q + 1 + size < n:
                        start[q + 1 + size] = True if kind[q + 1 + size] == LETTER and not change[q + 1 + size] else start[q + 1 + size]
        return at[start]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (with the end)."""
        n = len(off) - 1
        whole = self._whole(data, off)
        start = self._cut(data, off) if len(data) else np.zeros(0, np.int64)
        end = np.append(start[1:], len(data))
        h = Rolling(data).ranges(start, end)
        distinct, index, inverse = np.unique(h, return_index=True, return_inverse=True)
        place = self._places(distinct, data, start[index], end[index])[inverse]
        size = (self.first[1:] - self.first[:-1])[place]
        total = np.cumsum(size)
        ids = self.ids[np.repeat(self.first[:-1][place] - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        bound = np.concatenate(([0], total))[np.searchsorted(start, off)]
        if whole:
            parts = [ids[bound[i]:bound[i + 1]] for i in range(n)]
            for i in whole:
                parts[i] = np.array(self.library.encode(data[off[i]:off[i + 1]].tobytes().decode(), add_special_tokens=False).ids, np.uint32)
            bound = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            ids = np.concatenate(parts)
        return ids, bound

    def _whole(self, data, off) -> list[int]:
        raw, out = data.tobytes(), set()
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                out.add(int(np.searchsorted(off, at, side="right")) - 1)
                at = raw.find(s, at + 1)
        return sorted(out)

    def _places(self, distinct, data, start, end) -> np.ndarray:
        """The place in ``first`` of each distinct piece's ids; unknown pieces are merged."""
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(self.hashes) + len(new) > CACHE and len(self.hashes):
            self._clear()
            return self._places(distinct, data, start, end)
        if len(new):
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())]
            found = [self.merge(t) for t in texts]
            sizes = np.array([len(x) for x in found], np.int64)
            base = len(self.first) - 1
            self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes)))
            self.ids = np.concatenate((self.ids, np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum()))))
            hashes = np.concatenate((self.hashes, distinct[new]))
            places = np.concatenate((self.places, base + np.arange(len(new))))
            order = np.argsort(hashes)
            self.hashes, self.places = hashes[order], places[order]
            at = np.searchsorted(self.hashes, distinct)
        return self.places[at]
