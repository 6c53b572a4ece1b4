"""Benchmark decontamination: an FM-index per slice of the training texts, searched backwards for benchmark phrases.

A phrase is ``window`` consecutive words of a benchmark item, or the whole of a shorter item. A shard (a slice of a
partition's texts) is indexed over the benchmark's vocabulary: words that no item has can't be part of an occurrence,
so they end a run, and runs shorter than the shortest phrase can't hold one. Over the runs' suffixes stands the
Burrows-Wheeler transform in a wavelet matrix; all phrases step through its ranks at once, from their last word to
their first. Ranges that are left are located by walking back to the next sampled suffix position (every
``SAMPLE``-th word of a run), and the occurrences merged into removal spans.

The benchmark comes in blocks of at most ``block_bytes`` of text, each broadcast by itself; every block passes over
all texts (map only, no shuffle). Words are compared by 64-bit hash and length.

Null text has no words; items without words have no phrase; repeated items count by their ids, once each; items without
an id are searched like any other and count as one item, a null at the end of ``items``; an empty benchmark leaves all texts clean; input columns with the names of output columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.llm.common import Rolling, runs, small_batches, text_slices, utf8

WINDOW = 10
SAMPLE = 8
BLOCK_BYTES = 8 << 20
OUTPUT = ("n_words", "n_hit", "items", "spans")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words(data: np.ndarray, off: np.ndarray):
    """Hash, start, end and row of each word (digits, ASCII letters in lower case, all beyond ASCII)."""
    start, end, row = runs(_WORD[data], off)
    return Rolling(_LOWER[data]).ranges(start, end), start, end, row


class WaveletMatrix:
    """Ranks over integer symbols: for each bit, the zeros before every place."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.zeros = []
        for bit in range(max(1, top.bit_length()) - 1, -1, -1):
            one = (symbols >> bit & 1).astype(bool)
            self.zeros.append((bit, np.concatenate(([0], np.cumsum(~one, dtype=np.int32)))))
            symbols = np.concatenate((symbols[~one], symbols[one]))
        self.start = self._path(np.zeros(top + 1, np.int64), np.arange(top + 1))

    def _path(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for bit, zeros in self.zeros:
            z = zeros[at]
            at = np.where(symbol >> bit & 1, zeros[-1] + at - z, z)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``."""
        return self._path(at, symbol) - self.start[symbol]


class FMIndex:
    """Index of runs of symbols 1..top, each run followed by a 0; ``offset`` is the place of a symbol in its run."""

    def __init__(self, text: np.ndarray, offset: np.ndarray, top: int):
        n = len(text)
        order = rank = None
        breaks = text == 0
        rank = np.where(breaks, np.cumsum(breaks) - 1, text + breaks.sum())  # every break is a symbol of its own
        step = 0
        while order is None or rank.max() < n - 1:
            then = np.zeros(n, np.int64)
            if step:
                then[:n - step] = rank[step:]
            key = rank * (n + 1 + top) + then
            order = np.argsort(key)
            s = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate(([0], (s[1:] != s[:-1]).astype(np.int64))))
            rank, step = new, step * 2 or 1
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        last = text[order - 1]
        self.matrix = WaveletMatrix(last, top)
        self.last = last
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.sampled = (offset[order] % SAMPLE == 0) & ~breaks[order]
        self.position = order[self.sampled]
        self.index = np.cumsum(self.sampled) - 1
        self.n = n

    def search(self, phrases: np.ndarray, size: np.ndarray):
        """Ranges of suffixes that begin with each phrase; phrases are right-aligned, 0 before them."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        live = np.arange(len(phrases))
        for j in range(1, phrases.shape[1] + 1):
            live = live[(size[live] < j) | (hi[live] > lo[live])]
            now = live[size[live] >= j]
            symbol = phrases[now, -j]
            lo[now] = self.before[symbol] + self.matrix.rank(symbol, lo[now])
            hi[now] = self.before[symbol] + self.matrix.rank(symbol, hi[now])
        return lo, hi

    def locate(self, at: np.ndarray) -> np.ndarray:
        """The text positions of suffixes, by walking back to the next sampled one."""
        out, steps = np.empty(len(at), np.int64), np.zeros(len(at), np.int64)
        live, at = np.arange(len(at)), at.copy()
        while len(live):
            done = self.sampled[at[live]]
            ended = live[done]
            out[ended] = self.position[self.index[at[ended]]] + steps[ended]
            live = live[~done]
            symbol = self.last[at[live]]
            at[live] = self.before[symbol] + self.matrix.rank(symbol, at[live])
            steps[live] += 1
        return out


class Phrases:
    """The distinct phrases of some items over their vocabulary, and the items of each."""

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int):
        h, start, end, row = words(*utf8(texts))
        self.vocabulary, first = np.unique(h, return_index=True)
        self.lengths = (end - start)[first]
        code = np.searchsorted(self.vocabulary, h) + 1
        many = np.bincount(row, minlength=len(ids))
        size = np.minimum(many, window)[row]
        begin = np.cumsum(many) - many
        at = np.flatnonzero(np.arange(len(row)) + size <= (begin + many)[row])
        table = np.zeros((len(at), window), np.int32)
        for j in range(1, window + 1):
            has = size[at] >= j
            table[has, -j] = code[(at + size[at] - j)[has]]
        self.phrases, number = (x.astype(np.int32 if i == 0 else np.int64).reshape((-1, window) if i == 0 else -1) for i, x in
                                enumerate(np.unique(table, axis=0, return_inverse=True))) if len(at) else (table, np.zeros(0, np.int64))
        self.size = (self.phrases > 0).sum(axis=1)
        known, place = np.unique(ids.fill_null(0).to_numpy(), return_inverse=True)
        place[ids.is_null().to_numpy(zero_copy_only=False)] = len(known)
        self.ids = pa.concat_arrays([pa.array(known, pa.int64()), pa.nulls(1, pa.int64())])
        owner = np.unique(np.stack((number, place[row[at]]), axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        self.items = owner[:, 1]
        self.first = np.searchsorted(owner[:, 0], np.arange(len(self.phrases) + 1))
        self.shortest = int(self.size.min()) if len(self.size) else 0
        self.low = np.zeros(1 << 16, bool)
        self.low[self.vocabulary & np.uint64(0xFFFF)] = True

    def codes(self, h: np.ndarray, length: np.ndarray) -> np.ndarray:
        """1.. for words of the vocabulary, else 0."""
        out = np.zeros(len(h), np.int64)
        maybe = np.flatnonzero(self.low[h & np.uint64(0xFFFF)])
        at = np.searchsorted(self.vocabulary, h[maybe])
        at[at == len(self.vocabulary)] = 0
        out[maybe] = np.where((self.vocabulary[at] == h[maybe]) & (self.lengths[at] == length[maybe]), at + 1, 0)
        return out


def occurrences(phrases: Phrases, code: np.ndarray, row: np.ndarray):
    """(first word, phrase) of every occurrence in the words' codes."""
    none = np.zeros(0, np.int64)
    if not len(phrases.size) or not len(code):
        return none, none
    bounds = np.searchsorted(row, np.arange(row[-1] + 2))
    a, b, _ = runs(code > 0, bounds)
    long = b - a >= phrases.shortest
    a, b = a[long], b[long]
    if not len(a):
        return none, none
    size = b - a + 1  # with its break
    begin = np.cumsum(size) - size
    offset = np.arange(size.sum()) - np.repeat(begin, size)
    source = np.repeat(a, size) + offset
    text = np.where(offset == np.repeat(size - 1, size), 0, code[np.minimum(source, len(code) - 1)])
    there = np.zeros(len(phrases.vocabulary) + 1, bool)
    there[text] = True
    possible = np.flatnonzero((there[phrases.phrases] | (phrases.phrases == 0)).all(axis=1))
    if not len(possible):
        return none, none
    index = FMIndex(text, offset, len(phrases.vocabulary))
    lo, hi = index.search(phrases.phrases[possible], phrases.size[possible])
    found = np.flatnonzero(hi > lo)
    number = (hi - lo)[found]
    at = np.repeat(lo[found], number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    return source[index.locate(at)], possible[np.repeat(found, number)]


def _searched(block):
    """Adds what one block of the benchmark has in each text to n_words, items and word spans."""
    def rows(batches):
        phrases = block.value
        for batch, data, off in text_slices(batches):
            h, start, end, row = words(data, off)
            at, phrase = occurrences(phrases, phrases.codes(h, end - start), row)
            edge = np.zeros(len(h) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + phrases.size[phrase], -1)
            hit = np.cumsum(edge)[:-1] > 0
            a, b, r = runs(hit, np.searchsorted(row, np.arange(len(off))))
            pair = np.unique(np.stack((row[at], phrase), axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
            many = (phrases.first[1:] - phrases.first[:-1])[pair[:, 1]]
            which = np.repeat(phrases.first[:-1][pair[:, 1]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            item = np.unique(np.stack((np.repeat(pair[:, 0], many), phrases.items[which]), axis=1), axis=0)
            n = batch.num_rows
            old_items, old_spans = (batch.column(batch.schema.get_field_index(c)) for c in ("items", "spans"))
            items = pa.ListArray.from_arrays(pa.array(np.searchsorted(item[:, 0], np.arange(n + 1)), pa.int32()), phrases.ids.take(pa.array(item[:, 1], pa.int64())))
            span = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (a - np.searchsorted(row, r), b - np.searchsorted(row, r),
                                                                                  start[a] - off[r], end[b - 1] - off[r])], names=["first", "last", "start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(n + 1)), pa.int32()), span)
            for name, new, old in (("items", items, old_items), ("spans", spans, old_spans)):
                if old.flatten().__len__():  # an earlier block found something: put both together
                    new = pa.array([[*(x or ()), *(y or ())] for x, y in zip(old.to_pylist(), new.to_pylist())], new.type)
                batch = batch.set_column(batch.schema.get_field_index(name), name, new)
            count = pa.array(np.bincount(row, minlength=n), pa.int64())
            yield batch.set_column(batch.schema.get_field_index("n_words"), "n_words", count)
    return rows


def blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """Phrases of the items, for at most ``block_bytes`` of text (or one item) at a time."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null").toLocalIterator():
        if size and size + len(r[1]) > block_bytes:
            yield Phrases(pa.array(ids, pa.int64()), pa.array(texts, pa.string()), window)
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        size += len(r[1])
    yield Phrases(pa.array(ids, pa.int64()), pa.array(texts, pa.string()), window)


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (text, any others) with n_words, n_hit (words inside an occurrence), items (array of item_id with an
    occurrence, sorted, a null for those without an id last) and spans (what to remove: start and end in UTF-8 bytes, from a first word to a last)."""
    own = [c for c in docs.columns if c.lower() not in OUTPUT]
    df = small_batches(docs).select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in own if c != "text")).alias("row"), "text", F.lit(0).cast("long").alias("n_words"),
                     F.array().cast("array<long>").alias("items"),
                     F.array().cast("array<struct<first:int,last:int,start:int,end:int>>").alias("spans"))
    kind = df.schema["row"].dataType.simpleString()
    for block in blocks(benchmark, window, block_bytes):
        df = df.mapInArrow(_searched(docs.sparkSession.sparkContext.broadcast(block)),
                           f"row {kind}, text string, n_words long, items array<long>, spans array<struct<first:int,last:int,start:int,end:int>>")
    # spans of several blocks may overlap: merge them in order of their first words
    merged = F.aggregate(F.array_sort("spans"), F.array().cast("array<struct<first:int,last:int,start:int,end:int>>"), lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["last"] >= s["first"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["last"], s["last"]).alias("last"),
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(done, F.array(s))))
    df = df.withColumn("spans", F.when(F.size("spans") > 1, merged).otherwise(F.col("spans")))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return df.select(*((F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in own), "n_words", hit.alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"),
                     F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


#: What stands between the spans, put together: cut in the JVM, as a second Python worker per task would hold the texts again.
_CUT = """CASE WHEN size(spans) = 0 THEN text ELSE array_join(transform(sequence(0, size(spans)), i -> cast(substring(
    encode(text, 'UTF-8'), if(i = 0, 0, get(spans, i - 1).end) + 1,
    if(i = size(spans), octet_length(text), get(spans, i).start) - if(i = 0, 0, get(spans, i - 1).end)) AS string)), '') END"""


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the words of every occurrence cut out of text; all other columns as they are."""
    rest = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    found = search(docs.select(rest.alias("row"), "text"), benchmark, window, block_bytes)
    cut = found.select("row", F.expr(_CUT).alias("text"))
    return cut.select(*((F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns))
