"""Helpers shared by the operators: UTF-8 slices of Arrow batches, word hashes, connected components."""

from __future__ import annotations

import ctypes
import ctypes.util

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.session import materialize

#: A task works on so many text bytes at a time (one longer text is a slice of its own).
SLICE_BYTES = 1 << 19

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes end to end, and where each row starts (with the end); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                         else pa.large_binary()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


#: Rows in an Arrow batch at most: texts are long, and the JVM and Python both hold a batch.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches held to ``BATCH_ROWS`` rows (smaller settings stay)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on after a task, beside the next stage's."""
    pa.default_memory_pool().release_unused()
    name = ctypes.util.find_library("c")
    if name and hasattr(libc := ctypes.CDLL(name), "malloc_trim"):
        libc.malloc_trim(0)


def text_slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """(rows, bytes, offsets) of each batch, cut between rows into slices of about ``limit`` bytes."""
    yield from _text_slices(batches, column, limit)
    give_back()


def _text_slices(batches, column, limit):
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        data, off = utf8(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < n:
            end = max(start + 1, int(np.searchsorted(off, off[start] + limit, side="right")) - 1)
            yield batch.slice(start, end - start), data[off[start]:off[end]], off[start:end + 1] - off[start]
            start = end


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads low and high bits (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Rolling:
    """Polynomial hashes modulo 2**64 of any ranges of a byte string, equal for equal bytes at any place."""

    _base = np.uint64(0xD6E8FEB86659FD93)
    _inverse = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    _values = mix(np.arange(1, 257, dtype=np.uint64) * _PRIME)
    _powers = _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Rolling._powers) < n:
            size = max(n, SLICE_BYTES + 1)
            for name, x in (("_powers", Rolling._base), ("_inverses", Rolling._inverse)):
                p = np.full(size, x, np.uint64)
                p[0] = 1
                setattr(Rolling, name, np.cumprod(p))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(Rolling._values[data] * Rolling._powers[:n - 1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * Rolling._inverses[start] + (end - start).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """The hash of every range of ``size`` bytes, by start."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * Rolling._inverses[:n])


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of true bytes; a run never crosses a row's end."""
    edge = np.zeros(len(member) + 1, np.int8)
    edge[:-1] = member
    before = np.concatenate(([0], edge[:-1]))
    cut = np.zeros(len(member) + 1, bool)
    cut[off] = True
    start = np.flatnonzero((edge == 1) & ((before == 0) | cut))
    end = np.flatnonzero((before == 1) & ((edge == 0) | cut))
    return start, end, np.searchsorted(off, start, side="right") - 1


def byte_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte strings between ``start`` and ``end`` (in order, apart or touching, none empty), dictionary-encoded: equal codes are equal bytes."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] = 1
    inside[end] -= 1
    flat = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    off = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(flat))]).dictionary_encode()


def cumulative_count(keys: np.ndarray) -> np.ndarray:
    """0 for the first of equal values, 1 for the second, and so on."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    return out


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each of 0..n-1's component under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, hop := new[new]):
            new = hop
        new = new[label]
        if np.array_equal(new, label):
            return label
        label = new


def components(links: DataFrame, purpose: str) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b, longs): ids linked directly or through others share a root.

    Each round moves every vertex to the least of its neighbours and itself and drops links inside one vertex;
    it ends when no link is left. The order is that of xxhash64, which is one-to-one on longs, so chains of
    rising ids shrink by a fraction in each round too. Every round is written to the shared folder: lineage stays
    short and a lost executor costs one round. Roots are any member's hash, equal within a component only.
    """
    links = links.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"), F.col("a").alias("x"), F.col("b").alias("y"))
    ids = links.select(F.explode(F.array(F.struct(F.col("x").alias("id"), F.col("a").alias("root")),
                                         F.struct(F.col("y").alias("id"), F.col("b").alias("root")))).alias("r")).select("r.*")
    label = materialize(ids.distinct(), purpose)
    edges = materialize(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), purpose)
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("m")), purpose)
        label = materialize(label.join(least, label.root == least.v, "left").select("id", F.coalesce("m", "root").alias("root")), purpose)
        left, right = least.toDF("a", "ma"), least.toDF("b", "mb")
        edges = materialize(edges.join(left, "a").join(right, "b").filter("ma <> mb")
                            .select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct(), purpose)
    return label


def column_named(df: DataFrame, *taken: str) -> str:
    """A column name that neither ``df`` nor ``taken`` has."""
    name, used = "_k", {c.lower() for c in [*df.columns, *taken]}
    while name in used:
        name += "_"
    return name
