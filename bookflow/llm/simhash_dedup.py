"""SimHash near-dedup: byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints at ``max_bits`` <= 4 differing bits differ in at most
four of them, so they share at least four. The index posts each distinct fingerprint under 20 triples of positional
bytes, chosen so that any four positions hold one of the triples: every pair that can link meets in a list. In a list
the shared positional bytes of a pair are tallied, pairs below the guaranteed minimum go, the others are verified by
their bit distance. Only components leave a list (each member with the list's root), never pairs; within a list a
search from one member compares the frontier with what isn't reached yet, so a tight cluster costs about one pass.
Lists over ``LIST`` fingerprints are cut into blocks, and each pair of blocks is a list of its own.

Null or blank texts have fingerprint zero, linked like any other; equal fingerprints are one vertex, so copies never
meet as pairs; doc ids may be null or repeat; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.llm.common import components, materialize, runs, small_batches, text_slices

SHINGLE = 4
MAX_BITS = 4
#: Fingerprints in one list at most; longer lists are cut into blocks.
LIST = 1 << 18
#: Frontier x unreached pairs compared at a time.
_PAIRS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def triples() -> list[tuple[int, int, int]]:
    """20 triples of 0..7 such that any four of 0..7 hold one: of three parts, those within a part and those with
    two of one part and one of the next."""
    parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
    out = [t for p in parts for t in combinations(p, 3)]
    return out + [(*two, one) for i, p in enumerate(parts) for two in combinations(p, 2) for one in parts[(i + 1) % 3]]


def fingerprints(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text: a bit is set if more than half of its shingles' XXH64 have it."""
    space = _SPACE[data]
    start, end, row = runs(~space, off)
    out = np.zeros(len(off) - 1, np.uint64)
    if not len(start):
        return out
    before = np.concatenate(([True], space[:-1]))
    before[off[:-1][off[:-1] < len(data)]] = True
    keep = ~(space & before)
    text = _LOWER[data]
    text[space] = 32
    text = text[keep].tobytes()
    place = np.concatenate(([0], np.cumsum(keep)))
    start, end = place[start], place[end]
    words = np.bincount(row, minlength=len(out))
    full = np.flatnonzero(row[shingle - 1:] == row[:len(row) - shingle + 1]) if len(row) >= shingle else np.zeros(0, np.int64)
    short = np.flatnonzero((words > 0) & (words < shingle))
    first = (np.cumsum(words) - words)[short]
    a = np.concatenate((start[full], start[first]))
    b = np.concatenate((end[full + shingle - 1], end[first + words[short] - 1]))
    of = np.concatenate((row[full], short))
    order = np.argsort(of, kind="stable")
    a, b, of = a[order], b[order], of[order]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[i:j], 42) for i, j in zip(a.tolist(), b.tolist())), np.uint64, len(a))
    count = np.bincount(of, minlength=len(out))
    index = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
    part = np.flatnonzero(index % 255 == 0)  # eight counters of a byte each hold up to 255
    ones = np.zeros((len(part), 64), np.int64)
    lanes = np.uint64(0x0101010101010101)
    for k in range(8):
        ones[:, k::8] = np.add.reduceat((h >> np.uint64(k)) & lanes, part).view(np.uint8).reshape(-1, 8)
    rows, at = np.unique(of[part], return_index=True)
    ones = np.add.reduceat(ones, at, axis=0)
    bits = ones * 2 > count[rows][:, None]
    out[rows] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def list_roots(f: np.ndarray, max_bits: int) -> np.ndarray:
    """The index of each fingerprint's root under links in this list."""
    root = np.arange(len(f))
    least = 8 - max_bits
    rest = np.arange(len(f))
    ones = np.uint64(0x7F7F7F7F7F7F7F7F)
    while len(rest) > 1:
        lead, frontier, rest = rest[0], rest[:1], rest[1:]
        while len(frontier) and len(rest):
            block = max(1, _PAIRS // len(rest))
            now, frontier = frontier[:block], frontier[block:]
            x = f[now][:, None] ^ f[rest][None, :]
            filled = ((x & ones) + ones) | x | ones  # a byte is all ones unless it is zero in x
            shared = np.bitwise_count(~filled)
            near = ((shared >= least) & (np.bitwise_count(x) <= max_bits)).any(axis=0)
            found, rest = rest[near], rest[~near]
            root[found] = lead
            frontier = np.concatenate((frontier, found))
    return root


def _list_links(max_bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(held):
        f = np.concatenate(held)
        root = list_roots(f.view(np.uint64), max_bits)
        linked = np.flatnonzero(root != np.arange(len(f)))
        return f[linked], f[root[linked]]

    def rows(batches):
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, lo, hi, f = (batch.column(i).to_numpy() for i in range(4))
            new = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            a, b = [], []
            for i, j in zip([0, *new.tolist()], [*new.tolist(), len(f)]):
                here = (key[i], lo[i], hi[i])
                if here != last and held:
                    if len(held) > 1 or len(held[0]) > 1:
                        x = links(held)
                        a.append(x[0])
                        b.append(x[1])
                    held = []
                held.append(f[i:j])
                last = here
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in links(held)], schema=schema)
    return rows


def _fingerprint_rows(shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("fp", pa.int64())])

    def rows(batches):
        for batch, data, off in text_slices(batches):
            fp = fingerprints(data, off, shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], schema=schema)
    return rows


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, longest: int = LIST) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, any others): doc_id, mark (a hash of the text, to join repeated ids
    by), fp (the fingerprint as a long), component_id (the least doc_id reachable by links, itself included), component
(the component's own key: component_id is null where all ids are, and repeats where an id does)."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees all links up to 4 differing bits")
    marked = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    prints = materialize(marked.mapInArrow(_fingerprint_rows(shingle), "doc_id long, mark long, fp long"), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")

    def byte(i):
        return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(255)

    keys = F.array(*(F.lit(n << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c) for n, (a, b, c) in enumerate(triples())))
    posted = distinct.select(F.explode(keys).alias("key"), "fp")
    many = materialize(posted.groupBy("key").count().filter(F.col("count") > longest)
                       .select("key", F.ceil(F.col("count") / longest).cast("int").alias("blocks")), "long_lists")
    if many.isEmpty():
        lists = posted.select("key", F.lit(0).alias("lo"), F.lit(0).alias("hi"), "fp")
    else:
        cut = posted.join(many, "key", "left").select("key", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks"))
        cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        lists = cut.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    links = (lists.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
             .mapInArrow(_list_links(max_bits), "a long, b long").distinct())
    root = components(materialize(links, "simhash_links"), "simhash_components")
    rooted = distinct.join(root, distinct.fp == root.id, "left").select("fp", "least", F.coalesce("root", F.xxhash64("fp")).alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = rooted.join(least, "root").select("fp", "component_id", F.col("root").alias("component"))
    return prints.join(component, "fp").select("doc_id", "mark", "fp", "component_id", "component")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row of its least doc_id stays (one, if that repeats;
    a component whose ids are all null keeps one row)."""
    found = near_duplicates(docs, shingle, max_bits)
    stay = (found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("_stay_id"), F.col("mark").alias("_stay_mark"))).alias("s"))
            .select("s._stay_id", "s._stay_mark"))
    mark = F.xxhash64(F.col("text"))
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), mark.alias("mark"))
    kept = own.join(stay, own.id.eqNullSafe(stay._stay_id) & (own.mark == stay._stay_mark), "left_semi")
    return kept.dropDuplicates(["id", "mark"]).select("row.*")
