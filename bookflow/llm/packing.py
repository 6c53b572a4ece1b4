"""Best-fit packing by best-two-fit: whole documents into sequences of at most ``room`` tokens.

A bin takes the longest remaining piece and then, again and again, the longest that fits. Then its smallest piece is
put back if two unpacked pieces fill its place and the gap more tightly: of all pairs that fit, the one with the
largest sum, if that is more than the smallest piece.

What a bin takes depends on the lengths alone, so the plan is made on their histogram (``room`` numbers, however many
documents there are): a bin's pattern holds for as many bins as its lengths last. The plan is a bounded table of
patterns; the k-th piece of a length finds its bin and place there. Pieces are numbered in buckets of their length,
so that no length is one task's, and the buckets' counts are summed up beforehand.

Null text is empty and is one token long (the end token). Only documents over ``room`` tokens are cut, into pieces of
``room`` tokens with the first one shorter. Repeated rows and doc ids are packed each; ids may be null; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.llm.common import materialize, small_batches, text_slices
from bookflow.llm.tokens import Pieces

ROOM = 1024
END = 2
#: Each length's pieces are numbered in so many buckets.
BUCKETS = 1024
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def _pieces(path: str, room: int, end: int, with_ids: bool):
    schema = _SCHEMA if with_ids else pa.schema(list(_SCHEMA)[:-1])

    def rows(batches):
        tokenizer = Pieces.of(path)
        for batch, data, off in text_slices(batches):
            ids, bound = tokenizer.encode(data, off)
            docs = batch.column(0).to_pylist()
            out = [[] for _ in schema]
            for i, doc in enumerate(docs):
                own = np.append(ids[bound[i]:bound[i + 1]], end).astype("<u4")
                raw, total = own.tobytes(), len(own)
                first = total if total <= room else total % room or room
                for piece, at in enumerate([0, *range(first, total, room)]):
                    size = first if piece == 0 else room
                    part = raw[4 * at:4 * (at + size)]
                    for column, value in zip(out, (doc, piece, at, size, zlib.crc32(part), part)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
    return rows


def pieces(docs: DataFrame, tokenizer: str, room: int = ROOM, end: int = END, with_ids: bool = True) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32 and, if asked for, ids
    (little-endian unsigned 32-bit)."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(tokenizer, room, end, with_ids), kind)


class _Lengths:
    """Which lengths are left, to find the longest up to a bound."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: v for k, v in counts.items() if v}
        self.sorted = sorted(self.counts)

    def longest(self, most: int, taken: dict[int, int]) -> int:
        """The longest of at most ``most`` that is left besides ``taken``, or 0."""
        i = bisect_right(self.sorted, most) - 1
        while i >= 0 and self.counts[self.sorted[i]] <= taken.get(self.sorted[i], 0):
            i -= 1
        return self.sorted[i] if i >= 0 else 0

    def best_two(self, most: int, taken: dict[int, int]) -> tuple[int, int]:
        """The pair of left lengths with the largest sum of at most ``most``; (0, 0) if there is none."""
        best = (0, 0)
        i = bisect_right(self.sorted, most - 1) - 1
        while i >= 0 and 2 * self.sorted[i] >= sum(best):
            a = self.sorted[i]
            if self.counts[a] > taken.get(a, 0):
                b = self.longest(min(a, most - a), taken | {a: taken.get(a, 0) + 1})
                if b and a + b > sum(best):
                    best = (a, b)
                    if a + b == most:
                        break
            i -= 1
        return best

    def take(self, used: dict[int, int]) -> int:
        """Takes ``used`` as often as it lasts, and says how often."""
        often = min(self.counts[k] // n for k, n in used.items())
        for k, n in used.items():
            self.counts[k] -= often * n
            if not self.counts[k]:
                self.sorted.remove(k)
        return often


def plan(counts: dict[int, int], room: int = ROOM) -> list[tuple[int, list[int]]]:
    """Patterns in order: for how many bins each holds, and the lengths in it."""
    left, out = _Lengths(counts), []
    while left.sorted:
        used: dict[int, int] = {}
        pattern, gap = [], room
        while size := left.longest(gap, used):
            pattern.append(size)
            used[size] = used.get(size, 0) + 1
            gap -= size
        if gap and len(pattern) > 1:
            small = pattern[-1]
            two = left.best_two(gap + small, used)  # the smallest itself isn't unpacked, so it is no part of the pair
            if sum(two) > small:
                pattern[-1:] = two
                used[small] -= 1
                for size in two:
                    used[size] = used.get(size, 0) + 1
        out.append((left.take({k: n for k, n in used.items() if n}), pattern))
    return out


def slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, per, offset): the pieces first..last-1 of a length go, ``per`` to a bin of the
    pattern's, to bins from ``sequence`` on; the one of them at place j of its bin stands at ``offset`` + j x length."""
    done: dict[int, int] = {}
    out, sequence = [], 0
    for often, pattern in patterns:
        offset = 0
        for size in sorted(set(pattern), reverse=True):
            per = pattern.count(size)
            first = done.get(size, 0)
            done[size] = first + often * per
            out.append((size, first, done[size], sequence, per, offset))
            offset += per * size
        sequence += often
    return out


def pack(parts: DataFrame, room: int = ROOM, buckets: int = BUCKETS) -> DataFrame:
    """``parts`` (length, any others) with sequence_id and offset. The order of pieces in a bin is from long to short."""
    own = [c for c in parts.columns if c.lower() not in ("sequence_id", "offset")]
    held = parts.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), F.col("length").cast("long").alias("size"))
    order = [F.col("row")[c] for c in own if c in ("doc_id", "piece", "start", "ids_crc32")]
    held = held.withColumn("bucket", F.pmod(F.xxhash64(*order) if order else F.xxhash64("row"), F.lit(buckets)))
    counts = materialize(held.groupBy("size", "bucket").count(), "packing_counts")  # room x buckets rows at most
    totals = {r[0]: r[1] for r in counts.groupBy("size").agg(F.sum("count")).collect()}
    if any(size < 1 or size > room for size in totals):
        raise ValueError("a piece is longer than a sequence or empty")
    table = slots(plan(totals, room))
    spark = parts.sparkSession
    before = counts.select("size", "bucket", (F.sum("count").over(W.partitionBy("size").orderBy("bucket")) - F.col("count")).alias("before"))
    numbered = (held.withColumn("n", F.row_number().over(W.partitionBy("size", "bucket").orderBy(*order)))
                .join(before, ["size", "bucket"]).withColumn("n", F.col("n") + F.col("before") - 1))
    where = spark.createDataFrame(table or [(0, 0, 0, 0, 1, 0)], "size long, first long, last long, sequence long, per long, at long")
    # a row per length with its slots in order: the place of a piece is found by its number, without a join of ranges
    where = where.groupBy("size").agg(F.array_sort(F.collect_list(F.struct("first", "last", "sequence", "per", "at"))).alias("slots"))
    found = numbered.join(F.broadcast(where), "size").withColumn("s", F.filter("slots", lambda s: (s["first"] <= F.col("n")) & (F.col("n") < s["last"]))[0])
    k = F.col("n") - F.col("s.first")
    return found.select("row.*", (F.col("s.sequence") + F.floor(k / F.col("s.per"))).cast("long").alias("sequence_id"),
                        (F.col("s.at") + F.pmod(k, F.col("s.per")) * F.col("size")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, room: int = ROOM, end: int = END, with_ids: bool = True) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset; ``with_ids`` also their ids, to write the sequences from."""
    return pack(materialize(pieces(docs, tokenizer, room, end, with_ids), "pieces"), room)
