"""Periodic runs of words: stretches in which one sequence of words is repeated at least four times.

A run of period q is a stretch of at least max(6, 4 q) words in which words q apart are the same, q is the least such
number, and no neighbouring word goes on with it. Words after a run's first q are dropped from ``collapsed``.

Periods are dealt with by octave, S <= q < 2 S. A document's words fall into tiles that overlap, one for each multiple
c of S, from 4 S words before c to 8 S after it. A run of such a period is longer than 4 S words, so some c has two
whole periods after it inside the run. For each tile alone the boundary Z-functions say, for every q of the octave, how
far the words from c on agree with those from c + q on, and how far the words before c do so backwards; both ends make a
fragment of a run, cut to the tile. The fragments of a document and period are dealt together and stitched where they
overlap by a period or more, which tiles of one run do.

Z values come from prefix hashes of the words' codes, for all tiles of a slice at a time, and only where the two periods
after c agree; the codes are exact, and each run found is compared word by word (a document where that fails is searched
plainly). A document of up to ``LONG`` bytes is tiled and stitched in the task that holds it; a longer one is exploded
into rows of overlapping codes for each group of octaves, dealt out, and stitched by document and period.

Null and empty texts have no words; repeated rows are searched each; a very long text is held by one task as a row, its
tiles are not; an empty table gives an empty result; input columns with the names of output columns are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.llm.common import byte_words, mix, runs, small_batches, text_slices
from bookflow.session import materialize

LEAST = 6
TIMES = 4
#: Bytes of a text from which on its tiles are dealt out, and words of such a row of tiles at least.
LONG = 8 << 20
TILES = 1 << 16
#: (boundary, period) pairs looked at at a time.
_PAIRS = 1 << 20
_BASE = np.uint64(0xD1342543DE82EF95)
_GAP = np.ones(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = False

OUTPUT = ("n_words", "runs", "collapsed")


class Codes:
    """Prefix hashes of codes: whether stretches are equal, and how far they go on being so."""

    _powers = np.ones(1, np.uint64)

    def __init__(self, code: np.ndarray):
        n = len(code)
        if len(Codes._powers) <= n:
            p = np.full(max(n + 1, 1 << 17), _BASE, np.uint64)
            p[0] = 1
            Codes._powers = np.cumprod(p)
        self.code, self.power = code, Codes._powers
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(code.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.sums[1:])

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` codes from a and from b (behind a) on are the same."""
        return (self.sums[a + size] - self.sums[a]) * self.power[b - a] == self.sums[b + size] - self.sums[b]

    def z(self, c: np.ndarray, q: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """The boundary Z-function at c for the shift q: how many codes from c and from c + q on (or before them) agree, ``most`` at most."""
        low, high = np.zeros(len(c), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high + 1) // 2, low)
            at = c - middle if back else c
            good = self.equal(at, at + q, middle)
            low = np.where(good, middle, low)
            high = np.where(good, high, middle - 1)
        return low


def fragments(codes: Codes, off: np.ndarray, octaves=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, period, start and end (in the sequence) of the tiles' fragments; sequence k has the codes from off[k] to off[k + 1]."""
    size = np.diff(off)
    out = [[np.zeros(0, np.int64)] for _ in range(4)]
    longest = int(size.max(initial=0))
    step = 1
    while max(LEAST, TIMES * step) <= longest:
        if octaves is None or octaves[0] <= step < octaves[1]:
            own = np.flatnonzero(size >= max(LEAST, TIMES * step))
            number = (size[own] - 2 * step) // step + 1
            k = np.repeat(own, number)
            c = off[k] + step * (np.arange(len(k)) - np.repeat(np.cumsum(number) - number, number))
            period = np.arange(step, 2 * step)
            rows = max(1, _PAIRS // step)
            for i in range(0, len(c), rows):
                begin, stop = off[k[i:i + rows]], off[k[i:i + rows] + 1]
                there = c[i:i + rows, None] + period
                fits = there + period <= stop[:, None]
                hit = fits & (codes.code[c[i:i + rows]][:, None] == codes.code[np.minimum(there, len(codes.code) - 1)])
                r, p = np.nonzero(hit)
                at, q = c[i:i + rows][r], period[p]
                same = codes.equal(at, at + q, q)
                r, at, q = r[same], at[same], q[same]
                if not len(r):
                    continue
                ahead = codes.z(at, q, np.minimum(stop[r], at + 8 * step) - at - q)
                behind = codes.z(at, q, np.minimum(at - begin[r], 4 * step), back=True)
                for to, x in zip(out, (k[i:i + rows][r], q, at - behind - begin[r], at + q + ahead - begin[r])):
                    to.append(x)
        step *= 2
    return tuple(np.concatenate(x) for x in out)


def stitched(k, period, start, end):
    """Fragments of one sequence and period that overlap by a period or more, joined."""
    order = np.lexsort((start, period, k))
    k, period, start, end = k[order], period[order], start[order], end[order]
    if not len(k):
        return k, period, start, end
    group = np.concatenate(([True], (k[1:] != k[:-1]) | (period[1:] != period[:-1])))
    number = np.cumsum(group)
    shift = number * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift) - shift  # the furthest end so far in the group
    new = group.copy()
    new[1:] |= start[1:] > reach[:-1] - period[1:]
    first = np.flatnonzero(new)
    return k[first], period[first], start[first], np.maximum.reduceat(end, first)


def smallest(k, period, start, end):
    """Of stretches with one place, those of the least period; only those long enough."""
    long = end - start >= np.maximum(LEAST, TIMES * period)
    k, period, start, end = k[long], period[long], start[long], end[long]
    order = np.lexsort((period, end, start, k))
    k, period, start, end = k[order], period[order], start[order], end[order]
    if len(k):
        first = np.concatenate(([True], (k[1:] != k[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])))
        k, period, start, end = k[first], period[first], start[first], end[first]
    return k, period, start, end


def plain_runs(code: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, start, end) of all runs of one sequence, period by period."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(code) // TIMES + 1):
        a, b, _ = runs(code[q:] == code[:-q], np.array([0, len(code) - q]))
        for s, e in zip(a.tolist(), (b + q).tolist()):
            if e - s >= max(LEAST, TIMES * q):
                found.setdefault((s, e), q)
    return [(q, s, e) for (s, e), q in found.items()]


def document_runs(code: np.ndarray, off: np.ndarray):
    """Sequence, period, start and end of all runs of the sequences, compared word by word."""
    k, q, s, e = smallest(*stitched(*fragments(Codes(code), off)))
    wrong = {int(x) for x, p, a, b in zip(k, q, s + off[k], e + off[k]) if not np.array_equal(code[a + p:b], code[a:b - p])}
    if wrong:
        keep = ~np.isin(k, list(wrong))
        again = [(x, *r) for x in sorted(wrong) for r in plain_runs(code[off[x]:off[x + 1]])]
        more = np.array(again, np.int64).reshape(-1, 4).T
        k, q, s, e = (np.concatenate((a[keep], b)) for a, b in zip((k, q, s, e), more))
    return k, q, s, e


def _coded(data, off):
    """Codes of a slice's words, and where each text's begin."""
    start, end, row = runs(_GAP[data], off)
    code = byte_words(data, start, end).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return code, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(off) - 1))))


_RUNS = "array<struct<start:long,length:long,period:long>>"
_PIECE = "array<struct<period:long,start:long,end:long>>"
_PIECES = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def _said(raw: bytes, digest: bool):
    return hashlib.sha256(raw).hexdigest() if digest else raw.decode()


def _searched(digest: bool, long: int):
    """Rows with their words' number and the runs; the text stays where words may have to go, else ``collapsed`` is made."""
    def rows(batches):
        for batch, data, off in text_slices(batches):
            n = batch.num_rows
            large = np.diff(off) > long
            begin, end = off[:-1], off[1:]
            words, pieces = np.zeros(n, np.int64), [[] for _ in range(n)]
            if not large.all():  # the tiles of large ones are dealt out
                code, first = _coded(data, off)
                words = np.diff(first)
                for k, q, s, e in zip(*(x.tolist() for x in document_runs(code, first))):
                    if not large[k]:
                        pieces[k].append({"period": q, "start": s, "end": e})
            raw = data.tobytes()
            texts = batch.column(2)
            keep = [bool(pieces[i]) or bool(large[i]) for i in range(n)]
            done = [None if keep[i] else _said(b" ".join(raw[begin[i]:end[i]].split()), digest) for i in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts if all(keep) else pa.array([t.as_py() if x else None for t, x in zip(texts, keep)], pa.string()),
                                              pa.array(words), pa.array(pieces, _PIECES), pa.array(done, pa.string())],
                                             names=["row", "key", "text", "n_words", "pieces", "collapsed"])
    return rows


def tile_rows(code: np.ndarray, least: int):
    """(first and last octave, base, codes) of a sequence's tiles: the octaves whose tiles are small against ``least`` words in one row."""
    low, high = 1, 1 << max(1, (least // 64).bit_length() - 1)
    while low * TIMES <= max(len(code), 1):
        top = high // 2  # the widest octave of the group
        overlap = 16 * top
        size = max(least, 4 * overlap)
        step = (size - overlap) // top * top
        for base in range(0, max(1, len(code) - overlap), step):
            yield low, high, base, code[base:base + size]
        low, high = high, 2 * high


def _exploded(least: int):
    def rows(batches):
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                code, _ = _coded(data, np.array([0, len(data)]))
                for low, high, base, part in tile_rows(code, least):
                    yield pa.RecordBatch.from_arrays([pa.array([key.as_py()]), pa.array([low], pa.int64()), pa.array([high], pa.int64()), pa.array([base], pa.int64()),
                                                      pa.array([part.astype(np.int32)], pa.list_(pa.int32())), pa.array([len(code)], pa.int64())],
                                                     names=["key", "low", "high", "base", "codes", "n_words"])
    return rows


def _solved(batches):
    """The fragments of each row of tiles, in the document's numbers."""
    for batch in batches:
        for i in range(batch.num_rows):
            key, low, high, base = (batch.column(j)[i].as_py() for j in range(4))
            code = batch.column(4)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            _, q, s, e = stitched(*fragments(Codes(code), np.array([0, len(code)]), (low, high)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), key)), pa.array(q), pa.array(s + base), pa.array(e + base)], names=["key", "period", "start", "end"])


def _stitch(pieces: DataFrame) -> DataFrame:
    """(key, runs) from fragments (key, period, start, end): each document's runs by start, then period."""
    own = W.partitionBy("key", "period").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(W.unboundedPreceding, -1))
    islands = (pieces.withColumn("new", F.coalesce(F.col("start") > reach - F.col("period"), F.lit(True)).cast("int"))
               .withColumn("island", F.sum("new").over(own.rowsBetween(W.unboundedPreceding, 0)))
               .groupBy("key", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    whole = islands.filter(F.col("end") - F.col("start") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    least = whole.groupBy("key", "start", "end").agg(F.min("period").alias("period"))
    run = F.struct("start", (F.col("end") - F.col("start")).alias("length"), "period")
    return least.groupBy("key").agg(F.sort_array(F.collect_list(run)).alias("runs"))  # at most one run for each word


def _dropped(digest: bool):
    def rows(batches):
        for batch in batches:
            out, number = [], []
            for text, found in zip(batch.column(1), batch.column(3).to_pylist()):
                words = text.as_buffer().to_pybytes().split()
                edge = np.zeros(len(words) + 1, np.int64)
                for r in found:
                    edge[r["start"] + r["period"]] += 1
                    edge[r["start"] + r["length"]] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                number.append(len(words))
                out.append(_said(b" ".join(words if not gone.any() else [w for w, g in zip(words, gone.tolist()) if not g]), digest))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int64()), batch.column(3), pa.array(out, pa.string())], names=["row", *OUTPUT])
    return rows


def collapse_runs(docs: DataFrame, digest: bool = False, long: int = LONG, tiles: int = TILES) -> DataFrame:
    """``docs`` (text, any others, without the text where ``digest``) with n_words, runs (start, length, period; by start,
    then period) and collapsed: the words that stay, joined by one space, or with ``digest`` the lowercase SHA-256 of it."""
    own = [c for c in docs.columns if c.lower() not in OUTPUT and not (digest and c == "text")]
    held = small_batches(docs).select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in own)).alias("row"),
                                      F.monotonically_increasing_id().alias("key"), F.col("text").cast("string").alias("text"))
    kind = held.schema["row"].dataType.simpleString()
    found = materialize(held.mapInArrow(_searched(digest, long), f"row {kind}, key long, text string, n_words long, pieces {_PIECE}, collapsed string"), "runs")
    plain = found.filter("collapsed is not null").select("row", "n_words", F.array().cast(_RUNS).alias("runs"), "collapsed")
    rest = found.filter("collapsed is null")
    tiled = (rest.filter("size(pieces) = 0").select("key", "text")
             .mapInArrow(_exploded(tiles), "key long, low long, high long, base long, codes array<int>, n_words long")
             .repartition("key", "low", "base").select("key", "low", "high", "base", "codes")
             .mapInArrow(_solved, "key long, period long, start long, end long"))
    pieces = rest.select("key", F.explode("pieces").alias("p")).select("key", "p.*").unionByName(tiled)
    joined = rest.select("row", "text", "key").join(_stitch(pieces), "key", "left")
    runs_ = F.coalesce("runs", F.array().cast(_RUNS)).alias("runs")
    cut = joined.select("row", "text", "key", runs_).mapInArrow(_dropped(digest), f"row {kind}, n_words long, runs {_RUNS}, collapsed string")
    return plain.unionByName(cut).select(*(F.col("row")[c].alias(c) for c in own), *OUTPUT)
