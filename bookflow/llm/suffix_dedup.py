"""Suffix-array dedup: remove every byte inside a ``length``-byte string that starts anywhere else.

Depth-limited radix sort, most significant digit first; only suffixes that still have an equal go on to the next pass:

1. The first digit of a suffix is the least-hash ``anchor``-byte string in its first ``length`` bytes and its place
   there. Equal windows have equal anchors at equal places, so neighbouring suffixes with one anchor travel as one row
   (a *stretch*: the bytes from the first window's start to the last one's end), about 1.5 rows per 100 bytes of text.
   Equal stretches of a slice are joined into one row before the shuffle. Anchors met once end here.
2. Stretches met at least twice as a whole are repeats throughout.
3. Where one anchor has different stretches, one of each is fetched and its windows are ordered by further digits of
   growing width until ``length`` bytes are used; windows that stay together are compared byte by byte and repeated.

Step 1 uses 64-bit hashes for anchors and, within one anchor, 64 further bits for stretches; step 3 compares bytes.
Every row's spans depend on its text alone, given the corpus: repeated rows and texts get the same spans. A row is known
by its id and 64 hash bits of its text, one without an id by 128 hash bits of its text.

Null text counts as empty; texts shorter than ``length`` lose nothing; null or repeated doc ids are allowed; an empty
table gives an empty result; input columns with the names of output columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.llm.common import Rolling, materialize, runs, small_batches, text_slices

LENGTH = 200
ANCHOR = 40
#: The least hash and its place share 64 bits: so many for the place in a slice.
_PLACE_BITS = np.uint64(28)
#: Windows ordered at a time in step 3.
_WINDOWS = 1 << 18
_DIGITS = (8, 8, 16, 32)
OUTPUT = ("n_bytes", "n_removed", "spans", "kept")


def stretches(data: np.ndarray, off: np.ndarray, length: int, anchor: int):
    """Anchor hash, stretch hash, row, start, number of windows, anchor's place in the stretch; by row and start."""
    empty = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    wide = length - anchor + 1
    if len(data) < length:
        return empty
    rolling = Rolling(data)
    value = rolling.windows(anchor)
    n = len(value) - wide + 1
    key = (value >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(value), dtype=np.uint64)
    block = np.concatenate((key, np.full(-len(key) % wide, ~np.uint64(0)))).reshape(-1, wide)
    ahead = np.minimum.accumulate(block, axis=1).ravel()[wide - 1:wide - 1 + n]
    behind = np.ascontiguousarray(np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1]).ravel()[:n]
    place = (np.minimum(ahead, behind) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    del key, block, ahead, behind
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    start = np.flatnonzero(np.arange(n) + length <= off[row + 1])
    if not len(start):
        return empty
    place, row = place[start], row[start]
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]))))
    first, last = start[new], start[np.append(new[1:], len(start)) - 1]
    return value[place[new]], rolling.ranges(first, last + length), row[new], first - off[row[new]], last - first + 1, place[new] - first


_STRETCH = "h long, c long, place int, windows int, docs array<long>, marks array<long>, starts array<int>"


def _stretch_rows(length: int, anchor: int):
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("place", pa.int32()), ("windows", pa.int32()),
                        ("docs", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32()))])

    def rows(batches):
        for batch, data, off in text_slices(batches):
            h, c, row, start, windows, place = stretches(data, off, length, anchor)
            order = np.lexsort((c, h))
            h, c, row, start, windows, place = (x[order] for x in (h, c, row, start, windows, place))
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))) if len(h) else np.zeros(0, np.int64)
            ends = pa.array(np.append(new, len(h)), pa.int32())
            doc, mark = (batch.column(i).to_numpy(zero_copy_only=False)[row] for i in (0, 1))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((doc, pa.int64()), (mark, pa.int64()), (start, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(pa.array(x[new].astype(t) if t is not np.int64 else x[new].view(t)) for x, t in
                                                ((h, np.int64), (c, np.int64), (place, np.int32), (windows, np.int32))), *lists], schema=schema)
    return rows


_CONTENT = "h long, doc long, mark long, start int, windows int, place int, whole boolean, content binary"


def _contents(length: int):
    """The bytes of the wanted stretches of each text."""
    schema = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()),
                        ("windows", pa.int32()), ("place", pa.int32()), ("whole", pa.bool_()), ("content", pa.binary())])

    def rows(batches):
        for batch, data, off in text_slices(batches):
            wanted = batch.column(batch.schema.get_field_index("wanted"))
            flat = wanted.flatten()
            row = np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy(zero_copy_only=False))
            field = {f.name: flat.field(i) for i, f in enumerate(flat.type)}
            at = off[row] + field["start"].to_numpy(zero_copy_only=False)
            size = field["windows"].to_numpy(zero_copy_only=False).astype(np.int64) + length - 1
            raw = data.tobytes()
            content = pa.array([raw[a:a + n] for a, n in zip(at.tolist(), size.tolist())], pa.binary())
            doc, mark = (batch.column(i).take(pa.array(row)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([field["h"], doc, mark, field["start"], field["windows"], field["place"], field["whole"], content], schema=schema)
    return rows


def repeated_windows(data: np.ndarray, base: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at ``base`` equal another window of their group: radix passes over bytes, singles dropped."""
    rolling = Rolling(data)
    alive, label, depth, turn = np.arange(len(base)), group.astype(np.uint64), 0, 0
    while depth < length and len(alive):
        width = min(_DIGITS[turn] if turn < len(_DIGITS) else 64, length - depth)
        at = base[alive] + depth
        digit = rolling.ranges(at, at + width)
        key = digit ^ (label * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        s = key[order]
        new = np.concatenate(([True], s[1:] != s[:-1]))
        number = np.cumsum(new) - 1
        keep = np.bincount(number)[number] > 1
        alive, label = alive[order[keep]], number[keep].astype(np.uint64)
        depth, turn = depth + width, turn + 1
    out = np.zeros(len(base), bool)
    if len(alive):  # members of a group stand together: compare each to its group's first, 8 bytes at a time
        first = np.concatenate(([True], label[1:] != label[:-1]))
        lead = alive[first][np.cumsum(first) - 1]
        same = group[alive] == group[lead]
        for d in range(0, length, 8):
            for i in range(d, min(d + 8, length)):
                same &= data[base[alive] + i] == data[base[lead] + i]
        number = np.cumsum(first) - 1
        many = np.bincount(number, weights=same)[number] > 1
        out[alive] = same & many
        odd = np.unique(label[~same])  # two contents under one hash: order those windows by their bytes
        for x in odd:
            part = alive[label == x]
            rows = [(int(group[p]), data[base[p]:base[p] + length].tobytes()) for p in part]
            out[part] = [rows.count(r) > 1 for r in rows]
    return out


_SPAN = "doc long, mark long, start int, end int"


def _ordered(length: int):
    """Repeated spans of the stretches that aren't repeated as a whole; rows come ordered by anchor."""
    schema = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def spans(batch):
        h, doc, mark, start, windows, place, whole = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        off = np.frombuffer(batch.column(7).buffers()[1], np.int32)[batch.column(7).offset:][:len(h) + 1].astype(np.int64)
        data = np.frombuffer(batch.column(7).buffers()[2], np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        row = np.repeat(np.arange(len(h)), windows)
        index = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        number = np.unique(h, return_inverse=True)[1]
        group = number[row] * (2 * length) + place[row] - index + length
        hit = repeated_windows(data, off[row] + index, group, length) & ~whole[row]
        a, b, r = runs(hit, np.append(np.cumsum(windows) - windows, len(row)))
        begin = start[r] + index[a]
        return pa.RecordBatch.from_arrays([pa.array(doc[r], pa.int64()), pa.array(mark[r], pa.int64()),
                                           pa.array(begin, pa.int32()), pa.array(begin + (b - a) + length - 1, pa.int32())], schema=schema)

    def rows(batches):
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(0).to_numpy(zero_copy_only=False)
            ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h))
            weight = np.cumsum(batch.column(4).to_numpy(zero_copy_only=False))
            done = 0
            if held and h[0] != held[-1].column(0)[-1].as_py() and count >= _WINDOWS:
                yield spans(_joined(held))
                held, count = [], 0
            for end in ends[:-1]:  # the last anchor may go on in the next batch
                if count + weight[end - 1] - (weight[done - 1] if done else 0) >= _WINDOWS:
                    yield spans(_joined([*held, batch.slice(done, end - done)]))
                    held, count, done = [], 0, end
            held.append(batch.slice(done))
            count += int(weight[-1] - (weight[done - 1] if done else 0))
        if held:
            yield spans(_joined(held))
    return rows


def _joined(batches):
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _merged(found) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in found or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _cut(raw: bytes, spans) -> bytes:
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:a])
        last = b
    return b"".join([*out, raw[last:]])


def _removed(batches):
    """Rows with their spans merged and the bytes that stay."""
    for batch in batches:
        spans, kept, sizes, gone = [], [], [], []
        for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
            raw, merged = text.as_buffer().to_pybytes() if text.is_valid else b"", _merged(found)
            spans.append([{"start": a, "end": b} for a, b in merged])
            kept.append(_cut(raw, merged))
            sizes.append(len(raw))
            gone.append(sum(b - a for a, b in merged))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                                          pa.array(kept, pa.binary())], names=["row", "text", *OUTPUT])


def _texts(batches):
    """Rows with the text that stays; a character that a span cuts through goes as a whole."""
    for batch in batches:
        out = [text.as_py() if not found else _cut(text.as_buffer().to_pybytes(), _merged(found)).decode("utf-8", "ignore")
               for text, found in zip(batch.column(1), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc, mark, start, end) of repeated bytes in ``docs`` (doc, mark, text); spans may touch or overlap."""
    stretch = docs.select("doc", "mark", "text").mapInArrow(_stretch_rows(length, anchor), _STRETCH).repartition("h")
    same = W.partitionBy("h", "c")
    seen = (stretch.withColumn("at_c", F.sum(F.size("docs")).over(same))
            .withColumn("first", F.row_number().over(same.orderBy("c")) == 1)
            .withColumn("at_h", F.sum(F.size("docs")).over(W.partitionBy("h"))).filter("at_h > 1"))
    seen = materialize(seen.withColumn("whole", F.expr("at_c > 1")).withColumn("mixed", F.expr("at_h > at_c")).drop("at_c", "at_h"), "stretches")
    whole = (seen.filter("whole").select("windows", F.explode(F.arrays_zip("docs", "marks", "starts")).alias("o"))
             .selectExpr("o.docs doc", "o.marks mark", "o.starts start", f"o.starts + windows + {length - 1} end"))
    wanted = (seen.filter("mixed and first").selectExpr("docs[0] doc", "marks[0] mark", "struct(h, starts[0] start, windows, place, whole) w")
              .groupBy("doc", "mark").agg(F.collect_list("w").alias("wanted")))
    texts = docs.select("doc", "mark", "text").join(wanted, ["doc", "mark"])
    contents = texts.mapInArrow(_contents(length), _CONTENT).repartition("h").sortWithinPartitions("h")
    return whole.union(contents.mapInArrow(_ordered(length), _SPAN))


def _with_spans(docs: DataFrame, own: list[str], length: int, anchor: int) -> DataFrame:
    keyed = small_batches(docs).select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in own if c != "text")).alias("row"),
                        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("text"), "text")).alias("doc"),
                        F.xxhash64("text").alias("mark"), F.col("text"))
    spans = (repeated_spans(keyed, length, anchor).distinct().groupBy("doc", "mark")
             .agg(F.collect_list(F.struct("start", "end")).alias("found")))
    return keyed.join(spans, ["doc", "mark"], "left").select("row", "text", "found")


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` (doc_id, text, any others) with n_bytes, n_removed, spans (start, end in UTF-8 bytes) and kept (binary)."""
    own = [c for c in docs.columns if c.lower() not in OUTPUT]
    joined = _with_spans(docs, own, length, anchor)
    kind = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(_removed, f"row {kind}, text string, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")
    return out.select(*((F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in own), *OUTPUT)


def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with what is left of text; all other columns as they are."""
    joined = _with_spans(docs, docs.columns, length, anchor)
    kind = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(_texts, f"row {kind}, text string")
    return out.select(*((F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns))
