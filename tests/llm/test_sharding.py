"""Sharding against its law, worked out by plain Python over the whole order."""

import random
import zlib
from collections import defaultdict
from hashlib import md5

from pyspark.sql import functions as F

from bookflow.llm import sharding

DOCS = "doc_id long, text string"


def _plain(rows, shards):
    """(id, size, crc, shard, slot) by a running sum over all rows in key order."""
    text = [(t or "").encode() for _, t in rows]
    size = [len(t) + 1 for t in text]
    order = sorted(range(len(rows)), key=lambda i: (md5(text[i]).hexdigest(), rows[i][0] is not None, rows[i][0] or 0))
    total, whole, start, before, at = sum(size), defaultdict(int), {}, [0] * len(rows), 0
    for i in order:
        start.setdefault(text[i], at)
        before[i], at = at, at + size[i]
        whole[text[i]] += size[i]
    out, slots = [], defaultdict(int)
    for i in order:
        cut = whole[text[i]] * sharding.WHOLE * shards > total
        middle = 2 * before[i] + size[i] if cut else 2 * start[text[i]] + whole[text[i]]
        shard = min(shards - 1, middle * shards // (2 * total))
        out.append((rows[i][0], size[i], zlib.crc32(text[i]), shard, slots[shard]))
        slots[shard] += 1
    return out


def _rows(seed):
    rnd = random.Random(seed)
    rows = [(i, "é" * rnd.randint(0, 60) + str(rnd.random())) for i in range(900)]
    rows += [(1000 + i, "the same text of many rows") for i in range(600)]  # far over a shard's part
    rows += [(2000 + i // 3, f"copy {i // 12}") for i in range(240)]
    rows += [(None, None), (None, ""), (7, None), (7, None), (7, "long " * 2000), (-5, "x"), (-5, "x")] + [(3, "wholly repeated row")] * 400
    rnd.shuffle(rows)
    return rows


def _key(r):
    return [(x is not None, x or 0) for x in r]


def test_shards_against_running_sum(spark):
    rows = _rows(1)
    docs = spark.createDataFrame(rows, DOCS).repartition(7).withColumns({"size": F.lit("clash"), "row": F.lit(1), "key": F.lit(2), "Slot": F.lit(3)})
    for shards, ranges, most in ((8, sharding.RANGES, 4_000_000), (3, 1, 20), (1, 2, 5)):
        got = sharding.assign(docs, shards, ranges=ranges, most=most)
        assert sorted(got.columns) == sorted(["doc_id", "text", "row", "key", *sharding.OUTPUT])
        got = got.collect()
        assert sorted([tuple(r[c] for c in ("doc_id", "size", "text_crc32", "shard", "slot")) for r in got], key=_key) == sorted(_plain(rows, shards), key=_key)
        assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_law_holds(spark):
    rows = _rows(2)
    got = sharding.assign(spark.createDataFrame(rows, DOCS), 8, columns=["doc_id", "text"]).collect()
    size, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[r.text or ""].add(r.shard)
    part = sum(size.values()) / 8
    assert sorted(size) == list(range(8))
    assert all(abs(s - part) <= max(r.size for r in got) + part / sharding.WHOLE for s in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    split = [t for t, h in homes.items() if len(h) > 1]
    assert set(split) <= {"the same text of many rows", "wholly repeated row", "long " * 2000}


def test_overfull_range_is_cut_and_odd_tables(spark):
    keyed = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("key"), F.when(F.col("id") > 990, 900).otherwise(1).cast("long").alias("size"))
    total = keyed.agg(F.sum("size")).first()[0]
    cuts, sums = sharding._cuts(keyed, 40, total, 30)
    assert sum(r.n for r in sums) == 1000 and all(r.low == r.high or r.bytes * 40 <= 2 * total and r.n <= 30 for r in sums)
    assert sharding.splitters(["b", "a", "c", "a"], 2) == ["b"] and sharding.splitters([], 3) == []
    empty = spark.createDataFrame([], DOCS)
    assert sharding.assign(empty).collect() == []
    same = sharding.assign(spark.createDataFrame([(1, "a")] * 10, DOCS), 8).collect()
    assert sorted(r.shard for r in same) == sorted(min(7, (2 * i + 1) * 8 // 20) for i in range(10))


def test_written_shards(spark, tmp_root):
    rows = _rows(3)
    sharding.write_shards(spark.createDataFrame(rows, DOCS), tmp_root + "/out", 4)
    back = spark.read.parquet(tmp_root + "/out")
    assert back.count() == len(rows) and {int(r.shard) for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
