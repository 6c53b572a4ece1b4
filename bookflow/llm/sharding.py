"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, ranges, overfull ranges subdivided.

The law is ``bytes``: shards are consecutive stretches of the key order with near equal sizes (a record's size is its
text's UTF-8 bytes plus 1). The key is the md5 of the text, so equal texts stand together and a record's place doesn't
depend on the order of the input; within equal texts doc_id orders, then the row's number.

1. A size-weighted sample of keys (the ``PER_RANGE * ranges`` least of -ln(u) / size, so its number is fixed) gives
   quantile boundaries; records are dealt to the ranges between them, each range with about the same bytes.
2. Ranges with over twice their part are sampled again and cut by their own quantiles, until none can be cut. Equal
   texts have one key, so boundaries don't cut them; where they hold over 1 / ``WHOLE`` of a shard, id and row number
   belong to the key and they are cut like all else.
3. Each range's bytes and rows are summed (one row a range) and a running sum inside a range gives each record its
   exact place in the whole order, whatever the sample. A unit (equal texts, or one record of texts that are cut) goes
   to the shard that holds its middle byte. So shards differ from their part by at most half a unit at each end.

Null text has size 1 and CRC 0 and counts as equal to empty text; ids may be null or repeat; an empty table gives an
empty result; input columns with the names of output columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.session import materialize

#: Ranges for one shard at first, and sampled keys for a range: both bound what the driver holds.
RANGES = 32
PER_RANGE = 16
#: Equal texts stay in one shard up to this part of a shard's bytes.
WHOLE = 64
OUTPUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
_SEED = 23


def _ordered_hex(number: Column) -> Column:
    """16 hex digits in the order of the signed number; null stands first."""
    return F.coalesce(F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit(" " * 16))


def splitters(keys: list[str], ranges: int) -> list[str]:
    """The distinct boundaries that cut the sorted sample into ``ranges`` parts; a range begins after its boundary."""
    keys = sorted(keys)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges) if len(keys) * i // ranges < len(keys)})


def _sample(keyed: DataFrame, number: int, seed: int) -> list[str]:
    """``number`` keys, drawn without replacement by size."""
    lot = -F.log(1 - F.rand(seed)) / F.col("size")
    return [r.key for r in keyed.select("key", lot.alias("lot")).orderBy("lot").limit(number).select("key").collect()]


def _ranged(keyed: DataFrame, cuts: list[str]) -> DataFrame:
    """``keyed`` with the number of the range that holds its key; the cuts travel in the function, bounded as they are."""
    bounds = np.array(cuts, dtype=object)

    @F.pandas_udf("int")
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(dtype=object), side="left").astype(np.int32))

    return keyed.withColumn("range", place("key") if cuts else F.lit(0))


def _cuts(keyed: DataFrame, ranges: int, total: int, most: int) -> tuple[list[str], list]:
    """Boundaries such that no range of several keys holds over twice its part, and the ranges' bytes and rows."""
    cuts = splitters(_sample(keyed, PER_RANGE * ranges, _SEED), ranges)
    seed = _SEED
    while True:
        held = _ranged(keyed, cuts)
        sums = (held.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
                .orderBy("range").collect())  # a row a range
        over = [r for r in sums if (r.bytes * ranges > 2 * total or r.n > most) and r.low < r.high]
        if not over:
            return cuts, sums
        seed += 1
        parts = {r.range: max(2, -(-r.bytes * ranges // total), -(-r.n // most)) for r in over}
        wanted = F.create_map(*(F.lit(x) for k, v in parts.items() for x in (k, PER_RANGE * v)))[F.col("range")]
        lot = F.row_number().over(W.partitionBy("range").orderBy("lot"))  # one task a range, so no more than its sample
        drawn = (held.filter(F.col("range").isin(list(parts))).select("range", "key", (-F.log(1 - F.rand(seed)) / F.col("size")).alias("lot"))
                 .withColumn("n", lot).filter(F.col("n") <= wanted).groupBy("range").agg(F.collect_list("key").alias("keys")).collect())
        # the least key of an overfull range is always a cut, so every round cuts each of them at least once
        cuts = sorted({*cuts, *(r.low for r in over), *(c for r in drawn for c in splitters(r["keys"], parts[r.range]))})


def _keyed(docs: DataFrame, columns: list[str], shards: int) -> tuple[DataFrame, int]:
    """The carried columns with size, CRC, key and row number, written once; and all bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rest = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in columns))
    id_ = F.col("doc_id").cast("long") if "doc_id" in docs.columns else F.lit(None).cast("long")
    rows = materialize(docs.select(rest.alias("row"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"),
                                   F.md5(text).alias("text"), id_.alias("id"), F.monotonically_increasing_id().alias("number")), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    # at most WHOLE * shards texts are that frequent
    big = rows.groupBy("text").agg(F.sum("size").alias("all")).filter(F.col("all") * (WHOLE * shards) > total)
    big = materialize(big.select("text", F.lit(True).alias("cut")), "shard-keys")
    rows = rows.join(F.broadcast(big), "text", "left").withColumn("cut", F.coalesce("cut", F.lit(False)))
    own = F.concat(_ordered_hex(F.col("id")), _ordered_hex(F.col("number")))
    return rows.withColumn("key", F.concat("text", F.when(F.col("cut"), own).otherwise(F.lit("")))), total


def assign(docs: DataFrame, shards: int = 8, columns: list[str] | None = None, ranges: int = RANGES, most: int = 4_000_000) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with size, text_crc32, law, shard, slot (gapless from 0 in its shard) and
    grown_shard (null: the law is ``bytes``). ``most``: rows of a range at most, where its keys can be told apart."""
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in OUTPUT]
    rows, total = _keyed(docs, columns, shards)
    if not total:
        cuts, sums = [], []
    else:
        cuts, sums = _cuts(rows, ranges * shards, total, most)
    before, n, at = 0, 0, []
    for r in sums:
        at.append((r.range, before, n))
        before, n = before + r.bytes, n + r.n
    starts = docs.sparkSession.createDataFrame(at, "range int, range_bytes long, range_rows long")
    order = W.partitionBy("range").orderBy("text", "id", "number")
    same = W.partitionBy("range", "text")
    placed = (_ranged(rows, cuts).join(F.broadcast(starts), "range")
              .withColumn("before", F.col("range_bytes") + F.sum("size").over(order) - F.col("size"))
              .withColumn("index", F.col("range_rows") + F.row_number().over(order) - 1)
              .withColumn("unit_before", F.when(F.col("cut"), F.col("before")).otherwise(F.min("before").over(same)))
              .withColumn("unit", F.when(F.col("cut"), F.col("size")).otherwise(F.sum("size").over(same))))
    middle = f"cast(least({shards - 1}, (2 * unit_before + unit) * {shards} div {max(1, 2 * total)}) as int)"
    placed = materialize(placed.select("row", "size", "crc", F.expr(middle).alias("shard"), "index"), "shard-places")
    first = placed.groupBy("shard").agg(F.min("index").alias("first"))  # a row a shard
    return placed.join(F.broadcast(first), "shard").select(
        *(F.col("row")[c].alias(c) for c in columns), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("index") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """``docs`` as Parquet, a folder a shard; a shard's rows are spread over files, each ordered by slot."""
    (assign(docs, shards).hint("rebalance", "shard").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
