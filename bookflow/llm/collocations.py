"""Phrase collocations, counted in counting quotient filters that are merged across shards of the corpus.

Words are lower-cased for A-Z; phrases are 2 or 3 consecutive words inside a piece (between ``.,;:!?`` and line ends).
Everything is counted by language, null being ``und``: a word's id is a 64-bit hash of the language and the word, and
ids are checked to be one-to-one over all words of the corpus (words that share one get others), so the id stands for
both and counts are exact.

1. All words are counted, by task first.
2. Pairs of words that are each frequent are counted: a task packs the ids of a pair, permutes them and keeps one
   sorted filter for each ``FLUSH`` of them; the filters' blocks are dealt out and merged. A pair that is frequent
   enough consists of words that are.
3. Triples of two frequent pairs, in the same way.

Which words (pairs) are frequent is known to the tasks by one bit of ``BITS`` for each id: a fixed size whatever the
corpus. A bit that several share only lets a phrase be counted that then turns out to be rare; nothing is lost by it.

Null and empty texts have no words; repeated rows count each; an empty table gives an empty result; columns other than
text and lang aren't read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.llm.common import Rolling, byte_words, give_back, mix, runs, small_batches, text_slices
from bookflow.llm.quotient_filter import Filter, permute, restore
from bookflow.session import materialize

LEAST = 10
TOP = 2000
#: Percent of a phrase's count that a longer one must have to stand for it.
SHARE = 50
#: n-grams that a task sorts at a time, and words of the corpus for one block of the merged filters.
FLUSH = 1 << 20
BLOCK = 1 << 19
#: Bits that tell frequent ids; a map of them is 8 MB.
BITS = 26
_PAGE = 15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


def _language_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def _number(word: bytes, language: str, turn: int) -> int:
    """Another id for a word whose own one is taken."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8, key=f"{turn} {language}".encode()[:64]).digest(), "little")


class Tokens:
    """The words of a slice's texts: their ids, bytes, languages, and whether the next word is in the same piece."""

    def __init__(self, data: np.ndarray, off: np.ndarray, languages: pa.Array, taken: dict[tuple[str, bytes], int]):
        kind = _CLASS[data]
        self.data = _LOWER[data]
        self.start, self.end, row = runs(kind == 0, off)
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        self.joined = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
        names = languages.dictionary_encode()
        self.names = names.dictionary.to_pylist()
        self.language = names.indices.to_numpy(zero_copy_only=False)[row] if len(row) else np.zeros(0, np.int32)
        salt = np.array([_language_hash(x) for x in self.names], np.uint64)
        self.id = mix(Rolling(self.data).ranges(self.start, self.end) ^ salt[self.language]) if len(row) else np.zeros(0, np.uint64)
        if taken:
            shared = {self._plain_id(*w) for w in taken}
            for i in np.flatnonzero(np.isin(self.id, np.array(sorted(shared), np.uint64))).tolist():
                word = self.names[self.language[i]], self.data[self.start[i]:self.end[i]].tobytes()
                self.id[i] = taken.get(word, int(self.id[i]))

    @staticmethod
    def _plain_id(language: str, word: bytes) -> int:
        data = np.frombuffer(word, np.uint8)
        h = Rolling(data).ranges(np.array([0]), np.array([len(data)]))
        return int(mix(h ^ np.array([_language_hash(language)], np.uint64))[0])

    def distinct(self):
        """id, language, word and number of the distinct words, told apart by their bytes."""
        coded = byte_words(self.data, self.start, self.end)
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(self.names) + self.language
        value, first, number = np.unique(code, return_index=True, return_counts=True)
        return (self.id[first], pa.array(self.names, pa.string()).take(pa.array(self.language[first])),
                coded.dictionary.take(pa.array(value // max(1, len(self.names)))).cast(pa.binary()).cast(pa.string()), number)


def _word_rows(taken, flush):
    schema = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])

    def rows(batches):
        held, count = [], 0
        for batch, data, off in text_slices(batches):
            id_, language, word, number = Tokens(data, off, batch.column(0), taken).distinct()
            held.append(pa.table([pa.array(id_.view(np.int64)), language, word, pa.array(number, pa.int64())], schema=schema))
            count += len(id_)
            if count >= flush:
                yield from _added(held)
                held, count = [], 0
        if held:
            yield from _added(held)
        give_back()

    def _added(held):
        out = pa.concat_tables(held).group_by(["id", "lang", "word"], use_threads=False).aggregate([("f", "sum")])
        yield from out.rename_columns(["id", "lang", "word", "f"]).cast(schema).to_batches(1 << 16)

    return rows


def _known(bits: np.ndarray, limb: np.ndarray) -> np.ndarray:
    at = limb >> np.uint64(64 - BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filters(words, pairs, taken, block_bits, flush):
    """Rows (block, filter) of the pairs of frequent words, or, given ``pairs``, of the triples of frequent pairs."""
    def made(held):
        limbs = permute([np.concatenate(x) for x in zip(*held)])
        blocks, raw = [], []
        for block, f in Filter.of(limbs).blocks(block_bits):
            blocks.append(block)
            raw.append(f.pack(block_bits))
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(raw, pa.binary())], names=["block", "filter"])

    def rows(batches):
        held, count = [], 0
        for batch, data, off in text_slices(batches):
            t = Tokens(data, off, batch.column(0), taken)
            one = _known(words.value, t.id)
            at = np.flatnonzero(t.joined & one[1:] & one[:-1])
            gram = [t.id[at], t.id[at + 1]]
            if pairs is not None:
                often = at[_known(pairs.value, permute(gram)[0])] if len(at) else at
                at = often[:-1][often[1:] == often[:-1] + 1]
                gram = [t.id[at], t.id[at + 1], t.id[at + 2]]
            if len(at):
                held.append(gram)
                count += len(at)
            if count >= flush:
                yield from made(held)
                held, count = [], 0
        if held:
            yield from made(held)
        give_back()
    return rows


def _merge(block_bits: int, least: int):
    def merged(table):
        block = table.column("block")[0].as_py()
        f = Filter.merged([Filter.unpack(x.as_buffer(), block, block_bits) for x in table.column("filter")])
        often = f.counts >= least
        ids = restore([x[often] for x in f.limbs])
        return pa.table([*(pa.array(x.view(np.int64)) for x in ids), pa.array(f.counts[often])], names=[*(f"id{i + 1}" for i in range(len(ids))), "f"])
    return merged


def _bitmap(limb: DataFrame) -> np.ndarray:
    """One bit for each value of the column ``limb`` (longs), by its first ``BITS`` bits; 2 ** (BITS - 15) rows reach the driver."""
    at = F.shiftrightunsigned("limb", 64 - BITS) + 1
    pages = limb.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros((1 << (BITS - _PAGE), 1 << (_PAGE - 3)), np.uint8)
    for r in pages.toLocalIterator():
        out[r.page - 1] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.ravel()


def _first_limb(batches):
    for batch in batches:
        ids = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2)]
        yield pa.RecordBatch.from_arrays([pa.array(permute(ids)[0].view(np.int64))], names=["limb"])


def word_counts(docs: DataFrame, flush: int = FLUSH) -> tuple[DataFrame, dict]:
    """(id, lang, word, f) of all words, ids one-to-one; and the words that have another id than their own."""
    taken: dict[tuple[str, bytes], int] = {}
    for turn in range(100):
        rows = docs.mapInArrow(_word_rows(dict(taken), flush), "id long, lang string, word string, f long").repartition("id")
        words = materialize(rows.groupBy("id", "lang", "word").agg(F.sum("f").alias("f")), "collocation-words")
        twice = words.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        clash = words.join(twice, "id").select("id", "lang", "word").orderBy("id", "lang", "word").collect()  # none, but for chance
        if not clash:
            return words, taken
        seen = set()
        for r in clash:
            if r.id in seen:
                taken[r.lang, r.word.encode()] = _number(r.word.encode(), r.lang, turn)
            seen.add(r.id)
    raise RuntimeError("no one-to-one word ids were found")


def phrase_counts(docs: DataFrame, least: int = LEAST, block: int = BLOCK, flush: int = FLUSH) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Languages (lang, n); and the words (id, lang, word, f), pairs (id1, id2, f) and triples found at least ``least`` times."""
    spark = docs.sparkSession
    docs = small_batches(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"))
    every, taken = word_counts(docs, flush)
    languages = every.groupBy("lang").agg(F.sum("f").alias("n"))
    total = every.agg(F.sum("f")).first()[0] or 0
    bits = max(0, int(total // block).bit_length())
    words = materialize(every.filter(F.col("f") >= least), "collocation-words")
    known = spark.sparkContext.broadcast(_bitmap(words.select(F.col("id").alias("limb"))))  # of fixed size

    def counted(pairs, n):
        kind = ", ".join(f"id{i + 1} long" for i in range(n)) + ", f long"
        rows = docs.mapInArrow(_filters(known, pairs, taken, bits, flush), "block long, filter binary")
        return materialize(rows.groupBy("block").applyInArrow(_merge(bits, least), kind), "collocation-phrases")

    pairs = counted(None, 2)
    often = spark.sparkContext.broadcast(_bitmap(pairs.select("id1", "id2").mapInArrow(_first_limb, "limb long")))
    return languages, words, pairs, counted(often, 3)


def _score(a: str, l: str, r: str) -> str:
    """floor(1000000 a a / (l r)) of longs, exact: 38 decimal digits."""
    d = "decimal(16,0)"
    return f"(1000000BD * cast({a} as {d}) * cast({a} as {d})) div (cast({l} as {d}) * cast({r} as {d}))"


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, block: int = BLOCK, flush: int = FLUSH) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its worst cut into two parts, floor(1000000 a² / (l r)) for the counts a of the phrase
    and l, r of the parts (ties: the shorter first part). Phrases that a longer one with ``share`` percent of their
    count or more contains are left out."""
    languages, words, pairs, triples = phrase_counts(docs, least, block, flush)

    def of(i):  # a word's count and text
        return words.select(F.col("id").alias(f"id{i}"), F.col("f").alias(f"f{i}"), F.col("word").alias(f"w{i}"), *(["lang"] if i == 1 else []))

    inside = triples.select(F.explode(F.array(F.struct(F.col("id1").alias("id1"), F.col("id2").alias("id2")),
                                              F.struct(F.col("id2").alias("id1"), F.col("id3").alias("id2")))).alias("p"), "f")
    longer = inside.groupBy("p.id1", "p.id2").agg(F.max("f").alias("longer"))
    two = (pairs.join(longer, ["id1", "id2"], "left").filter(F.expr(f"longer is null or 100 * longer < {share} * f"))
           .join(of(1), "id1").join(of(2), "id2")
           .selectExpr("lang", "concat_ws(' ', w1, w2) phrase", "f a", "f1 l", "f2 r", f"{_score('f', 'f1', 'f2')} score"))
    left = pairs.select("id1", "id2", F.col("f").alias("f12"))
    right = pairs.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("f").alias("f23"))
    three = (triples.join(left, ["id1", "id2"]).join(right, ["id2", "id3"]).join(of(1), "id1").join(of(2), "id2").join(of(3), "id3")
             .withColumn("s1", F.expr(_score("f", "f1", "f23"))).withColumn("s2", F.expr(_score("f", "f12", "f3")))
             .selectExpr("lang", "concat_ws(' ', w1, w2, w3) phrase", "f a", "if(s1 <= s2, f1, f12) l", "if(s1 <= s2, f23, f3) r", "least(s1, s2) score"))
    order = F.desc("score"), F.desc("a"), "phrase"
    # the first of each part of a language, then of those: about the root of all its phrases meets in a task
    parts = max(1, math.isqrt((pairs.count() + triples.count()) // top))
    best = two.union(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    for keys in (["lang", "part"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(languages, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
