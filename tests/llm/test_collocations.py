"""Collocations and the filters they are counted in, against plain counting."""

import random
import re
from collections import Counter

import numpy as np

from bookflow.llm import collocations as C
from bookflow.llm.quotient_filter import Filter, permute, restore

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string"


def _plain(rows, least, share, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    for p, a in often.items():
        lang, w = p[0], p[1:]
        if len(w) == 2 and any(len(q) == 4 and q[0] == lang and w in (q[1:3], q[2:4]) and 100 * b >= share * a for q, b in often.items()):
            continue
        score, k, l, r = min((1000000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    got, rank = [], Counter()
    for lang, s, a, p, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], p.decode(), -a, l, r, n[lang], -s))
    return got


def _rows(seed):
    rnd = random.Random(seed)
    some = ["New", "york", "é", "the", "of", "in", "a b", "x-1", "　", "ÉT", "日本", "nul\0l"]
    rows = [(i, "".join(rnd.choice(some) + rnd.choice([" ", " ", "  ", "\t", " ", ". ", "\n", "!"]) for _ in range(rnd.randint(0, 40))), rnd.choice(["en", "fr", None, "und"])) for i in range(150)]
    return rows + [(1, None, "en"), (2, "", None), (3, " .,;", "en"), (None, "new york city " * 300, "en"), (4, "new york", "en"), (4, "new york", "en")]


def _got(df):
    return [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.orderBy("lang", "rank").collect()]


def test_collocations_against_plain_counts(spark):
    rows = _rows(1)
    docs = spark.createDataFrame(rows, DOCS).repartition(5).selectExpr("*", "1 word", "2 id", "3 f")
    for least, share, top in ((3, 50, 2000), (10, 90, 7), (1, 101, 100000)):
        assert _got(C.collocations(docs, least, share, top, block=200, flush=300)) == _plain(rows, least, share, top)
    assert _got(C.collocations(docs)) == _plain(rows, 10, 50, 2000)
    assert C.collocations(docs.limit(0)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, None, None), (2, " ", "x")], DOCS)).collect() == []


def test_words_that_share_an_id(spark, monkeypatch):
    """Two words of one hash are told apart and the second one gets an id of its own."""
    import pyarrow as pa

    data = np.frombuffer(b"one two one", np.uint8)
    first = C.Tokens(data, np.array([0, 11]), pa.array(["en"]), {})
    assert first.id[0] == first.id[2] != first.id[1]
    again = C.Tokens(data, np.array([0, 11]), pa.array(["en"]), {("en", b"two"): 7, ("fr", b"one"): 9})
    assert again.id.tolist() == [first.id[0], 7, first.id[0]]
    id_, lang, word, number = first.distinct()
    assert dict(zip(word.to_pylist(), number.tolist())) == {"one": 2, "two": 1} and lang.to_pylist() == ["en", "en"]


def test_permutation_and_filters():
    rng = np.random.default_rng(3)
    for n in (2, 3):
        grams = [rng.integers(0, 40, 5000).astype(np.uint64) * np.uint64(0x1234567890ABCDEF) for _ in range(n)]
        limbs = permute(grams)
        assert all((a == b).all() for a, b in zip(restore(limbs), grams))
        want = Counter(zip(*(g.tolist() for g in grams)))
        parts = [Filter.of([x[i::3] for x in limbs]) for i in range(3)]
        for bits in (0, 3, 9):
            blocks: dict[int, list] = {}
            for f in parts:
                for block, own in f.blocks(bits):
                    back = Filter.unpack(own.pack(bits), block, bits)
                    assert all((a == b).all() for a, b in zip(back.limbs, own.limbs)) and (back.counts == own.counts).all()
                    blocks.setdefault(block, []).append(back)
            got = Counter()
            for own in blocks.values():
                f = Filter.merged(own)
                got.update(dict(zip(zip(*(x.tolist() for x in restore(f.limbs))), f.counts.tolist())))
            assert got == want
    tied = [np.array([5, 5, 5, 5], np.uint64), np.array([2, 1, 2, 1], np.uint64)]  # equal first limbs of different n-grams
    f = Filter.of(tied, np.array([300, 1, 400, 2]))
    assert f.limbs[1].tolist() == [1, 2] and f.counts.tolist() == [3, 700]
    back = Filter.unpack(f.pack(4), 0, 4)
    assert back.counts.tolist() == [3, 700] and back.limbs[0].tolist() == [5, 5]
    assert list(Filter.of([np.zeros(0, np.uint64)] * 2).blocks(3)) == []
