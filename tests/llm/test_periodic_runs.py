"""Periodic runs against every period of every stretch, tried plainly."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookflow.llm import periodic_runs as R

DOCS = "doc_id long, text string"


def _plain(words):
    """{(start, length, period)}: a stretch that no neighbour extends, with its least period."""
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            s = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - s >= max(6, 4 * q) and not any(all(words[k] == words[k - p] for k in range(s + p, i)) for p in range(1, q)):
                out.add((s, i - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def _text(rnd):
    words = []
    while len(words) < rnd.randint(1, 260):
        unit = [rnd.choice(["a", "b", "é", "A", "日本"]) for _ in range(rnd.choice([1, 1, 2, 3, 5, 8, 13, 21]))]
        words += unit * rnd.choice([1, 2, 3, 4, 5, 9]) + unit[:rnd.randint(0, len(unit))] + [rnd.choice("xyz")] * rnd.randint(0, 2)
    return "".join(w + rnd.choice([" ", " ", "\n", "\t ", " \x0b", "\x0c\r"]) for w in words)


def _rows():
    rnd = random.Random(4)
    rows = [(i, _text(rnd)) for i in range(120)]
    rows += [(None, None), (1, ""), (2, " \n"), (3, "a"), (3, "a a a a a"), (3, "a a a a a a"), (5, "same " * 3000), (5, "same " * 3000), (6, "x " + "p q r s t u v " * 400 + "z")]
    return rows


@pytest.mark.parametrize("long, tiles", [(R.LONG, R.TILES), (300, 128), (0, 64)])
def test_runs_against_all_periods(spark, long, tiles):
    rows = _rows()
    want = Counter()
    for d, t in rows:
        words = (t or "").encode().split()
        words = [w.decode() for w in words]
        found = _plain(words) if len(words) < 2000 else {3000: [(0, 3000, 1)], 2802: [(1, 2800, 7)]}[len(words)]
        want[(d, t, len(words), tuple(found), _collapsed(words, found))] += 1
    docs = spark.createDataFrame(rows, DOCS).repartition(6).withColumns({"runs": F.lit(1), "key": F.lit(2), "row": F.lit(3), "Collapsed": F.lit(4)})
    got = R.collapse_runs(docs, long=long, tiles=tiles).collect()
    assert Counter((r.doc_id, r.text, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in got) == want
    assert all(r.key == 2 and r.row == 3 for r in got)


def test_digest_and_empty_table(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, DOCS)
    texts = sorted((r.doc_id or 0, sha256(r.collapsed.encode()).hexdigest()) for r in R.collapse_runs(docs).collect())
    short = R.collapse_runs(docs, digest=True)
    assert sorted(short.columns) == ["collapsed", "doc_id", "n_words", "runs"]
    assert sorted((r.doc_id or 0, r.collapsed) for r in short.collect()) == texts
    assert R.collapse_runs(docs.limit(0)).collect() == []


def test_hash_that_lies_is_found_out(monkeypatch):
    code = np.array([1, 2, 1, 2, 1, 2, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9, 9, 9, 9, 1, 2])
    off = np.array([0, 9, len(code)])
    honest = [x.tolist() for x in R.document_runs(code, off)]
    assert honest == [[0, 1], [2, 1], [0, 5], [8, 11]]
    monkeypatch.setattr(R.Codes, "equal", lambda self, a, b, size: np.ones(len(a), bool))
    assert sorted(zip(*(x.tolist() for x in R.document_runs(code, off)))) == sorted(zip(*honest))


def test_octaves_of_tile_rows_cover_all():
    rng = np.random.default_rng(2)
    for n, q in ((5000, 3), (5000, 40), (9000, 700), (4000, 999)):
        code = np.concatenate((rng.integers(0, 99, 37), np.tile(rng.integers(0, 50, q), n // q + 1)[:n], rng.integers(0, 99, 61)))
        k, p, s, e = (np.concatenate(x) for x in zip(*(
            [np.zeros_like(z), y, z + base, w + base] for low, high, base, part in R.tile_rows(code, 128)
            for _, y, z, w in [R.stitched(*R.fragments(R.Codes(part), np.array([0, len(part)]), (low, high)))])))
        got = [x.tolist() for x in R.smallest(*R.stitched(k, p, s, e))]
        want = R.document_runs(code, np.array([0, len(code)]))
        assert sorted(zip(*got)) == sorted(zip(*(x.tolist() for x in want))) and q in got[1]
