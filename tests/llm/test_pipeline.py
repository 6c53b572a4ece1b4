"""Every stage of the pipeline against a plain version of it, on a small table with odd rows; and on an empty one."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from test_operators import LOWER, _fingerprint

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ENGLISH = "the of and with from that this have river stone window garden letter morning paper silver".split()
FRENCH = "le la les des avec pour dans rivière pierre fenêtre jardin lettre matin papier argent été".split()


def _docs():
    rnd = random.Random(8)

    def text(words, n):
        return " ".join(rnd.choice(words) + str(rnd.randint(0, 99)) * (rnd.random() < 0.3) for _ in range(n))

    rows = [(i, text(ENGLISH if i % 3 else FRENCH, rnd.randint(30, 160)), "en" if i % 3 else "fr", f"s{i % 4}") for i in range(40)]
    rows += [(100, rows[0][1], "fr", "s1"), (101, rows[1][1], "en", "s1"), (101, rows[1][1], "en", "s1")]  # copies
    passage = text(ENGLISH, 45)
    rows += [(110 + i, text(ENGLISH, 60) + " " + passage + " " + text(ENGLISH, 60), "en", "s2") for i in range(3)]
    rows += [(120, text(ENGLISH, 50) + " " + ITEM.upper() + " " + text(ENGLISH, 50), "en", "s3")]
    rows += [(None, text(ENGLISH, 90), "en", None), (None, text(FRENCH, 90), None, "s1"), (5, text(ENGLISH, 80), "en", "s0")]  # no id, one id twice
    rows += [(130, None, "en", "s1"), (131, "", "en", "s1"), (132, "12 34 !", "en", "s1"), (None, None, None, None)]
    return [(*r, len(r[1] or "")) for r in rows]


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
BENCHMARK = [(1, ITEM), (2, None), (None, "omega psi chi"), (3, "")]


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def _components(rows):
    prints = [int(_fingerprint(t)) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    return list(groups.values())


def _without_repeats(texts, size=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + size] for b in raw for i in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = [True] * size
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"))
    return out


def _without_hits(text):
    words = [(m.group(0), m.start(), m.end()) for m in re.finditer("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))]
    hit = [False] * len(words)
    for _, item in BENCHMARK:
        own = (item or "").split()
        for phrase in [own[i:i + 10] for i in range(len(own) - 9)] or ([own] if own else []):
            for i in range(len(words) - len(phrase) + 1):
                if [w[0] for w in words[i:i + len(phrase)]] == phrase:
                    hit[i:i + len(phrase)] = [True] * len(phrase)
    out, last, i = [], 0, 0
    while i < len(words):
        if hit[i]:
            j = i
            while j + 1 < len(words) and hit[j + 1]:
                j += 1
            out.append(text[last:words[i][1]])
            last, i = words[j][2], j
        i += 1
    return "".join([*out, text[last:]])


def test_stages_against_plain_versions(spark, tmp_root):
    docs = _docs()
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{tmp_root}/benchmark.parquet")
    df, kept = spark.read.parquet(f"{tmp_root}/documents.parquet"), {}
    for name, stage in P.STAGES:
        df = stage(spark, df, tmp_root)
        df.write.parquet(f"{tmp_root}/{name}")
        df = kept[name] = spark.read.parquet(f"{tmp_root}/{name}")
        assert name == "pack" or sorted(df.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars"])

    language = _rows(kept["language_id"])
    assert Counter(language) == Counter(r for r in docs if any(c.isalpha() for c in r[1] or ""))

    groups, one = _components(language), _rows(kept["simhash_dedup"])
    assert len(one) == len(groups) and all(sum((Counter(g) & Counter(one)).values()) == 1 for g in groups)
    for g in groups:  # the one of the least id
        ids = [r[0] for r in g if r[0] is not None]
        assert [r[0] for r in one if r in g] == [min(ids) if ids else None]

    cut = Counter((r[0], t, r[2], r[3], len(t)) for r, t in zip(one, _without_repeats([r[1] for r in one])))
    assert Counter(_rows(kept["suffix_dedup"])) == cut and sum(len(r[1]) for r in one) > sum(len(r[1]) for r in cut)

    clean = Counter((r[0], t, r[2], r[3], len(t)) for r in _rows(kept["suffix_dedup"]) for t in [_without_hits(r[1])])
    assert Counter(_rows(kept["decontaminate"])) == clean and not any("kappa" in r[1].lower() for r in clean)

    tokenizer = Tokenizer.from_file(P.TOKENIZER)
    pieces = [r.asDict() for r in kept["pack"].collect()]
    want = Counter((r[0], len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1) for r in _rows(kept["decontaminate"]))
    assert all(n <= 1024 for _, n in want)  # so each is one piece
    assert Counter((p["doc_id"], p["length"]) for p in pieces) == want and all((p["piece"], p["start"]) == (0, 0) for p in pieces)
    bins = defaultdict(list)
    for p in pieces:
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    for b in bins.values():
        b.sort()
        assert all(o == sum(n for _, n in b[:i]) for i, (o, _) in enumerate(b)) and sum(n for _, n in b) <= 1024
    assert len(bins) <= 1.2 * -(-sum(p["length"] for p in pieces) // 1024) + 1
    assert P.run(spark, tmp_root).count() == len(pieces)


def test_empty_table(spark, tmp_root):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_root}/benchmark.parquet")
    assert P.run(spark, tmp_root).collect() == []
