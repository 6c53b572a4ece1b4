"""Mined URL rules against all token combinations, tried plainly; and URLs whose tokens always come together."""

import random
import time
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from bookflow.llm import url_filter

PAGES, LABELS = "page_id long, url string", "doc_id long, quality int, toxic int"


def _tokens(url):
    import re

    rest = url.split("://", 1)[1] if url and "://" in url else ""
    return frozenset(t for t in re.split("[^a-z0-9]+", rest.lower()) if t)


def _plain(pages, labels, support, confidence, least):
    """The URLs that some combination blocks: every set of tokens of a labelled page is counted."""
    bad = {}
    for d, q, t in labels:
        bad[d] = bad.get(d, False) or q == 0 or t == 1
    baskets = [(_tokens(u), bad[p]) for p, u in pages if p in bad and _tokens(u)]
    seen, hit = Counter(), Counter()
    for tokens, b in baskets:
        for n in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), n):
                seen[c] += 1
                hit[c] += b
    floor = max(support * len(baskets), least)
    rules = [set(c) for c in seen if hit[c] >= floor - 1e-9 and hit[c] / seen[c] >= confidence]
    return {u for _, u in pages if any(r <= _tokens(u) for r in rules)}


def test_mined_rules_against_all_combinations(spark):
    rnd = random.Random(6)
    names = ["shop", "spam", "win", "blog", "a1", "news", "xyz"]
    pages = []
    for i in range(160):
        own = rnd.sample(names, rnd.randint(1, 4))
        if "win" in own:
            own += ["always", "with", "it"]  # the same pages as win
        pages.append((i, f"http://h{i % 3}.example/" + "/".join(own)))
    labels = [(i, 0 if ("spam" in u and "win" in u) or rnd.random() < 0.2 else 1, 0) for i, u in pages if i % 5] + [(1, None, None), (2, 1, 1)]
    pages += [(900, "http://x/always"), (901, "http://x/win/spam"), (902, "http://x/spam/with"), (903, None), (904, "nothing")]
    p, lab = spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)
    for support, confidence, least in ((0.02, 0.6, 3), (0.002, 0.8, 6), (0.3, 0.5, 1)):
        got = {r.url for r in url_filter.match(p, *url_filter.mine(p, lab, support, confidence, least)).collect()}
        assert got == _plain(pages, labels, support, confidence, least)


def test_long_urls_that_share_a_template(spark):
    """Forty tokens that always stand together are one item, not 2 ** 40 combinations."""
    long = "http://t.example/" + "-".join(f"part{i}" for i in range(40))
    pages = [(i, long) for i in range(30)] + [(100 + i, f"http://other.example/{i}") for i in range(30)]
    labels = [(i, 0 if i < 100 else 1, 0) for i, _ in pages]
    began = time.time()
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)).collect()}
    assert got == {i: "block" if i < 100 else "allow" for i, _ in pages} and time.time() - began < 120
    few = [(i, long) for i in range(3)]
    got = url_filter.judge(spark.createDataFrame(few, PAGES), spark.createDataFrame([(0, 0, 0), (1, 0, 0)], LABELS)).collect()
    assert {r.verdict for r in got} == {"allow"}  # two pages are no evidence


def test_empty_tables_and_repeated_pages(spark):
    p, lab = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (None, None)], PAGES), spark.createDataFrame([], LABELS)
    got = url_filter.judge(p.withColumns({"host": F.lit("clash"), "matched": F.lit(1)}), lab)
    assert Counter((r.page_id, r.host, r.rule, r.verdict, r.matched) for r in got.collect()) == Counter(
        {(1, "a.net", "net/", "block", None): 2, (None, "", None, "allow", None): 1})
    assert url_filter.judge(p.limit(0), lab).collect() == []
