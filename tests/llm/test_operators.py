"""The ten operators against brute force, round trips and held-out labels, on small fixtures with odd rows."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
import zlib
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bookflow.llm import chat_format, decontaminate, embedding_dedup, html_extract, language_id, packing, simhash_dedup, suffix_dedup, toxicity, url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXT = "doc_id long, text string"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_suffix_dedup_against_all_windows(spark):
    rnd = random.Random(1)
    base = ["".join(rnd.choice("ab cé") for _ in range(rnd.randint(0, 600))) for _ in range(20)]
    texts = [None, "", "a" * 700, "a" * 300, *base[:8], *base[:3]]
    texts += [b[:200] + "#" + rnd.choice(base) for b in base]
    rows = [(i if i != 7 else 6, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    raw = [(t or "").encode() for _, t in rows]
    for size, anchor in ((200, 40), (30, 8)):
        seen = Counter(b[i:i + size] for b in raw for i in range(len(b) - size + 1))
        want = Counter()
        for (d, _), b in zip(rows, raw):
            gone = [False] * len(b)
            for i in range(len(b) - size + 1):
                if seen[b[i:i + size]] > 1:
                    gone[i:i + size] = [True] * size
            want[(d, len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g))] += 1
        got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, TEXT).withColumn("spans", F.lit(1)).withColumn("h", F.lit(2)), size, anchor)
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got.collect()) == want
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], TEXT)).count() == 0


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    bits = Counter(b for s in parts for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, n in bits.items() if 2 * n > len(parts))


@pytest.mark.parametrize("longest", [simhash_dedup.LIST, 8])
def test_simhash_components(spark, longest):
    rnd = random.Random(2)
    rows = [(rnd.randint(-50, 9999), None if i % 40 == 0 else " \n\t"[i % 3].join(rnd.choice(["a", "bé", "C"]) for _ in range(rnd.randint(0, 5)))) for i in range(120)]
    base = [f"w{i}" for i in range(400)]
    for i in range(60):
        words = list(base)
        for _ in range(rnd.randint(0, 9)):
            words[rnd.randrange(400)] = f"q{rnd.random()}"
        rows.append((20000 + i, "  ".join(words)))
    prints = [_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    least = {g: min(d for (d, _), x in zip(rows, group) if x == g) for g in set(group)}
    df = spark.createDataFrame(rows, TEXT)
    got = simhash_dedup.near_duplicates(df, longest=longest).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == Counter((d, p, least[g]) for (d, _), p, g in zip(rows, prints, group))
    assert simhash_dedup.one_of_each(df).count() == len(least)


def test_simhash_keeps_one_row_of_each_component(spark):
    texts = [" ".join(f"{c}{i}" for i in range(50)) for c in "abcdef"]
    rows = [(None, t) for t in texts[:3]] + [(None, texts[0]), (5, texts[3]), (5, texts[4]), (7, texts[3]), (8, texts[4]), (5, texts[4]), (9, texts[5]), (None, texts[5])]
    got = simhash_dedup.one_of_each(spark.createDataFrame(rows, TEXT)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([*((None, t) for t in texts[:3]), (5, texts[3]), (5, texts[4]), (9, texts[5])])


def test_triples_cover_any_four_positions():
    assert len(simhash_dedup.triples()) == 20
    assert all(any(set(t) <= set(q) for t in simhash_dedup.triples()) for q in combinations(range(8), 4))


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 40])
def test_decontamination_against_all_windows(spark, block):
    words = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    rnd = random.Random(3)
    some = lambda n: " .,\n"[rnd.randrange(4)].join(rnd.choice(["a", "Bé", "c", "dd9", "q-r"]) for _ in range(n))
    items = [(i, some(n)) for i, n in enumerate((25, 12, 30, 3, 0, 1))] + [(9, None), (1, some(11))]
    docs = [(i, None if i % 17 == 0 else some(rnd.choice([0, 2, 40])) + " " + (items[i % 4][1] or "")[rnd.randint(0, 5):]) for i in range(60)]
    phrases = {}
    for item, t in items:
        w = words(t)
        for p in [tuple(w[i:i + 10]) for i in range(len(w) - 9)] or ([tuple(w)] if w else []):
            phrases.setdefault(p, set()).add(item)
    want = Counter()
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in phrases:
                    found |= phrases[tuple(w[i:i + n])]
                    hit |= set(range(i, i + n))
        want[(d, len(w), len(hit), tuple(sorted(found)))] += 1
    df, b = spark.createDataFrame(docs, TEXT).withColumn("items", F.lit("x")), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.search(df, b, block_bytes=block).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    cut = decontaminate.remove_hits(df, b, block_bytes=block)
    assert cut.columns == df.columns and cut.filter("doc_id = 0 and text is null").count() == 1


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 1])
def test_decontamination_by_items_without_an_id(spark, block):
    items = [(None, "alpha beta"), (0, "gamma"), (None, "delta"), (3, "delta"), (None, None)]
    docs = [(1, "x Alpha beta y"), (2, "gamma delta alpha"), (3, "gamma"), (4, "alpha delta beta"), (5, None)]
    df, b = spark.createDataFrame(docs, TEXT), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.search(df, b, block_bytes=block).collect()}
    assert got == {1: (2, [None]), 2: (2, [0, 3, None]), 3: (1, [0]), 4: (1, [3, None]), 5: (0, [])}
    assert [r.text for r in decontaminate.remove_hits(df, b, block_bytes=block).sort("doc_id").collect()] == ["x  y", " alpha", "", "alpha  beta", None]


def test_packing_places_every_token(spark):
    library = Tokenizer.from_file(TOKENIZER)
    docs = [(1, None), (1, None), (None, ""), (2, "don't we're 'x ''s <|endoftext|> é中   ½\n\n a"), (3, "word " * 5000)] + [(i, "ab " * (i * 7 % 900)) for i in range(4, 60)]
    want = Counter()
    for d, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        for piece, at in enumerate([0, *range(first, len(ids), 1024)]):
            end = at + (1024 if piece else first)
            want[(d, piece, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes()))] += 1
    got = packing.pack_documents(spark.createDataFrame(docs, TEXT), TOKENIZER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 1024


def test_plan_swaps_the_smallest_for_a_better_pair():
    assert packing.plan({60: 1, 30: 1, 25: 1, 14: 1}, 100)[0] == (1, [60, 25, 14])
    assert packing.plan({}, 100) == []


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 6) for i in range(20)]
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [float("nan")] * 6), (2003, [None] + [1.0] * 5), (2004, [1.0, 2.0]), (2005, [2.0, 4.0]), (2006, [])]
    usable = [(v, np.array(e)) for v, e in rows if e and None not in e and np.isfinite(e).all() and any(e)]
    links = {v: sum(w != v and len(f) == len(e) and f @ e / np.linalg.norm(e) / np.linalg.norm(f) >= 0.9 for w, f in usable) for v, e in usable}
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=100).collect()}
    assert len(got) == len(rows) and sum(got[v].n_links for v, _ in rows) >= 0.99 * sum(links.values())
    assert all(got[v].n_links <= n for v, n in links.items()) and got[2005].component_id == 2004 and not got[2005].kept
    assert all(got[v].n_links == 0 and got[v].kept for v in (2000, 2001, 2002, 2003, 2006))


def test_embedding_recall_is_per_vector(spark):
    rng = np.random.default_rng(1)
    dense = np.ones(40) + rng.normal(size=(100, 40)) * 0.01
    lone = np.repeat(rng.normal(size=(50, 40)), 2, axis=0) + rng.normal(size=(100, 40)) * 0.01
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate((dense, lone)))]
    vertices = spark.createDataFrame(rows, "k long, vector array<double>, weight long")
    links = spark.createDataFrame([(i, 99 if i < 100 else i % 2) for i in range(200)], "k long, links long")
    assert embedding_dedup.audit_recall(vertices, links) <= 0.51


def _planted(rng, d=32):
    """Groups of two to 300 alike vectors, a chain and single ones, about their all-pairs links."""
    groups = [np.repeat(rng.normal(size=(1, d)), n, axis=0) + rng.normal(size=(n, d)) * s for n, s in [(2, 0.3)] * 60 + [(20, 0.3)] * 10 + [(300, 0.25)]]
    chain = np.cumsum(np.concatenate((rng.normal(size=(1, d)), rng.normal(size=(120, d)) * 0.3)), axis=0)
    x = np.concatenate((*groups, chain, rng.normal(size=(400, d))))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x, np.fill_diagonal(t := unit @ unit.T >= 0.9, False) or t


def test_embedding_graph_alone_finds_planted_links():
    x, want = _planted(np.random.default_rng(4))
    unit = embedding_dedup._unit(x)
    found = embedding_dedup.range_links(embedding_dedup.build_graph(unit), unit, 0.9, embedding_dedup.BEAM)
    linked = want.any(axis=1)
    assert not (found & ~want).any()
    assert (found.sum(axis=1)[linked] / want.sum(axis=1)[linked]).mean() >= 0.99


@pytest.mark.parametrize("centroids", [embedding_dedup.CENTROIDS, 4])
def test_embedding_planted_groups_over_clusters(spark, centroids):
    """Few and many clusters, and clusters that are parts of cells; extra columns, repeated ids, an empty table."""
    x, want = _planted(np.random.default_rng(6))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, shard=200, centroids=centroids).collect()}
    links, linked = want.sum(axis=1), want.any(axis=1)
    mine = np.array([got[i].n_links for i in range(len(x))])
    assert (mine <= links).all() and (mine[linked] / links[linked]).mean() >= 0.99
    pairs = np.arange(0, 120, 2)  # the groups of two that are alike: one component each
    alike = [i for i in pairs if want[i, i + 1] and links[i] == links[i + 1] == 1]
    assert len(alike) > 20 and sum(got[i + 1].component_id == i and got[i].kept and not got[i + 1].kept for i in alike) >= 0.98 * len(alike)
    twice = df.limit(3).union(df.limit(3)).union(spark.createDataFrame([(None, [1.0] * 32, 1)], df.schema))
    assert [(r.vec_id, r.n_links) for r in embedding_dedup.near_duplicates(twice).orderBy("vec_id").collect()][0] == (None, 0)
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_embedding_search_widens_to_the_target_or_fails(spark, monkeypatch):
    x = np.random.default_rng(2).normal(size=(300, 5))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, overlap=1, shard=60, target=1.0).collect()}
    assert [got[i] for i in range(300)] == want.tolist()
    monkeypatch.setattr(embedding_dedup, "audit_recall", lambda *a: 0.5)
    with pytest.raises(RuntimeError):
        embedding_dedup.near_duplicates(df.limit(20), target=1.0)


def test_grammar_round_trip_of_control_strings():
    rnd = random.Random(0)
    signs = ["###", " ", "</turn>", "\\", "\n", "a", "### User: ", " </turn>\n", ":", "=", "<"]
    for _ in range(3000):
        role, text = rnd.choice(["user", "assistant", "", "x:y", "a\\", "\n", "User", " </turn>\n"]), "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 8)))
        formatted, begin, end, _ = chat_format.format_turn(role, text)
        assert chat_format.parse(formatted) == (role, text, begin, end, len(formatted))


def test_html_extraction_keeps_the_article(spark):
    page = """<html><head><title>t</title></head><body class="has-sidebar"><header>H</header><nav>m</nav><div class="cookie-notice">c</div><main>
      <aside>s</aside><article><h1>T &amp; x</h1><p>one  two<br>three <b>bo<i>l</i>d</b>.<p>p2<div class=ad>AD</div><ul><li>i1<li>i2</ul><script>if (a<b) "</p>"</script>
      <form>f</form><span class="share">S</span>tail &#233;<section id="comments"><p>c!</p></section></article></main><footer>F</footer>"""
    rows = [(1, "http://a.net/1", page), (2, None, None), (3, "x", "<p>open"), (1, "http://a.net/1", page)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(1, "T & x one two three bold. p2 i1 i2 tail é")] * 2 + [(2, ""), (3, "open")]


def test_style_tree_removes_what_a_host_repeats(spark):
    rows = [(i, "http://h.net/", f"<div class=x>the same everywhere</div><div class=y>article number {i}</div>") for i in range(12)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"article number {i}" for i in range(12)}


def test_html_extraction_keeps_text_outside_articles(spark):
    page = "<h1>head {0}</h1><main><div class=content><p>body {0}</p></div></main><article>one teaser</article><div class=x>the same everywhere</div>"
    rows = [(i, "http://h.net/", page.format(i)) for i in range(12)] + [(20, "http://few.net/", "<div class=content>body</div><article>teaser</article>")]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"head {i} body {i}" for i in range(12)}, 20: "body teaser"}


def test_url_rules_and_mined_rules(spark):
    urls = ["http://A.Example.net/en/x", "https://b.net/q", "http://example.com/de/1", "http://x.org/fr/?a", "http://a.net", None, "no scheme", "http://badnet/en/"]
    pages = [(i, u) for i, u in enumerate(urls)] + [(100 + i, f"http://casino{'' if i % 2 else 'x'}.info/{i}") for i in range(40)]
    labels = [(100 + i, i % 2 == 0 and 1 or 0, 0) for i in range(40)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"),
                                                 spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert [got[i].rule for i in range(8)] == ["example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None, None]
    assert [got[i].verdict for i in range(8)] == ["allow", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert got[0].host == "a.example.net" and got[5].host == got[5].path == ""
    assert got[101].verdict == "block" and got[100].verdict == "allow"


def test_language_and_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs)
    got = language_id.predict(docs, model).filter(language_id.held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (4, "—")], TEXT)
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()} == {("und", 0.0)}
    texts = ["the idiot is here", "the house is here"] * 60
    net = toxicity.fit([f"{t} w{i}" for i, t in enumerate(texts)], [1, 0] * 60, ["en"] * 120)
    scored = toxicity.score(spark.createDataFrame([(1, "an idiot there"), (2, "a house there"), (3, None)], TEXT), net).collect()
    assert [r.predicted for r in sorted(scored)] == [1, 0, 0]
    assert toxicity.score(odd, toxicity.fit([], [], [])).filter("score = 0").count() == 4
