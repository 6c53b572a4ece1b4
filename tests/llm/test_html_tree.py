"""The style tree of HTML extraction: against a plain version, unmarked menus and footers, odd rows."""

import math
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from bookflow.llm import html_extract

PAGES = "page_id long, url string, html string"


def _site(host, n, first=0):
    """Pages whose menu, footer and notice no tag or class gives away."""
    return [(first + i, f"https://{host}/{i}", f"<body><div><ul><li>Start</li><li>About {host}</li></ul></div><div class=x><h1>Title {i}</h1>"
             f"<p>Text {i} of {host}.</p><p>Same last line</p></div><div class=z>All rights with {host}</div></body>") for i in range(n)]


def _plain(rows, prior=html_extract.PRIOR):
    """(host, path) to importance, counted page by page."""
    seen, style, content = set(), defaultdict(Counter), defaultdict(Counter)
    for _, url, source in rows:
        page, host = html_extract.Page(source), url.split("/")[2]
        text = tuple(t for _, t in page.main())
        if (host, text) in seen:
            continue
        seen.add((host, text))
        s, c = defaultdict(list), defaultdict(list)
        for n in page.nodes[1:]:
            if not n.noise:
                s[n.path].append(tuple(n.children))
                c[n.path] += n.texts
        for p in s:
            style[host, p][tuple(s[p])] += 1
            if c[p]:
                content[host, p][tuple(c[p])] += 1

    def entropy(counts):
        m = sum(counts.values())
        return 1.0 if m == 1 else -sum(x / m * math.log(x / m, m) for x in counts.values())

    out = {}
    for key, counts in style.items():
        m = sum(counts.values())
        own = 1 - (1 - entropy(counts)) * (1 - entropy(content[key])) if key in content else 1.0
        out[key] = (m * own + prior) / (m + prior)
    return out


def test_tree_against_plain_counts(spark):
    rows = _site("a", 12) + _site("b", 2, 100) + [(200 + i, f"http://c/{i % 3}", f"<p>{i % 4}</p><div><p>x</p>{'<i>y</i>' * i}</div>") for i in range(9)]
    df = spark.createDataFrame(rows, PAGES).select(F.regexp_extract("url", "://([^/]*)", 1).alias("host"), "html")
    got = {(r.host, r.path): r.importance for r in html_extract.style_tree(df).collect()}
    want = _plain(rows)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_unmarked_menus_and_footers_go(spark):
    rows = _site("a", 30) + _site("b", 1, 100) + _site("a", 1, 200)  # b's only page says nothing about what repeats
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == f"Title {i} Text {i} of a. Same last line" for i in range(30)) and got[200] == got[0]
    assert got[100] == "Start About b Title 0 Text 0 of b. Same last line All rights with b"


def test_deep_nesting_long_pages_and_odd_tables(spark):
    deep = "<div>" * 20_000 + "core" + "</div>" * 20_000
    long = "<article>" + "".join(f"<p>word {i}</p>" for i in range(50_000)) + "</article>"
    rows = [(1, "http://d/1", deep), (2, "http://d/2", long), (3, None, None), (3, None, None), (None, "no host", "<p>x &amp; y")]
    df = spark.createDataFrame(rows, PAGES).withColumn("TEXT", F.lit("old")).withColumn("host", F.lit(7)).withColumn("low", F.lit(8)).withColumn("row", F.lit(9))
    begin = time.time()
    got = html_extract.extract(df)
    assert got.columns == ["page_id", "url", "host", "low", "row", "text"]
    found = Counter((r.page_id, r.text, r.host, r.low, r.row) for r in got.collect())
    assert found == Counter([(1, "core", 7, 8, 9), (2, " ".join(f"word {i}" for i in range(50_000)), 7, 8, 9), (3, "", 7, 8, 9), (3, "", 7, 8, 9), (None, "x & y", 7, 8, 9)])
    assert time.time() - begin < 120
    assert html_extract.extract(df.limit(0)).collect() == []


def test_paths_take_memory_by_node_only():
    page = html_extract.Page("<div>" * 5_000 + "x")
    assert len({n.path for n in page.nodes}) == 5_001 and all(isinstance(n.path, int) for n in page.nodes)
