"""HTML extraction by site style trees.

The DOMs of a host's pages are merged into one tree: its nodes are the paths of block elements (tag with class and id
words, inline elements see through). For every node the pages that have it differ in presentation (the sequence of
child elements) and in content (the text directly in it); the entropy of each over these pages, 0 when all agree and 1
when all differ, gives the node's importance: 1 - (1 - presentation) x (1 - content). Branches of low importance are
removed from each page of the host. Pages with the same text count once, so copies of a page don't make its text look
like boilerplate. Few pages are little evidence: a node's importance is the mean of what its pages say and of ``PRIOR``
pages more that say it is content, so it moves smoothly from 1 to what the pages say.

Elements that are presentation by what they are (scripts, styles, menus, footers, forms, and those whose class, id or
role says advert, sidebar, notice, comments, ...) have no importance anywhere, whatever the host: comments and related links
differ from page to page as articles do, so entropy can't tell them. What stands outside articles or a main element is
judged like all else.

The tree is statistics only: counts are summed per host, node and value before they meet, so a host with a third of
all pages is no task's burden. Null html is empty; a null URL's host is the empty one; unclosed and misplaced tags are
read on; repeated pages are extracted each; an empty table gives an empty result; a ``text`` column of the input is replaced.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.llm import urls
from bookflow.llm.common import materialize, small_batches

PRIOR = 1.0
IMPORTANCE = 0.2

# HTML's element names and the words that name presentation.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead tr ul button select option optgroup noscript template svg object canvas video audio search""".split())
PRESENTATION = frozenset("""head nav aside footer form button select option optgroup noscript template svg object canvas video
    audio menu dialog search""".split())
CLOSES_P = BLOCK - frozenset("button select option optgroup noscript template svg object canvas video audio".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",)}
WORDS = frozenset("""nav navbar navigation menu submenu topbar masthead footer sidebar aside widget widgets ad ads advert adverts
    advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup
    modal overlay newsletter subscribe subscription signup login search share sharing social comment comments commentlist reply
    replies respond disqus discussion related recommended recommendations breadcrumb breadcrumbs pagination pager toolbar skip
    copyright disclaimer hidden complementary contentinfo outbrain taboola""".split())
OUTSIDE = frozenset(["header"])  # a page's header; an article's own is content

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMES = re.compile(r"""(?<![^\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_LAYOUT = re.compile(r"(has|with|no|without|is)[-_]", re.I)  # "has-sidebar" doesn't say that this is one
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _words(attributes: str) -> tuple[frozenset[str], str]:
    """The words of class, id and role, and the node's name in a path; ``hidden`` stands for not shown."""
    words, names = set(), []
    for m in _NAMES.finditer(attributes):
        key, value = m[1].lower(), next((x for x in m.groups()[1:] if x is not None), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            words.add("hidden")
        elif key in ("class", "id", "role"):
            for part in value.split():
                if not _LAYOUT.match(part):
                    words.update(w.lower() for w in _WORD.findall(part))
            names.append(re.sub(r"\d+", "0", value))
    return frozenset(words), ".".join(names)


class _Node:
    """``path`` is a hash of the parent's and the own name, so deep nesting costs no more than the nodes."""

    __slots__ = ("tag", "path", "children", "texts", "noise", "article", "main", "open")

    def __init__(self, tag, path, noise, article, main):
        self.tag, self.path, self.noise, self.article, self.main = tag, path, noise, article, main
        self.children, self.texts = [], []


class Page:
    """The blocks of a page in order: (node, text), and the nodes by path."""

    def __init__(self, source: str):
        root = _Node("", 0, False, False, False)
        self.nodes, self.blocks = [root], []
        stack, text, last, end = [root], [], 0, len(source)

        def flush():
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                self.blocks.append((stack[-1], words))
                stack[-1].texts.append(words)
            text.clear()

        def close(names, until=()):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in names:
                    flush()
                    del stack[i:]
                    return True
                if stack[i].tag in until:
                    return False
            return False

        at = 0
        while m := _TAG.search(source, at):
            text.append(source[last:m.start()])
            at = last = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    text.append(html.escape(m[0][9:-3]))
                continue
            if m[1] or m[4]:
                if tag in BLOCK or any(n.tag == tag for n in stack):
                    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                        close(("h1", "h2", "h3", "h4", "h5", "h6"))
                    else:
                        close((tag,), ("table",) if tag not in ("table", "body", "html", "article", "main", "div", "section", "td", "th", "tr", "tbody") else ())
                elif tag in ("br", "p"):
                    text.append("\n")
                continue
            attributes = m[3] or m[6] or ""
            if tag in RAW:
                close_tag = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                stop = close_tag.start() if close_tag else end
                last = at = stop
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    text.append("\n")
                continue
            if tag not in BLOCK and not (attributes.strip() and (found := _words(attributes)[0]) and (found & WORDS or "hidden" in found)):
                continue  # an inline element is no node, unless it is presentation
            if tag in CLOSES_P:
                close(("p",), ("table", "button", "object", "td", "th", "li", "div", "article", "section", "main", "body"))
            if tag in CLOSED_BY:
                close(CLOSED_BY[tag], ("ul", "ol", "menu", "dl", "table", "select"))
            flush()
            words, name = _words(attributes) if attributes.strip() else (frozenset(), "")
            up = stack[-1]
            article = up.article or tag == "article"
            inside = article or up.main or tag == "main"
            noise = up.noise or tag in PRESENTATION or (tag not in ("html", "body", "article", "main") and (
                bool(words & WORDS) or (not inside and (tag in OUTSIDE or bool(words & OUTSIDE))))) or "hidden" in words or bool(words & {"comment", "comments"}) and tag not in ("html", "body")
            node = _Node(tag, _hash(f"{up.path}/{tag}.{name}"), noise, article and not noise, (up.main or tag == "main") and not noise)
            up.children.append(tag)
            self.nodes.append(node)
            if not attributes.rstrip().endswith("/") or tag != "svg":
                stack.append(node)
        text.append(source[last:])
        flush()

    def main(self) -> list[tuple[_Node, str]]:
        """The blocks that can be main text, inside an article or main element or not."""
        return [(n, t) for n, t in self.blocks if not n.noise]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _node_rows(batches):
    """Per page: its text's hash, and per path the hashes of presentation and content."""
    value = pa.struct([("path", pa.int64()), ("style", pa.int64()), ("content", pa.int64())])
    for batch in batches:
        hosts, articles, nodes = [], [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source or "")
            style, content = {}, {}
            for n in page.nodes:
                if not n.noise and n.path:
                    style.setdefault(n.path, []).append(" ".join(n.children))
                    content.setdefault(n.path, []).extend(n.texts)
            hosts.append(host)
            articles.append(_hash("\n".join(t for _, t in page.main())))
            # a node that holds no text itself is judged by its presentation alone
            nodes.append([{"path": p, "style": _hash("\n".join(style[p])), "content": _hash("\n".join(c)) if c else None} for p, c in content.items()])
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(articles, pa.int64()), pa.array(nodes, pa.list_(value))], names=["host", "article", "nodes"])


def style_tree(pages: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(host, path, pages, importance) of the site style trees of ``pages`` (host, html); path is a hash."""
    rows = (pages.select("host", "html").mapInArrow(_node_rows, "host string, article long, nodes array<struct<path:long,style:long,content:long>>")
            .dropDuplicates(["host", "article"]).select("host", F.explode("nodes").alias("n")))
    values = rows.select("host", "n.path", F.explode(F.array(
        F.struct(F.lit("style").alias("kind"), F.col("n.style").alias("value")),
        F.struct(F.lit("content").alias("kind"), F.col("n.content").alias("value")))).alias("v")).select("host", "path", "v.*")
    counts = values.filter("value is not null").groupBy("host", "path", "kind", "value").count()
    c = F.col("count")
    entropy = counts.groupBy("host", "path", "kind").agg(F.sum(c).alias("m"), F.sum(c * F.log(c)).alias("s"))
    entropy = entropy.withColumn("h", F.when(F.col("m") > 1, (F.log("m") - F.col("s") / F.col("m")) / F.log("m")).otherwise(F.lit(1.0)))
    tree = entropy.groupBy("host", "path").agg(F.max("m").alias("pages"), F.max(F.when(F.col("kind") == "style", F.col("h"))).alias("style"),
                                               F.max(F.when(F.col("kind") == "content", F.col("h"))).alias("content"))
    importance = F.when(F.col("content").isNull(), F.lit(1.0)).otherwise(1 - (1 - F.coalesce("style", F.lit(0.0))) * (1 - F.col("content")))
    return tree.select("host", "path", "pages", ((F.col("pages") * importance + prior) / (F.col("pages") + prior)).alias("importance"))


def _extracted(batches):
    for batch in batches:
        out = []
        for source, low in zip(*(batch.column(i).to_pylist() for i in (1, 2))):
            low = set(low or ())
            blocks = Page(source or "").main()
            if low:
                blocks = [(n, t) for n, t in blocks if n.path not in low]
            out.append(" ".join(t for _, t in blocks))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])


def extract(pages: DataFrame, prior: float = PRIOR, importance: float = IMPORTANCE) -> DataFrame:
    """``pages`` (url, html, any others) without html, with text."""
    own = [c for c in pages.columns if c.lower() not in ("html", "text")]
    held = small_batches(pages).select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), urls.host("url").alias("host"), "html")
    tree = style_tree(held, prior)
    low = materialize(tree.filter(F.col("importance") < importance)
                      .groupBy("host").agg(F.collect_list("path").alias("low")), "style_tree")
    joined = held.join(low, "host", "left").select("row", "html", "low")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_extracted, f"row {kind}, text string").select("row.*", "text")
