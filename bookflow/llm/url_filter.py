"""URL filters: explicit host and path rules, and association rules mined from labelled URLs.

Spark's FP-growth finds the token combinations that are frequent among labelled pages (support), and those of them
that predict a bad label (confidence) become rules; a rule that a more general one with at least its confidence covers
is pruned. Tokens that stand in exactly the same labelled pages are one item to the miner (their combinations would be
as many as their subsets and all say the same); a URL has the item if it has any of them, as mining them apart would
give. A rule must hold in at least ``LEAST`` labelled pages, however few there are. Rules are matched by an inverted
index: URL tokens meet the rules' tokens in a join, and a rule matches where all its tokens were met. Each distinct URL
is matched once.

A page is bad if its label says quality 0 or toxic 1; labels are joined by ``page_id = doc_id``. An explicit rule
decides before the mined ones. Null URLs and those without ``://`` have an empty host and path, fit no explicit rule
and are allowed, as nothing is mined for them; repeated pages are judged each; empty labels mine no rule; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.llm import urls
from bookflow.llm.common import materialize

#: (verdict, host, path): fixed values of the task.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT = 0.002
LEAST = 20
CONFIDENCE = 0.6
_BAD = "=bad"  # no token has a sign


def items(labelled: DataFrame, least: int) -> DataFrame:
    """(token, item) of the tokens in at least ``least`` pages of ``labelled`` (page, tokens, each page once): the first
    of the tokens that stand in the same pages. Equal pages are told by their number and two sums of page hashes."""
    seen = labelled.select("page", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.xxhash64("page", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)))
    first = F.min("token").over(W.partitionBy("n", "s1", "s2"))
    return seen.filter(F.col("n") >= least).select("token", first.alias("item"))


def mine(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(rule, tokens, confidence, support) of the item combinations that predict a bad label, and (token, item) of the
    tokens behind the items."""
    bad = (labels.groupBy(F.col("doc_id").alias("page_id"))
           .agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad")))
    labelled = pages.select("page_id", urls.tokens("url").alias("tokens")).join(bad, "page_id").filter(F.size("tokens") > 0)
    labelled = materialize(labelled.select("tokens", "bad", F.monotonically_increasing_id().alias("page")), "url_pages")
    least = max(least, 1)
    known = materialize(items(labelled, least), "url_items")
    merged = labelled.select("page", F.explode("tokens").alias("token")).join(known, "token").groupBy("page").agg(F.collect_set("item").alias("items"))
    baskets = labelled.select("page", "bad").join(merged, "page", "left").select(
        F.concat(F.coalesce("items", F.array().cast("array<string>")), F.when(F.col("bad"), F.array(F.lit(_BAD))).otherwise(F.array().cast("array<string>"))).alias("items"))
    baskets = materialize(baskets, "url_baskets")
    share = min(1.0, max(support, least / max(1, baskets.count())))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(baskets)
    found = materialize(model.associationRules.filter(F.col("consequent") == F.array(F.lit(_BAD)))
                        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "url_rules")
    # a rule goes if a smaller one holds with its confidence; rules meet by tokens of the smaller one
    found = found.withColumn("rule", F.xxhash64("tokens"))
    small = found.select(F.col("rule").alias("general"), F.col("confidence").alias("general_confidence"), F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    covered = (found.select("rule", "confidence", F.size("tokens").alias("size"), F.explode("tokens").alias("token")).join(small, "token")
               .filter("n < size and general_confidence >= confidence").groupBy("rule", "general", "n").count().filter("count = n").select("rule").distinct())
    return found.join(covered, "rule", "left_anti").select("rule", "tokens", "confidence", "support"), known


def match(pages: DataFrame, rules: DataFrame, known: DataFrame) -> DataFrame:
    """(url, matched): the distinct URLs that a mined rule matches, and the highest confidence."""
    index = rules.select("rule", "confidence", F.size("tokens").alias("n"), F.explode("tokens").alias("item"))
    index = index.join(known, "item")
    tokens = pages.select("url").distinct().select("url", F.explode(urls.tokens("url")).alias("token"))
    return tokens.join(index, "token").select("url", "rule", "n", "confidence", "item").distinct().groupBy("url", "rule", "n", "confidence").count().filter("count = n").groupBy("url").agg(F.max("confidence").alias("matched"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST) -> DataFrame:
    """A row per row of ``pages`` (page_id, url, any others): page_id, host, path, rule, verdict, matched (the highest
    confidence of a mined rule, if one matches)."""
    matched = match(pages, *mine(pages, labels, support, confidence, least)).withColumnRenamed("url", "_url")
    own = pages.select("page_id", "url", urls.host("url").alias("host"), urls.path("url").alias("path"))
    rule = verdict = None
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest comes to stand first
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, f"{host}{path}") if rule is None else F.when(fits, f"{host}{path}").otherwise(rule)
        verdict = F.when(fits, kind) if verdict is None else F.when(fits, kind).otherwise(verdict)
    rule, verdict = (F.lit(None).cast("string") if x is None else x for x in (rule, verdict))
    out = own.join(matched, own.url == matched._url, "left")
    mined = F.when(F.col("matched").isNotNull(), "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "matched")
