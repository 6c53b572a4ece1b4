"""The operators' registered queries, with production parameters over their whole tables, and SQL for those that it
can express. Each query only derives its columns from what its operator returns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.llm import chat_format as C
from bookflow.llm import collocations as O
from bookflow.llm import decontaminate as D
from bookflow.llm import embedding_dedup as E
from bookflow.llm import html_extract as H
from bookflow.llm import language_id as L
from bookflow.llm import packing as K
from bookflow.llm import periodic_runs as R
from bookflow.llm import sharding as P
from bookflow.llm import simhash_dedup as S
from bookflow.llm import suffix_dedup as X
from bookflow.llm import toxicity as T
from bookflow.llm import url_filter as U

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The conversation that op5 formats besides the table's: both turns hold the template's control strings.
EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_embedding_dedup(spark, d):
    return E.near_duplicates(_table(spark, d, "embeddings"))


def op2_decontaminate(spark, d):
    found = D.search(_table(spark, d, "documents").select("doc_id", "text"), _table(spark, d, "benchmark"))
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_html_extract(spark, d):
    return H.extract(_table(spark, d, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_packing(spark, d):
    return K.pack_documents(_table(spark, d, "documents"), TOKENIZER, with_ids=False)


def op5_chat_format(spark, d):
    kind = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame(EXTRA, kind)
    return C.read_back(C.format_turns(_table(spark, d, "conversations").select("conv_id", "turn", "role", "text").union(extra)))


def op6_url_filter(spark, d):
    return U.judge(_table(spark, d, "pages").select("page_id", "url"), _table(spark, d, "labels"))


def op7_simhash_dedup(spark, d):
    found = S.near_duplicates(_table(spark, d, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_language_id(spark, d):
    docs = _table(spark, d, "documents")
    found = L.predict(docs.select("doc_id", "text"), L.train(docs))
    return found.select("doc_id", F.coalesce(L.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark, d):
    docs = _table(spark, d, "documents")
    found = T.score(docs.select("doc_id", "text"), T.train(docs, _table(spark, d, "labels")))
    return found.select("doc_id", F.coalesce(L.held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op10_suffix_dedup(spark, d):
    found = X.remove_repeats(_table(spark, d, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_sharding(spark, d):
    return P.assign(_table(spark, d, "documents").select("doc_id", "text"), 8, columns=["doc_id"])


def op12_collocations(spark, d):
    return O.collocations(_table(spark, d, "documents"))


def _folded(docs):
    """(doc_id, text) with the last part of every tenth text (by the id's hash) replaced by repeats of its beginning."""
    h = F.crc32(F.col("doc_id").cast("string"))
    own = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).alias("w"))
    at = own.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)"))).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)")
    return at.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.expr("slice(w, 1, a)"), again), " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, d):
    found = R.collapse_runs(_folded(_table(spark, d, "documents")), digest=True)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("x", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("x.start")).alias("start"), F.col("x.length").alias("length"), (-F.col("x.period")).alias("period"),
        F.expr("1000 * x.length div -x.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_decontaminate, op3_html_extract, op4_packing, op5_chat_format,
                                   op6_url_filter, op7_simhash_dedup, op8_language_id, op9_toxicity, op10_suffix_dedup,
                                   op11_sharding, op12_collocations, op13_periodic_runs)}

#: CRC 32 of the UTF-8 bytes of ``{}``, as a table of 256 entries and a fold over the bytes.
_CRC_TABLE = """(SELECT list(c ORDER BY i) FROM (SELECT i, list_reduce([i::BIGINT] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) c FROM range(256) r(i)))"""
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode({0}))),
    lambda i: ('0x' || substr(hex(encode({0})), (2 * i + 1)::INT, 2))::BIGINT), lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])), 4294967295)"""

_FOLDED = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES = {
    "op1_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] e FROM embeddings),
        u AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0),
        link AS (SELECT a.vec_id a, b.vec_id b FROM u a, u b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                 AND list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (SELECT vec_id a, vec_id b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
        SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links,
               r.component_id, v.vec_id = r.component_id AS kept
        FROM v JOIN (SELECT a, min(b) component_id FROM reach GROUP BY a) r ON r.a = v.vec_id""",
    "op2_decontaminate": f"""
        WITH d AS (SELECT doc_id, coalesce({_FOLDED}, []) w FROM documents),
        i AS (SELECT item_id, coalesce({_FOLDED}, []) w FROM benchmark),
        p AS (SELECT DISTINCT item_id, least(10, len(w)) n, w[s:s + least(10, len(w)) - 1] g
              FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) s FROM i WHERE len(w) > 0)),
        n AS (SELECT DISTINCT n FROM p),
        g AS (SELECT doc_id, n, s, w[s:s + n - 1] g FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) s FROM d, n WHERE len(w) >= n)),
        o AS (SELECT g.doc_id, g.s, g.n, p.item_id FROM g JOIN p ON g.n = p.n AND g.g = p.g),
        h AS (SELECT doc_id, count(DISTINCT k) n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) k FROM (SELECT DISTINCT doc_id, s, n FROM o)) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) ids
              FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
               sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id""",
    "op5_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
               coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
               sum(length('### ' || r || ': ' || regexp_replace(t, '(\\*)(###|</turn>)', '\\\0', 'g') || ' </turn>' || chr(10)))::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op11_sharding": f"""
        WITH t AS (SELECT {_CRC_TABLE} AS crc),
        d AS (SELECT doc_id, coalesce(text, '') s, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
        u AS (SELECT doc_id, {_CRC.format("s")} AS c, size, md5(s) m FROM d, t),
        o AS (SELECT *, (sum(size) OVER w - size)::HUGEINT AS before, (row_number() OVER w) - 1 AS i, (sum(size) OVER ())::HUGEINT AS total,
              (sum(size) OVER (PARTITION BY m))::HUGEINT AS whole FROM u WINDOW w AS (ORDER BY m, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
        p AS (SELECT *, CASE WHEN whole * 512 > total THEN 2 * before + size ELSE 2 * min(before) OVER (PARTITION BY m) + whole END AS mid FROM o),
        s AS (SELECT *, least(7, mid * 8 // (2 * total))::INT AS shard FROM p)
        SELECT doc_id, size::BIGINT AS size, c::BIGINT AS text_crc32, 'bytes' AS law, shard, (i - min(i) OVER (PARTITION BY shard))::BIGINT AS slot,
               NULL::INT AS grown_shard FROM s""",
    "op12_collocations": """
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
        w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM d),
        f1 AS (SELECT lang, p, count(*) AS f FROM (SELECT lang, unnest(w) AS p FROM w) GROUP BY lang, p),
        g2 AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: {'a': w[i], 'b': w[i + 1]})) AS g FROM w),
        f2 AS (SELECT lang, g.a AS a, g.b AS b, count(*) AS f FROM g2 GROUP BY ALL HAVING count(*) >= 10),
        g3 AS (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: {'a': w[i], 'b': w[i + 1], 'c': w[i + 2]})) AS g FROM w),
        f3 AS (SELECT lang, g.a AS a, g.b AS b, g.c AS c, count(*) AS f FROM g3 GROUP BY ALL HAVING count(*) >= 10),
        longer AS (SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY ALL),
        two AS (SELECT x.lang, x.a || ' ' || x.b AS phrase, x.f AS a, l.f AS l, r.f AS r, x.f::HUGEINT * x.f * 1000000 // (l.f::HUGEINT * r.f) AS score
                FROM f2 x JOIN f1 l ON l.lang = x.lang AND l.p = x.a JOIN f1 r ON r.lang = x.lang AND r.p = x.b
                LEFT JOIN longer o ON o.lang = x.lang AND o.a = x.a AND o.b = x.b WHERE o.f IS NULL OR 100 * o.f < 50 * x.f),
        cuts AS (SELECT x.lang, x.a || ' ' || x.b || ' ' || x.c AS phrase, x.f AS a, l1.f AS l1, r1.f AS r1, l2.f AS l2, r2.f AS r2,
                 x.f::HUGEINT * x.f * 1000000 // (l1.f::HUGEINT * r1.f) AS s1, x.f::HUGEINT * x.f * 1000000 // (l2.f::HUGEINT * r2.f) AS s2
                 FROM f3 x JOIN f1 l1 ON l1.lang = x.lang AND l1.p = x.a JOIN f2 r1 ON r1.lang = x.lang AND r1.a = x.b AND r1.b = x.c
                 JOIN f2 l2 ON l2.lang = x.lang AND l2.a = x.a AND l2.b = x.b JOIN f1 r2 ON r2.lang = x.lang AND r2.p = x.c),
        every AS (SELECT * FROM two UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM every),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang)
        SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000""",
    "op13_periodic_runs": f"""
        WITH t AS (SELECT {_CRC_TABLE} AS crc),
        d AS (SELECT doc_id, {_CRC.format("(doc_id::VARCHAR)")} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents, t),
        e AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
        x AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
              w[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1)::INT]) ELSE w END AS w FROM e),
        v AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM x),
        m AS (SELECT a.doc_id, b.i - a.i AS q, b.i AS i FROM v a JOIN v b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND (b.i - a.i) * 4 <= a.n),
        k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM m),
        r AS (SELECT doc_id, q, min(i) - q AS s, max(i) + 1 AS e FROM k GROUP BY doc_id, q, k HAVING max(i) + 1 - min(i) + q >= greatest(6, 4 * q)),
        runs AS (SELECT doc_id, s, e - s AS len, min(q) AS q FROM r GROUP BY doc_id, s, e),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
        kept AS (SELECT v.doc_id, string_agg(word, ' ' ORDER BY v.i) AS kept FROM v LEFT JOIN gone ON gone.doc_id = v.doc_id AND gone.i = v.i WHERE gone.i IS NULL GROUP BY v.doc_id),
        best AS (SELECT doc_id, s, len, q FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len DESC, s, q) = 1),
        said AS (SELECT doc_id, count(*) AS n, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id)
        SELECT x.doc_id, coalesce(said.n, 0) AS n_runs, best.s AS start, best.len AS length, best.q AS period, 1000 * best.len // best.q AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
        FROM x LEFT JOIN said ON said.doc_id = x.doc_id LEFT JOIN best ON best.doc_id = x.doc_id LEFT JOIN kept ON kept.doc_id = x.doc_id""",
    "op10_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) h FROM documents),
        w AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 400)) m FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) s FROM d)),
        r AS (SELECT doc_id, s FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
        b AS (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 1 ELSE 0 END new FROM r),
        k AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) k FROM b),
        x AS (SELECT doc_id, min(s) a, max(s) + 200 e FROM k GROUP BY doc_id, k),
        y AS (SELECT x.doc_id, a, e, substr(h, 2 * lag(e, 1, 0) OVER (PARTITION BY x.doc_id ORDER BY a) + 1,
                     2 * (a - lag(e, 1, 0) OVER (PARTITION BY x.doc_id ORDER BY a))) before FROM x JOIN d ON d.doc_id = x.doc_id),
        z AS (SELECT doc_id, sum(e - a) gone, count(*) n, max(e) last, string_agg(before, '' ORDER BY a) kept FROM y GROUP BY doc_id)
        SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN z ON z.doc_id = d.doc_id""",
}
