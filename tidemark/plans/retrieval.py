"""Queries of text, retrieval and document intelligence."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors
from ..functions.spread import tasks
from ..operators import passages, search
from .base import query, table

WORDS = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))"
#: The words of every document, for SQL.
W_SQL = f"w AS (SELECT doc_id, lang, source, text, CASE WHEN {WORDS} = '' THEN []::VARCHAR[] ELSE string_split({WORDS}, ' ') END AS ws FROM documents)"
QUERY = "the license of that report"
#: Words of the queries here that are not searched for.
STOP = frozenset(("the", "of"))
TERMS = ("license", "report")
BM25_SQL = W_SQL + """, tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM w) WHERE term IN ('license', 'that', 'report') GROUP BY 1, 2), n AS (SELECT count(*) AS n, avg(len(ws)) AS al FROM w),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), bm AS (SELECT tf.doc_id AS id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / al))) AS score FROM tf JOIN w USING (doc_id) JOIN df USING (term), n GROUP BY 1)"""


def docs(spark, d):
    return table(spark, d, "documents")


@query("bm25_topk", f"WITH {BM25_SQL} SELECT id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM bm QUALIFY rank <= 20")
def bm25_topk(spark, d):
    out = search.top_k(search.bm25(docs(spark, d), "doc_id", "text", QUERY, STOP), "score", "id", 20)
    return out.select("id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("all_matches", f"WITH {BM25_SQL} SELECT id FROM bm")
def all_matches(spark, d):
    """Every matching document, without a limit."""
    return search.bm25(docs(spark, d), "doc_id", "text", QUERY, STOP).select("id")


COS = "sum(CAST(a AS DOUBLE) * CAST(b AS DOUBLE))"
SIM_SQL = """p AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), qs AS (SELECT * FROM p WHERE vec_id % 50 = 0),
sim AS (SELECT q.vec_id AS query, q.label AS ql, p.vec_id AS id, p.label AS pl, list_dot_product(q.e, p.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(p.e, p.e))) AS sim FROM qs q JOIN p ON q.vec_id <> p.vec_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, id) AS rank FROM sim)"""


def _nearest(spark, d, scope=None, k=10):
    e = table(spark, d, "embeddings")
    return search.nearest(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", k, scope)


@query("cosine_topk", f"WITH {SIM_SQL} SELECT query, id, round(sim, 8) AS sim, rank FROM rk WHERE rank <= 10")
def cosine_topk(spark, d):
    return _nearest(spark, d).select("query", "id", F.round("sim", 8).alias("sim"), F.col("rank").cast("long").alias("rank"))


@query("cosine_topk_scoped", f"WITH {SIM_SQL}, s AS (SELECT query, id, sim, row_number() OVER (PARTITION BY query ORDER BY sim DESC, id) AS rank FROM sim WHERE pl = 3) SELECT query, id, round(sim, 8) AS sim, rank FROM s WHERE rank <= 5")
def cosine_topk_scoped(spark, d):
    return _nearest(spark, d, F.col("label") == 3, 5).select("query", "id", F.round("sim", 8).alias("sim"), F.col("rank").cast("long").alias("rank"))


@query("retrieval_eval", f"""WITH {SIM_SQL}, f AS (SELECT query, min(rank) AS r FROM rk WHERE rank <= 10 AND ql = pl GROUP BY 1), a AS (SELECT vec_id, r FROM qs LEFT JOIN f ON vec_id = query)
SELECT count(*) AS queries, round(avg(CASE WHEN r <= 1 THEN 1.0 ELSE 0.0 END), 8) AS recall_at_1, round(avg(CASE WHEN r <= 5 THEN 1.0 ELSE 0.0 END), 8) AS recall_at_5, round(avg(coalesce(1.0 / r, 0)), 8) AS mrr FROM a""")
def retrieval_eval(spark, d):
    e = table(spark, d, "embeddings")
    labels = e.select(F.col("vec_id").alias("_id"), "label")
    ranked = _nearest(spark, d).join(labels.withColumnRenamed("label", "ql"), F.col("query") == F.col("_id")).drop("_id").join(labels, F.col("id") == F.col("_id"))
    out = search.retrieval_metrics(ranked, "query", "rank", F.col("ql") == F.col("label"), e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query")), (1, 5))
    return out.select("queries", *[F.round(c, 8).alias(c) for c in ("recall_at_1", "recall_at_5", "mrr")])


@query("judged_precision", f"""WITH {SIM_SQL}, j AS (SELECT query, avg(CASE WHEN ql = pl THEN 1.0 ELSE 0.0 END) AS p, bool_or(rank = 1 AND ql <> pl) AS misfire FROM rk WHERE rank <= 5 GROUP BY 1)
SELECT count(*) AS queries, round(avg(p), 8) AS precision_at_5, round(1 - avg(p), 8) AS noise, round(avg(CASE WHEN misfire THEN 1.0 ELSE 0.0 END), 8) AS false_fires FROM j""")
def judged_precision(spark, d):
    """Of the five nearest of each query, the share of its own label; false fires are queries whose first hit has another."""
    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("_id"), "label")
    ranked = _nearest(spark, d, k=5).join(labels.withColumnRenamed("label", "ql"), F.col("query") == F.col("_id")).drop("_id").join(labels, F.col("id") == F.col("_id"))
    own = F.col("ql") == F.col("label")
    j = ranked.groupBy("query").agg(F.avg(own.cast("double")).alias("p"), F.max((~own & (F.col("rank") == 1)).cast("double")).alias("misfire"))
    return j.agg(F.count("*").alias("queries"), F.round(F.avg("p"), 8).alias("precision_at_5"), F.round(1 - F.avg("p"), 8).alias("noise"), F.round(F.avg("misfire"), 8).alias("false_fires"))


@query("centroids", "SELECT label, i - 1 AS place, round(avg(CAST(embedding[i] AS DOUBLE)), 8) AS x FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2")
def centroids(spark, d):
    c = vectors.centroid(table(spark, d, "embeddings"), ["label"], "embedding")
    return c.select("label", F.posexplode("centroid").alias("place", "x")).select("label", F.col("place").cast("long").alias("place"), F.round("x", 8).alias("x"))


@query("rrf_fusion", f"""WITH {BM25_SQL}, {SIM_SQL}, a AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM bm QUALIFY rank <= 30), b AS (SELECT id, rank FROM rk WHERE query = 0 AND rank <= 30),
u AS (SELECT id, 1.0 / (60 + rank) AS s FROM a UNION ALL SELECT id, 0.5 / (60 + rank) FROM b) SELECT id, round(sum(s), 10) AS score FROM u GROUP BY id""")
def rrf_fusion(spark, d):
    words = search.top_k(search.bm25(docs(spark, d), "doc_id", "text", QUERY, STOP), "score", "id", 30)
    e = table(spark, d, "embeddings")
    near = search.nearest(e.where("vec_id = 0"), e, "vec_id", "embedding", 30)
    return search.reciprocal_rank_fusion([(words, 1.0), (near, 0.5)]).select("id", F.round("score", 10).alias("score"))


@query("near_duplicate_signature", f"WITH {W_SQL}, s AS (SELECT doc_id, array_to_string(ws[1:16], ' ') AS sig FROM w) SELECT min(doc_id) AS keep_id, count(*) AS copies FROM s GROUP BY sig HAVING count(*) > 1")
def near_duplicate_signature(spark, d):
    s = docs(spark, d).select("doc_id", tx.signature("text").alias("sig"))
    return s.groupBy("sig").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("copies")).where("copies > 1").drop("sig")


@query("signature_rerank", f"WITH {W_SQL}, s AS (SELECT doc_id, length(text) AS n, array_to_string(ws[1:16], ' ') AS sig FROM w) SELECT doc_id, n FROM s QUALIFY row_number() OVER (PARTITION BY sig ORDER BY n DESC, doc_id) = 1")
def signature_rerank(spark, d):
    s = docs(spark, d).select("doc_id", "text", F.length("text").cast("long").alias("n"))
    return search.dedupe_by_signature(s, "text", [F.desc("n"), F.col("doc_id")]).select("doc_id", "n")


@query("shingle_boilerplate", f"""WITH {W_SQL}, r AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 7], ' ') AS s FROM w, range(1, 60000) t(i) WHERE i <= len(ws) - 7),
c AS (SELECT s FROM r GROUP BY s HAVING count(*) >= 10) SELECT doc_id AS id, count(*) AS shingles, count(c.s) AS common, count(c.s) >= 0.5 * count(*) AS boilerplate FROM r LEFT JOIN c USING (s) GROUP BY doc_id""")
def shingle_boilerplate(spark, d):
    return search.boilerplate(docs(spark, d), "doc_id", "text")


@query("mention_trend", r"""WITH m AS (SELECT source AS company, CAST(doc_id % 12 AS BIGINT) AS period, len(regexp_extract_all(lower(text), '\b(?:license|the|der)\b')) AS n FROM documents),
p AS (SELECT company, period, count(*) AS documents, CAST(sum(n) AS BIGINT) AS mentions FROM m WHERE n > 0 GROUP BY 1, 2)
SELECT company, period, mentions, mentions - lag(mentions) OVER (PARTITION BY company ORDER BY period) AS change FROM p QUALIFY row_number() OVER (PARTITION BY company ORDER BY period DESC) = 1""")
def mention_trend(spark, d):
    t = docs(spark, d).select("text", F.col("source").alias("company"), (F.col("doc_id") % 12).alias("period"))
    points = search.mention_trend(t, "doc_id", "text", ("license", "the", "der"), "company", "period")
    return search.latest_change(points, "company", "period", "mentions")


@query("classifier_eval", """WITH j AS (SELECT quality AS g, CASE WHEN length(text) > 800 THEN 1 ELSE 0 END AS p FROM documents JOIN labels USING (doc_id)), c AS (SELECT unnest([0, 1]) AS c),
r AS (SELECT c, count(*) FILTER (WHERE g = c) AS support, count(*) FILTER (WHERE p = c) AS predicted, count(*) FILTER (WHERE g = c AND p = c) AS hits FROM j, c GROUP BY c)
SELECT CAST(c AS VARCHAR) AS class, support, predicted, hits, round(hits / nullif(predicted, 0), 8) AS precision, round(hits / nullif(support, 0), 8) AS recall,
 round(2 * (hits / nullif(predicted, 0)) * (hits / nullif(support, 0)) / nullif(hits / nullif(predicted, 0) + hits / nullif(support, 0), 0), 8) AS f1 FROM r""")
def classifier_eval(spark, d):
    j = docs(spark, d).join(table(spark, d, "labels"), "doc_id").select("quality", (F.length("text") > 800).cast("int").alias("guess"))
    out = search.classifier_report(j, "quality", "guess", (0, 1))
    return out.select("class", "support", "predicted", "hits", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")])


@query("classifier_slices", """WITH j AS (SELECT lang, source, quality = CASE WHEN length(text) > 800 THEN 1 ELSE 0 END AS ok FROM documents JOIN labels USING (doc_id))
SELECT lang, source, count(*) AS n, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 8) AS accuracy FROM j GROUP BY GROUPING SETS ((lang), (source), ())""")
def classifier_slices(spark, d):
    j = docs(spark, d).join(table(spark, d, "labels"), "doc_id").select("lang", "source", (F.col("quality") == (F.length("text") > 800).cast("int")).cast("double").alias("ok"))
    return j.groupingSets([[F.col("lang")], [F.col("source")], []], F.col("lang"), F.col("source")).agg(F.count("*").alias("n"), F.round(F.avg("ok"), 8).alias("accuracy"))


LANG = {"en": ("the", "and", "of", "that"), "de": ("der", "die", "und", "den"), "fr": ("le", "les", "et", "des"), "es": ("el", "los", "y", "las")}
_LANG_SQL = ", ".join("struct_pack(n := len(list_filter(ws, lambda x: x IN (%s))), i := -%d, lang := '%s')" % (", ".join(f"'{w}'" for w in v), i, k) for i, (k, v) in enumerate(LANG.items()))


@query("language_detect", f"WITH {W_SQL}, l AS (SELECT doc_id, list_max([{_LANG_SQL}]) AS best FROM w) SELECT doc_id, best.lang AS lang FROM l")
def language_detect(spark, d):
    return docs(spark, d).select("doc_id", tx.language("text", LANG).alias("lang"))


RULES = {"license": ("licen[sc]e", "copyright"), "contact": ("@", "http"), "numbers": (r"\d{6}",)}


@query("doc_type", r"SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'licen[sc]e|copyright') THEN 'license' WHEN regexp_matches(lower(text), '@|http') THEN 'contact' WHEN regexp_matches(lower(text), '\d{6}') THEN 'numbers' ELSE 'prose' END AS kind FROM documents")
def doc_type(spark, d):
    return docs(spark, d).select("doc_id", tx.first_rule("text", RULES, "prose").alias("kind"))


@query("topical_fit", f"WITH {W_SQL} SELECT doc_id, round((CAST(len(list_filter(ws, lambda x: starts_with(x, 'licen'))) > 0 AS INTEGER) + CAST(len(list_filter(ws, lambda x: starts_with(x, 'repor'))) > 0 AS INTEGER)) / 2.0, 6) AS fit FROM w")
def topical_fit(spark, d):
    return docs(spark, d).select("doc_id", F.round(tx.topical_fit("text", TERMS), 6).alias("fit"))


@query("match_counts", r"SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '\b(?:license|the)\b')) AS INTEGER) AS n FROM documents")
def match_counts(spark, d):
    return docs(spark, d).select("doc_id", tx.count_matches("text", ("license", "the")).alias("n"))


@query("slugify_titles", f"SELECT doc_id, md5(regexp_replace(regexp_replace(lower(translate(text, '{tx.MARKED}', '{tx.PLAIN}')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug_md5 FROM documents")
def slugify_titles(spark, d):
    return docs(spark, d).select("doc_id", F.md5(tx.slugify("text")).alias("slug_md5"))


@query("parse_numbers", """WITH v AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN '(' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ')' WHEN 1 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ',5' WHEN 2 THEN '1.234,' || CAST(CAST(l_quantity AS INTEGER) % 10 AS VARCHAR) ELSE '1,' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 3, '0') || '.5 %' END AS s, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS q FROM lineitem)
SELECT s, count(*) AS n, any_value(CASE l_linenumber % 4 WHEN 0 THEN -q WHEN 1 THEN q + 0.5 WHEN 2 THEN 1234 + (q % 10) / 10 ELSE 1000 + q + 0.5 END) AS v FROM v GROUP BY s""")
def parse_numbers(spark, d):
    q = F.col("l_quantity").cast("int")
    k = F.col("l_linenumber") % 4
    s = F.when(k == 0, F.concat(F.lit("("), q.cast("string"), F.lit(")"))).when(k == 1, F.concat(q.cast("string"), F.lit(",5"))).when(k == 2, F.concat(F.lit("1.234,"), (q % 10).cast("string"))).otherwise(F.concat(F.lit("1,"), F.lpad(q.cast("string"), 3, "0"), F.lit(".5 %")))
    return table(spark, d, "lineitem").select(s.alias("s")).groupBy("s").agg(F.count("*").alias("n")).withColumn("v", tx.parse_number("s"))


@query("html_text", r"""SELECT page_id, CAST(length(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)\b.*?</(?:script|style)>', ' ', 'g'), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[\x20\x09-\x0D]+', ' ', 'g'))) AS INTEGER) AS n FROM pages""")
def html_text(spark, d):
    return table(spark, d, "pages").select("page_id", F.length(tx.strip_html("html")).alias("n"))


@query("page_links", r"""SELECT page_id, len(regexp_extract_all(html, '<a\s+href="([^"]*)"', 1)) AS links, regexp_matches(url, '(?i)\.pdf|report|quarter') AS looks_like_report, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages""")
def page_links(spark, d):
    links = F.size(F.regexp_extract_all("html", F.lit(r'<a\s+href="([^"]*)"'), F.lit(1))).cast("long")
    return table(spark, d, "pages").select("page_id", links.alias("links"), F.col("url").rlike(r"(?i)\.pdf|report|quarter").alias("looks_like_report"), F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))


@query("newest_capture", r"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS key FROM pages) SELECT key, max(page_id) AS page_id, count(*) AS captures FROM c GROUP BY key""")
def newest_capture(spark, d):
    key = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"/+$", "")
    return table(spark, d, "pages").groupBy(key.alias("key")).agg(F.max("page_id").alias("page_id"), F.count("*").alias("captures"))


@query("citations", r"""SELECT conv_id, turn, len(regexp_extract_all(text, '\[(\d+)\]', 1)) AS citations, len(string_split(trim(text), ' ')) AS words FROM conversations WHERE text IS NOT NULL""")
def citations(spark, d):
    t = table(spark, d, "conversations").where("text is not null")
    return t.select("conv_id", "turn", F.size(F.regexp_extract_all("text", F.lit(r"\[(\d+)\]"), F.lit(1))).cast("long").alias("citations"), F.size(F.split(F.trim("text"), " ")).cast("long").alias("words"))


@query("text_metrics", r"""WITH m AS (SELECT doc_id, source, regexp_extract(text, '(\d{6,})', 1) AS v FROM documents) SELECT source, count(*) AS n, count(*) FILTER (WHERE v <> '') AS found, max(v) AS top FROM m GROUP BY source""")
def text_metrics(spark, d):
    """First match of a pattern wins, per document; then counts per source."""
    m = docs(spark, d).select("source", F.regexp_extract("text", r"(\d{6,})", 1).alias("v"))
    return m.groupBy("source").agg(F.count("*").alias("n"), F.count(F.when(F.col("v") != "", 1)).alias("found"), F.max("v").alias("top"))


@query("document_chunks")
def document_chunks(spark, d):
    """Heading-aware overlapping chunks of every document."""
    out = docs(spark, d).select("doc_id", F.explode(passages.chunk_column(F.col("text"))).alias("c"))
    return out.select("doc_id", "c.*")


TONE = passages.Lexicon(positive=frozenset(("the", "la", "der")), negative=frozenset(("of", "les", "die", "stupid", "worthless")), negations=frozenset(("it", "en")), burdens=frozenset(("license", "rights")))


@query("document_tone")
def document_tone(spark, d):
    """Tone of each document and its tallies, by a lexicon of words that the texts here hold."""
    return docs(spark, d).select("doc_id", passages.tone_column(F.col("text"), TONE).alias("t")).select("doc_id", "t.*")


@query("document_sentences", r"SELECT doc_id, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[^.!?\n]+'), lambda s: regexp_matches(s, '[\p{L}\p{N}]'))) AS INTEGER) AS sentences FROM documents")
def document_sentences(spark, d):
    return docs(spark, d).select("doc_id", F.size(passages.sentence_column(F.col("text"))).alias("sentences"))


@query("turn_redline")
def turn_redline(spark, d):
    """Sentence differences of each turn with the one before it of the same role."""
    w = Window.partitionBy("conv_id", "role").orderBy("turn")
    # a number of its own, else small partitions become one, and differences take long for their bytes
    dealt = table(spark, d, "conversations").repartition(tasks(spark), "conv_id", "role")
    t = dealt.withColumn("before", F.lag("text").over(w)).where("before is not null")
    return t.select("conv_id", "turn", passages.redline_column(F.col("before"), F.col("text")).alias("r")).select("conv_id", "turn", "r.*")


SCRUB_SQL = "text"
for _form, _mark in (("src0", "SOURCE"), ("src1", "SOURCE"), ("Apache License", "LICENSE"), ("MIT License", "LICENSE")):
    SCRUB_SQL = rf"regexp_replace({SCRUB_SQL}, '\b{_form}\b', '{_mark}', 'gi')"
for _form, _mark in ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "MAIL"), (r"\b(?:19|20)\d{2}\b", "YEAR"), (r"\d{6,}", "NUMBER")):
    SCRUB_SQL = f"regexp_replace({SCRUB_SQL}, '{_form}', '{_mark}', 'g')"


@query("scrubbed_text", f"SELECT doc_id, sha256({SCRUB_SQL}) AS scrubbed FROM documents")
def scrubbed_text(spark, d):
    s = passages.scrub(F.col("text"), {"SOURCE": ["src0", "src1"], "LICENSE": ["MIT License", "Apache License"]})
    return docs(spark, d).select("doc_id", F.sha2(s, 256).alias("scrubbed"))


@query("hashing_embeddings")
def hashing_embeddings(spark, d):
    return docs(spark, d).select("doc_id", vectors.hashing_embedder(64)("text").alias("embedding"))


@query("mmr_sentences")
def mmr_sentences(spark, d):
    """Three varied vectors of each label by maximal marginal relevance."""
    e = table(spark, d, "embeddings").select("label", "vec_id", F.element_at("embedding", 1).cast("double").alias("score"), "embedding")
    return search.greedy_mmr(e, "label", "vec_id", "score", "embedding", 3)


@query("flood_caps")
def flood_caps(spark, d):
    hits = search.top_k(search.bm25(docs(spark, d), "doc_id", "text", QUERY, STOP), "score", "id", 100).join(docs(spark, d).select(F.col("doc_id").alias("id"), "source", "lang"), "id")
    return search.cap_floods(hits.select("id", "rank", "source", "lang"), "rank", "lang", "source", 20, 3)


@query("fuzzy_labels")
def fuzzy_labels(spark, d):
    """Row labels with typing slips matched to known ones; some words rule a label out."""
    p = table(spark, d, "part").select(F.lower(F.regexp_replace(F.concat_ws(" ", "p_type", "p_name"), "e", "ee")).alias("label")).distinct()
    b = passages.best_label(F.col("label"), FUZZY_KNOWN, 0.85, FUZZY_AGAINST)
    return p.select("label", b.alias("b")).select(F.col("label").alias("p_type"), "b.label", F.round("b.score", 6).alias("score"))


FUZZY_KNOWN = ("economy small ring", "economy red widget", "standard red widget", "promo blue gear")
FUZZY_AGAINST = {"economy red widget": ("blue",), "promo blue gear": ("promo",)}
