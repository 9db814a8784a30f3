"""Queries of banded search, passages, tone and topics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import bands
from .base import query, table

PHRASE = "the license"
STOP = frozenset(("the",))
CONCEPTS = {"license": ("licensed", "license", "mit", "apache"), "rights": ("rights", "copyright"), "harsh": ("stupid", "worthless", "idiot")}
GOOD, BAD = ("license", "the", "free"), ("copyright", "all", "rights")


def _any(*words: str) -> str:
    """DuckDB pattern of whole words; captures what stands before, as its engine has no look-behind."""
    return r"(?:^|[^\p{L}\p{N}])(?:" + "|".join(words) + r")(?:$|[^\p{L}\p{N}])"


#: Words of the lower-cased text as DuckDB splits them, for counts of single words.
WORDS_SQL = r"string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+')"


def _n(words) -> str:
    return f"len(list_filter({WORDS_SQL}, lambda x: x IN ({', '.join(repr(w) for w in words)})))"


@query("semantic_questions", r"""WITH w AS (SELECT conv_id, turn, lower(text) AS low, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '' AND x NOT IN ('the', 'of', 'and', 'der', 'die', 'le', 'la', 'de')) AS ws FROM conversations WHERE role = 'user' AND text IS NOT NULL)
SELECT conv_id, turn, md5(concat_ws(' ', CASE WHEN len(ws) > 0 THEN array_to_string(ws, ' ') END, CASE WHEN regexp_matches(low, '(?:^|[^\p{L}\p{N}])que(?:$|[^\p{L}\p{N}])') THEN 'question query' END, CASE WHEN regexp_matches(low, '(?:^|[^\p{L}\p{N}])und(?:$|[^\p{L}\p{N}])') THEN 'both also' END)) AS about FROM w""")
def semantic_questions(spark, d):
    """What each user's turn is about, with hint words."""
    t = table(spark, d, "conversations").where("role = 'user' and text is not null")
    about = bands.semantic_text(F.col("text"), {"que": ("question", "query"), "und": ("both", "also")}, ("the", "of", "and", "der", "die", "le", "la", "de"))
    return t.select("conv_id", "turn", F.md5(about).alias("about"))


@query("expanded_search", f"""WITH s AS (SELECT doc_id AS id, {_n(['license'])} + 0.5 * {_n(['licensed', 'mit'])} + CASE WHEN regexp_matches(lower(text), '{_any('rights', 'reserved')}') THEN 0.25 * {_n(['copyright'])} ELSE 0 END AS score FROM documents)
SELECT id, CAST(score AS DOUBLE) AS score FROM s WHERE score > 0""")
def expanded_search(spark, d):
    """A query with weighted synonyms, one of them behind a gate."""
    e = bands.expansions("the license", {"license": (("licensed", "mit"), 0.5, ())}, STOP) + [("copyright", 0.25, ("rights", "reserved"))]
    docs = table(spark, d, "documents")
    return docs.select(F.col("doc_id").alias("id"), bands.expanded_score("text", e).cast("double").alias("score")).where("score > 0")


BAND_SQL = f"""b AS (SELECT doc_id AS id, lower(text) AS low, {_n(['license', 'licensed', 'mit', 'apache', 'rights', 'copyright', 'stupid', 'worthless', 'idiot'])} AS hits FROM documents),
f AS (SELECT id, CASE WHEN regexp_matches(low, '(?:^|[^\\p{{L}}\\p{{N}}])the\\s+license(?:$|[^\\p{{L}}\\p{{N}}])') THEN 'literal' WHEN regexp_matches(low, '{_any("license")}') THEN 'strong' ELSE 'weak' END AS band,
 concat_ws(',', CASE WHEN regexp_matches(low, '{_any("licensed", "license", "mit", "apache")}') THEN 'license' END, CASE WHEN regexp_matches(low, '{_any("rights", "copyright")}') THEN 'rights' END, CASE WHEN regexp_matches(low, '{_any("stupid", "worthless", "idiot")}') THEN 'harsh' END) AS concepts, hits FROM b WHERE hits > 0)"""


@query("banded_search", f"WITH {BAND_SQL} SELECT id, band, concepts, hits FROM f")
def banded_search(spark, d):
    return bands.banded(table(spark, d, "documents"), "doc_id", "text", PHRASE, CONCEPTS, STOP)


@query("best_bands", f"""WITH {BAND_SQL}, g AS (SELECT doc_id AS id, 'literal' AS band, 'harsh' AS concepts, {_n(['stupid'])} AS hits FROM documents), u AS (SELECT * FROM f UNION ALL SELECT * FROM g WHERE hits > 0)
SELECT id, CASE min(CASE band WHEN 'literal' THEN 0 WHEN 'strong' THEN 1 ELSE 2 END) WHEN 0 THEN 'literal' WHEN 1 THEN 'strong' ELSE 'weak' END AS band, array_to_string(list_sort(list_distinct(flatten(list(string_split(concepts, ','))))), ',') AS concepts, max(hits) AS hits FROM u GROUP BY id""")
def best_bands(spark, d):
    """Two searches in one list: every document in its best band."""
    docs = table(spark, d, "documents")
    a = bands.banded(docs, "doc_id", "text", PHRASE, CONCEPTS, STOP)
    b = bands.banded(docs, "doc_id", "text", "stupid", {"harsh": ("stupid",)}, STOP)
    return bands.best_band(a.unionByName(b))


OCC_SQL = """p AS (SELECT doc_id AS id, length(text) AS size, unnest(string_split(lower(text), 'license')) AS part, generate_subscripts(string_split(lower(text), 'license'), 1) AS i FROM documents WHERE text IS NOT NULL),
o AS (SELECT id, size, CAST(sum(length(part)) OVER (PARTITION BY id ORDER BY i) AS BIGINT) + (i - 1) * 7 AS place, i = max(i) OVER (PARTITION BY id) AS last FROM p), oc AS (SELECT id, place, size FROM o WHERE NOT last)"""


@query("match_passages", f"""WITH {OCC_SQL}, l AS (SELECT id, greatest(0, place - 120) AS lo, least(size, place + 7 + 120) AS hi FROM oc), e AS (SELECT *, max(hi) OVER (PARTITION BY id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM l),
g AS (SELECT *, sum(CASE WHEN lo <= prev THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM e) SELECT id, min(lo) AS start, max(hi) AS "end", count(*) AS matches FROM g GROUP BY id, island""")
def match_passages(spark, d):
    """Passages around every occurrence of a word, merged where they overlap."""
    docs = table(spark, d, "documents").where("text is not null")
    return bands.passages_around(bands.occurrences(docs, "doc_id", "text", "license"), 7)


def _word_count(col: str, words) -> str:
    return f"len(list_filter(string_split_regex(lower({col}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x IN ({', '.join(repr(w) for w in words)})))"


TONE_SQL = OCC_SQL + f""", t AS (SELECT oc.id, place, source, lang, substr(text, greatest(0, place - 100) + 1, 207) AS passage FROM oc JOIN documents ON doc_id = oc.id), n AS (SELECT *, {_word_count("passage", GOOD)} AS g, {_word_count("passage", BAD)} AS b FROM t), tn AS (SELECT *, coalesce((g - b) / nullif(g + b, 0), 0.0) AS tone FROM n)"""


def _tones(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    found = bands.occurrences(docs, "doc_id", "text", "license").join(docs.select(F.col("doc_id").alias("id"), "text", "source", "lang"), "id")
    passage = F.substring(F.col("text"), F.greatest(F.lit(0), F.col("at") - 100).cast("int") + 1, F.lit(207))
    good, bad, tone = bands.tone_of(passage, GOOD, BAD)
    return found.select("id", "at", "source", "lang", tone.alias("tone"), good.alias("g"), bad.alias("b"))


@query("mention_tone", f"WITH {TONE_SQL} SELECT id, place, CAST(round(tone, 8) AS DOUBLE) AS tone FROM tn")
def mention_tone(spark, d):
    """Tone of the passage around each mention, never of the whole text."""
    return _tones(spark, d).select("id", F.col("at").cast("long").alias("place"), F.round("tone", 8).alias("tone"))


@query("tone_trend", f"WITH {TONE_SQL} SELECT source AS company, lang AS period, count(*) AS mentions, round(avg(tone), 8) AS tone, count(*) FILTER (WHERE tone > 0) AS positive, count(*) FILTER (WHERE tone = 0) AS neutral, count(*) FILTER (WHERE tone < 0) AS negative FROM tn GROUP BY 1, 2")
def tone_trend(spark, d):
    n = lambda c: F.count_if(c)
    return _tones(spark, d).groupBy(F.col("source").alias("company"), F.col("lang").alias("period")).agg(F.count("*").alias("mentions"), F.round(F.avg("tone"), 8).alias("tone"), n(F.col("tone") > 0).alias("positive"), n(F.col("tone") == 0).alias("neutral"), n(F.col("tone") < 0).alias("negative"))


@query("result_rollup", f"""WITH {BAND_SQL}, j AS (SELECT source AS company, id, band, hits FROM f JOIN documents ON doc_id = id)
SELECT company, count(*) AS documents, CAST(sum(hits) AS BIGINT) AS hits, arg_max(id, struct_pack(h := hits, i := -id)) AS best_id FROM j GROUP BY 1""")
def result_rollup(spark, d):
    """Results per company with its best hit, ties by the smaller id."""
    found = bands.banded(table(spark, d, "documents"), "doc_id", "text", PHRASE, CONCEPTS, STOP)
    j = found.join(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("company")), "id")
    return j.groupBy("company").agg(F.count("*").alias("documents"), F.sum("hits").alias("hits"), F.max_by("id", F.struct("hits", -F.col("id"))).alias("best_id"))


@query("chunk_search", """WITH c AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS chunk, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ordinal FROM documents WHERE text IS NOT NULL), s AS (SELECT *, %s AS n, length(chunk) AS size FROM c)
SELECT doc_id, ordinal, n, lang FROM s WHERE n > 0 AND lang IN ('en', 'fr') ORDER BY n / sqrt(size) DESC, doc_id, ordinal LIMIT 50""" % _word_count("chunk", ["license", "the"]))
def chunk_search(spark, d):
    """Matches at the level of chunks, joined to their documents' attributes and filtered by them before the top k."""
    docs = table(spark, d, "documents").where("text is not null")
    chunks = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ordinal", "chunk"))
    hits = chunks.withColumn("n", F.regexp_count(F.lower("chunk"), F.lit(bands.any_word(["license", "the"]))).cast("long")).where("n > 0")
    j = hits.join(docs.where(F.col("lang").isin("en", "fr")).select("doc_id", "lang"), "doc_id")
    best = j.orderBy(F.desc(F.col("n") / F.sqrt(F.length("chunk"))), "doc_id", "ordinal").limit(50)
    return best.select("doc_id", F.col("ordinal").cast("long").alias("ordinal"), "n", "lang")


@query("document_topics", f"""WITH t AS (SELECT doc_id AS id, 'license' AS topic, {_n(CONCEPTS['license'])} AS n FROM documents UNION ALL SELECT doc_id, 'rights', {_n(CONCEPTS['rights'])} FROM documents UNION ALL SELECT doc_id, 'harsh', {_n(CONCEPTS['harsh'])} FROM documents)
SELECT id, topic, n, row_number() OVER (PARTITION BY id ORDER BY n DESC, topic) AS rank FROM t WHERE n >= 1 QUALIFY rank <= 2""")
def document_topics(spark, d):
    return bands.topics(table(spark, d, "documents"), "doc_id", "text", CONCEPTS, 2, 1)


@query("sentence_tones", f"""WITH s AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?]+')) AS s FROM documents WHERE text IS NOT NULL), n AS (SELECT doc_id, {_word_count("s", GOOD)} AS g, {_word_count("s", BAD)} AS b FROM s WHERE regexp_matches(s, '[\\p{{L}}\\p{{N}}]'))
SELECT doc_id, count(*) AS sentences, count(*) FILTER (WHERE g > b) AS positive, count(*) FILTER (WHERE g = b) AS neutral, count(*) FILTER (WHERE g < b) AS negative FROM n GROUP BY 1""")
def sentence_tones(spark, d):
    """Sentences of each document by tone."""
    s = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.split("text", r"[.!?]+", -1)).alias("s")).where(F.col("s").rlike(r"[\p{L}\p{N}]"))
    good, bad, _ = bands.tone_of(F.col("s"), GOOD, BAD)
    return s.select("doc_id", (good - bad).alias("t")).groupBy("doc_id").agg(F.count("*").alias("sentences"), F.count_if(F.col("t") > 0).alias("positive"), F.count_if(F.col("t") == 0).alias("neutral"), F.count_if(F.col("t") < 0).alias("negative"))


@query("document_sections", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, sum(CASE WHEN length(trim(line)) BETWEEN 3 AND 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM l)
SELECT doc_id, CAST(section AS BIGINT) AS section, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM h GROUP BY 1, 2""")
def document_sections(spark, d):
    """Sections of each document: a short line heads the lines up to the next one; what stands before the first is section 0."""
    lines = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    head = F.length(F.trim("line")).between(3, 40).cast("long")
    w = Window.partitionBy("doc_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.sum(head).over(w)).groupBy("doc_id", "section").agg(F.count("*").alias("lines"), F.sum(F.length("line")).cast("long").alias("chars"))
