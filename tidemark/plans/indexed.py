"""Queries answered from the inverted index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.textindex import TextIndex, built
from .base import query, table
from .delivery import shared_folder
from .retrieval import QUERY

DOC, CHUNK = {"doc_id": "long"}, {"doc_id": "long", "ordinal": "int"}


def _docs(spark, d) -> TextIndex:
    return built(spark, f"documents {d}", shared_folder(spark, "index"), table(spark, d, "documents").select("doc_id", "text"), DOC)


def _lines(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ordinal", "text"))


def _chunks(spark, d) -> TextIndex:
    return built(spark, f"chunks {d}", shared_folder(spark, "index"), _lines(spark, d), CHUNK)


def _bm25(units: str, keys: str, words: str) -> str:
    """Scores of ``units`` (keys, text) for the words as DuckDB computes them from the texts."""
    terms = ", ".join(f"'{w}'" for w in words.split())
    return f"""u AS ({units}), w AS (SELECT {keys}, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws FROM u),
m AS (SELECT *, len(ws) AS n FROM w), g AS (SELECT count(*) AS total, avg(n) AS mean FROM m),
p AS (SELECT {keys}, n, t.term, len(list_filter(ws, lambda x: x = t.term)) AS tf FROM m, (SELECT unnest([{terms}]) AS term) t),
df AS (SELECT term, count(*) FILTER (WHERE tf > 0) AS df FROM p GROUP BY 1),
bm AS (SELECT {keys}, sum(ln(1 + (total - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))) AS score FROM p JOIN df USING (term), g WHERE tf > 0 GROUP BY {keys})"""


DOCS_SQL = "SELECT doc_id, text FROM documents"
CHUNKS_SQL = "SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ordinal FROM documents WHERE text IS NOT NULL"
TERMS = "license rights stupid der"


@query("index_topk", f"WITH {_bm25(DOCS_SQL, 'doc_id', TERMS)} SELECT doc_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM bm QUALIFY rank <= 20")
def index_topk(spark, d):
    """Best documents from the index; blocks that can't reach the twentieth are not read."""
    out = _docs(spark, d).top(TERMS, 20)
    return out.select("doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("index_matches", f"WITH {_bm25(DOCS_SQL, 'doc_id', TERMS)} SELECT doc_id, round(score, 6) AS score FROM bm")
def index_matches(spark, d):
    """Every document with any term, with its score."""
    return _docs(spark, d).search(TERMS).select("doc_id", F.round("score", 6).alias("score"))


@query("index_chunks", f"WITH {_bm25(CHUNKS_SQL, 'doc_id, ordinal', TERMS)} SELECT doc_id, CAST(ordinal AS BIGINT) AS ordinal, round(score, 6) AS score, source FROM bm JOIN documents USING (doc_id) WHERE lang IN ('en', 'fr')")
def index_chunks(spark, d):
    """Chunks ranked by BM25 over the chunk index, scoped by attributes of their documents inside the search."""
    about = table(spark, d, "documents").where(F.col("lang").isin("en", "fr")).select("doc_id", "source")
    return _chunks(spark, d).search(TERMS).join(about, "doc_id").select("doc_id", F.col("ordinal").cast("long").alias("ordinal"), F.round("score", 6).alias("score"), "source")


@query("index_phrase", f"""WITH u AS ({CHUNKS_SQL}), w AS (SELECT doc_id, ordinal, ' ' || trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')) || ' ' AS t FROM u)
SELECT doc_id, CAST(ordinal AS BIGINT) AS ordinal, CAST((length(t) - length(replace(t, ' all  rights  reserved ', ''))) / 23 AS BIGINT) AS n FROM w WHERE contains(t, ' all  rights  reserved ')""")
def index_phrase(spark, d):
    """Chunks that hold three words in a row, by the positions in their postings."""
    return _chunks(spark, d).phrase("all rights reserved").select("doc_id", F.col("ordinal").cast("long").alias("ordinal"), "n")


@query("index_appended", f"WITH {_bm25(DOCS_SQL, 'doc_id', TERMS)} SELECT doc_id, round(score, 6) AS score FROM bm")
def index_appended(spark, d):
    """An index grown by a second delivery, half of which it holds already, scores as one written at once."""
    index = TextIndex(spark, shared_folder(spark, "index"), DOC)
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    index.append(docs.where(F.col("lang") == "en"))
    index.append(docs)
    return index.search(TERMS).select("doc_id", F.round("score", 6).alias("score"))
