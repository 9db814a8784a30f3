"""Text functions as column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

#: Letters with marks and their plain forms.
MARKED = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"

#: A word of the normalised text, for patterns over lower-cased text.
WORD = r"[\p{L}\p{N}]+"


def one_word(word: str) -> str:
    """Pattern of a word that stands alone in lower-cased text; the word comes first, so that most places fail at once."""
    w = re.escape(word)
    return rf"{w}(?<![\p{{L}}\p{{N}}]{w})(?![\p{{L}}\p{{N}}])"


def fold(x: Column | str) -> Column:
    """Without accents."""
    return F.translate(col(x), MARKED, PLAIN)


def normalize(x: Column | str) -> Column:
    """Lower case, letters and digits only, single spaces."""
    return F.trim(F.regexp_replace(F.lower(col(x)), r"[^\p{L}\p{N}]+", " "))


def words(x: Column | str) -> Column:
    """Words of the normalised text; an empty array for none."""
    n = normalize(x)
    return F.when(n != "", F.split(n, " ")).otherwise(F.array().cast("array<string>"))


def signature(x: Column | str, n: int = 16) -> Column:
    """The first ``n`` normalised words: texts that share it count as the same passage."""
    return F.array_join(F.slice(words(x), 1, n), " ")


def shingles(x: Column | str, n: int = 8) -> Column:
    """Distinct runs of ``n`` words; none for shorter texts."""
    def runs(w: Column) -> Column:
        some = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, F.array_distinct(some)).otherwise(F.array().cast("array<string>"))

    return F.transform(F.array(words(x)), runs)[0]  # binds the words, else every run would cut the text again


def shingle_hashes(x: Column | str, n: int = 8) -> Column:
    """64-bit hashes of the distinct runs of ``n`` words: word hashes combined by position, a vector at a time."""

    def run(texts):
        import numpy as np
        import pandas as pd
        import xxhash

        out = []
        for t in texts:
            w = t.split() if t else []
            if len(w) < n:
                out.append(np.zeros(0, np.int64))
                continue
            h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
            s = np.zeros(len(w) - n + 1, np.uint64)
            for j in range(n):
                s = s * np.uint64(0x9E3779B97F4A7C15) + h[j : len(w) - n + 1 + j]
                s ^= s >> np.uint64(29)
            out.append(np.unique(s).view(np.int64))
        return pd.Series(out)

    return F.pandas_udf(run, "array<long>")(normalize(x))


def query_terms(text: str, stopwords: frozenset[str]) -> list[str]:
    """Words of a query without the caller's stop words; all of them if nothing else is left."""
    found = [w for w in "".join(c.lower() if c.isalnum() else " " for c in text).split()]
    return [w for w in dict.fromkeys(found) if w not in stopwords] or list(dict.fromkeys(found))


def match_expression(terms: Sequence[str]) -> str:
    """Full-text expression: any of the quoted terms."""
    return " OR ".join('"' + t.replace('"', '""') + '"' for t in terms)


def topical_fit(x: Column | str, terms: Sequence[str], prefix: int = 5) -> Column:
    """Share of query terms whose first letters begin some word of the text."""
    def hit(term: str) -> Column:
        return F.exists(words(x), lambda v: v.startswith(term[:prefix])).cast("int")

    return sum((hit(t) for t in terms[1:]), hit(terms[0])) / len(terms)


def parse_number(x: Column | str) -> Column:
    """Number in either notation: 1.234,5 or 1,234.5, (123) as negative, a trailing %; null if it isn't one."""
    raw = F.trim(col(x))
    body = F.regexp_replace(raw, r"[()$%\s]", "")
    european = body.rlike(r"^-?\d{1,3}(\.\d{3})+(,\d+)?$") | body.rlike(r"^-?\d+,\d{1,2}$")
    plain = F.when(european, F.replace(F.replace(body, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(body, F.lit(","), F.lit("")))
    value = F.when(plain.rlike(r"^-?\d+(\.\d+)?$"), plain.cast("double"))
    return F.when(raw.rlike(r"^\(.*\)$"), -value).otherwise(value)


def slugify(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(fold(x)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def count_matches(x: Column | str, terms: Sequence[str]) -> Column:
    """Whole-word occurrences of any term, case aside."""
    return F.regexp_count(F.lower(col(x)), F.lit(whole_words(terms)))


def whole_words(terms: Sequence[str]) -> str:
    """Pattern of any term between characters other than ASCII letters, digits and underscores."""
    return "(?<![A-Za-z0-9_])(?:" + "|".join(terms) + ")(?![A-Za-z0-9_])"


def first_rule(x: Column | str, rules: Mapping[str, Sequence[str]], other: str) -> Column:
    """Name of the first rule one of whose keywords the text holds."""
    low = F.lower(col(x))
    out = F.lit(other)
    for name, keys in reversed(list(rules.items())):
        out = F.when(low.rlike("|".join(keys)), name).otherwise(out)
    return out


def language(x: Column | str, marks: Mapping[str, Sequence[str]]) -> Column:
    """Language with the most of its common words; ties and none by the order given."""
    def best(w: Column) -> Column:
        count = lambda ws: F.size(F.filter(w, lambda v: v.isin(list(ws))))
        return F.greatest(*[F.struct(count(ws).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("lang")) for i, (k, ws) in enumerate(marks.items())])["lang"]

    return F.transform(F.array(words(x)), best)[0]


def redact_html(x: Column | str) -> Column:
    """A provider's page without menus, footers, scripts, styles and adverts; other tags become spaces."""
    s = F.regexp_replace(col(x), r"(?is)<(?:nav|footer|script|style)\b.*?</(?:nav|footer|script|style)>", "")
    return F.regexp_replace(F.regexp_replace(s, r'(?is)<div class="ad">.*?</div>', ""), r"(?s)<[^>]*>", " ")


def strip_html(x: Column | str) -> Column:
    """Text of a page by patterns: scripts, styles and tags out, common references decoded, white space collapsed."""
    s = F.regexp_replace(col(x), r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->|<[^>]*>", " ")
    for name, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(c))
    return F.trim(F.regexp_replace(s, r"[\x20\x09-\x0D]+", " "))
