"""Sequential work on one text at a time: chunks, sentences, tone, differences, scrubbing; vectorised UDFs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from difflib import SequenceMatcher

from pyspark.sql import Column
from pyspark.sql import functions as F

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
#: Letters of texts that are compared at once.
PACK = 4096
_HEADING = re.compile(r"^#{1,6}\s+(.*)$", re.M)


@dataclass(frozen=True)
class Lexicon:
    """Words that give a passage its tone; the caller's, as tone depends on the field.

    ``burdens`` are things whose growth is bad news and whose fall is good news: a tone word within
    ``object_words`` of one counts the other way. A negation up to ``negation_words`` before does so too.
    """

    positive: frozenset[str]
    negative: frozenset[str]
    negations: frozenset[str] = frozenset(("no", "not", "never"))
    burdens: frozenset[str] = frozenset()
    negation_words: int = 3
    object_words: int = 4


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence with a letter or digit."""
    out = []
    for m in _SENTENCE.finditer(text):
        s = m[0]
        lead = len(s) - len(s.lstrip())
        if any(c.isalnum() for c in s):
            out.append((m.start() + lead, m.start() + len(s.rstrip())))
    return out


def chunks(text: str, target: int = 900, overlap: int = 150) -> list[tuple[int, int, str]]:
    """(start, end, heading) of overlapping chunks that end at sentence ends and never cross a heading."""
    heads = [(m.start(), m[1].strip()) for m in _HEADING.finditer(text)]
    borders = [(0, "")] + heads if not heads or heads[0][0] > 0 else heads
    out = []
    for i, (begin, name) in enumerate(borders):
        end = borders[i + 1][0] if i + 1 < len(borders) else len(text)
        parts = [(begin + a, begin + b) for a, b in sentences(text[begin:end])]
        first = 0
        while first < len(parts):
            last = first
            while last + 1 < len(parts) and parts[last + 1][1] - parts[first][0] <= target:
                last += 1
            out.append((parts[first][0], parts[last][1], name))
            if last + 1 >= len(parts):
                break
            following = last + 1
            while following - 1 > first and parts[last][1] - parts[following - 1][0] <= overlap:
                following -= 1
            while following <= last and parts[last + 1][1] - parts[following][0] > target:
                following += 1  # an overlap that leaves no room for the next sentence would repeat what is there
            first = following
    return out


def tone_marks(text: str, lexicon: Lexicon) -> list[int]:
    """1 or -1 for each tone word of a text, after negations and burdens near it."""
    found = re.findall(r"\w+", text.lower())
    marks = []
    for i, w in enumerate(found):
        side = (w in lexicon.positive) - (w in lexicon.negative)
        if side:
            if lexicon.negations.intersection(found[max(0, i - lexicon.negation_words) : i]):
                side = -side
            if lexicon.burdens.intersection(found[max(0, i - lexicon.object_words) : i + lexicon.object_words + 1]):
                side = -side
            marks.append(side)
    return marks


def tone(text: str, lexicon: Lexicon) -> float:
    """Balance of tone words in -1..1."""
    marks = tone_marks(text, lexicon)
    return sum(marks) / len(marks) if marks else 0.0


def likeness(a: str, b: str, least: float) -> float:
    """``SequenceMatcher(None, a, b).ratio()`` where it is at least ``least``, else -1 as soon as that can't be reached.

    The longest common run first by place in ``a``, then in ``b``, and so on to its left and right: found by searches for
    substrings. What is still open can add no more than its shorter side.
    """
    size = len(a) + len(b)
    if not size:
        return 1.0 if least <= 1 else -1.0
    found, room, rest = 0, min(len(a), len(b)), [(a, b)]
    if 2.0 * room / size < least:
        return -1.0
    if len(b) >= 200:  # from here on SequenceMatcher leaves frequent letters out
        r = SequenceMatcher(None, a, b).ratio()
        return r if r >= least else -1.0
    while rest:
        x, y = rest.pop()
        room -= min(len(x), len(y))
        n, k, at = len(x), 0, 0
        i = 0
        while i + k < n:
            if x[i : i + k + 1] in y:
                k, at = k + 1, i
                while i + k < n and x[i : i + k + 1] in y:
                    k += 1
            i += 1
        if k:
            found += k
            j = y.find(x[at : at + k])
            for u, v in ((x[:at], y[:j]), (x[at + k :], y[j + k :])):
                if u and v:
                    rest.append((u, v))
                    room += min(len(u), len(v))
        if 2.0 * (found + room) / size < least:
            return -1.0
    return 2.0 * found / size


def _lanes(texts: Sequence[str]) -> list[tuple[dict[str, int], int, list[tuple[int, int, int]]]]:
    """Texts side by side in whole numbers, a bit a letter and a free bit after each text: (places of each letter, all places, (text, first bit, length))."""
    packs, bits, places, lanes = [], 0, {}, []
    for i, t in enumerate(texts):
        if len(t) > PACK:
            continue
        if bits + len(t) > PACK and lanes:
            packs.append((places, lanes))
            bits, places, lanes = 0, {}, []
        for k, c in enumerate(t):
            places[c] = places.get(c, 0) | 1 << bits + k
        lanes.append((i, bits, len(t)))
        bits += len(t) + 1
    packs.append((places, lanes))
    return [(p, sum((1 << n) - 1 << at for _, at, n in own), own) for p, own in packs]


def _common(packs, texts: Sequence[str], s: str) -> list[int]:
    """For each text, how many letters it can have in common with ``s``, in order: no ratio counts more.

    The longest common subsequence of all texts at once, a bit each where it can't grow. Long texts are not compared.
    """
    most = [min(len(t), len(s)) for t in texts]
    if len(s) <= PACK:
        for places, whole, lanes in packs:
            open_ = whole
            for c in s:
                if u := open_ & places.get(c, 0):
                    open_ = ((open_ + u) | (open_ - u)) & whole
            for i, at, n in lanes:
                most[i] = n - ((open_ >> at) & (1 << n) - 1).bit_count()
    return most


def redline(old: str, new: str, ratio: float = 0.6) -> dict[str, int]:
    """Counts of sentences kept, changed (similar to an unmatched old one), added and removed."""
    a = [old[x:y] for x, y in sentences(old)]
    b = [new[x:y] for x, y in sentences(new)]
    before, after = set(a), set(b)
    gone, fresh = [s for s in a if s not in after], [s for s in b if s not in before]
    left, packs = dict(enumerate(gone)), _lanes(gone) if fresh else []
    changed = 0
    for s in fresh:
        best, like, most = None, -1.0, _common(packs, gone, s)
        for i, o in left.items():
            least = max(ratio, like)
            if 2.0 * most[i] / (len(o) + len(s)) >= least and (r := likeness(o, s, least)) > like:
                best, like = i, r
        if best is not None:
            del left[best]
            changed += 1
    return {"kept": len(b) - len(fresh), "changed": changed, "added": len(fresh) - changed, "removed": len(left)}


def merge_spans(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def snippet_windows(spans: Sequence[tuple[int, int]], size: int, pad: int = 120, most: int = 1200) -> list[tuple[int, int]]:
    """Passages around matches: padded, merged where they overlap, none longer than ``most``."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        lo, hi = max(0, a - pad), min(size, b + pad)
        if out and lo <= out[-1][1] and hi - out[-1][0] <= most:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def chunk_column(text: Column, target: int = 900, overlap: int = 150) -> Column:
    def run(texts):
        import pandas as pd

        return pd.Series([[{"ordinal": i, "start": a, "end": b, "heading": h} for i, (a, b, h) in enumerate(chunks(t or "", target, overlap))] for t in texts])

    return F.pandas_udf(run, "array<struct<ordinal:int,start:int,end:int,heading:string>>")(text)


def tone_column(text: Column, lexicon: Lexicon) -> Column:
    """Struct of tone, and of how many tone words speak for and against."""

    def run(texts):
        import pandas as pd

        marks = [tone_marks(t or "", lexicon) for t in texts]
        return pd.DataFrame([(sum(m) / len(m) if m else 0.0, m.count(1), m.count(-1)) for m in marks], columns=["tone", "positive", "negative"])

    return F.pandas_udf(run, "tone double, positive long, negative long")(text)


def sentence_column(text: Column) -> Column:
    def run(texts):
        import pandas as pd

        return pd.Series([[{"start": a, "end": b} for a, b in sentences(t or "")] for t in texts])

    return F.pandas_udf(run, "array<struct<start:int,end:int>>")(text)


def redline_column(old: Column, new: Column) -> Column:
    def run(a, b):
        import pandas as pd

        return pd.DataFrame([redline(x or "", y or "") for x, y in zip(a, b)])

    return F.pandas_udf(run, "kept long, changed long, added long, removed long")(old, new)


def scrub(text: Column, names: Mapping[str, Sequence[str]]) -> Column:
    """Names, addresses, years and long numbers replaced by neutral marks, longest names first."""
    out = text
    for mark, forms in names.items():
        for form in sorted(forms, key=len, reverse=True):
            out = F.regexp_replace(out, r"(?i)\b" + re.escape(form) + r"\b", mark)
    out = F.regexp_replace(out, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "MAIL")
    out = F.regexp_replace(out, r"\b(?:19|20)\d{2}\b", "YEAR")
    return F.regexp_replace(out, r"\d{6,}", "NUMBER")


def label_score(a: str, b: str) -> float:
    """Similarity of two row labels: shared words and character order."""
    norm = lambda s: " ".join(re.findall(r"\w+", s.lower()))
    x, y = norm(a), norm(b)
    if not x or not y:
        return 0.0
    wx, wy = set(x.split()), set(y.split())
    return 0.5 * len(wx & wy) / len(wx | wy) + 0.5 * SequenceMatcher(None, x, y).ratio()


def best_label(labels: Column, known: Sequence[str], least: float = 0.85, ruled_out: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Struct (label, score) of the best known label at or above ``least``.

    ``ruled_out`` names words by known label that speak against it ("minority" against "net income").
    """
    against = ruled_out or {}

    def run(xs):
        import pandas as pd

        rows = []
        for x in xs:
            words = set(re.findall(r"\w+", (x or "").lower()))
            score, name = max(((label_score(x or "", k), k) for k in known if not words.intersection(against.get(k, ()))), default=(0.0, None))
            rows.append({"label": name if score >= least else None, "score": score})
        return pd.DataFrame(rows)

    return F.pandas_udf(run, "label string, score double")(labels)
