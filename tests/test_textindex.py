"""The inverted index against plain counts, on awkward texts, and what a query reads of it."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import log

import pytest

from tidemark.operators.textindex import BUCKETS, TextIndex

WORDS = "alpha beta gamma delta the año 日本 x1 of".split()
KEYS = {"doc": "long", "part": "int"}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = {(i, j): " ".join(rng.choices(WORDS, rng.choice([[1] * 9, [9, 5, 1, 1, 30, 1, 1, 1, 1]]), k=rng.choice([0, 1, 3, 40, 900]))) for i in range(60) for j in range(3)}
    return out | {(100, 0): None, (101, 0): "", (102, 0): " .,; ", (103, 0): "ALPHA-beta\tGamma\n\nalpha beta gamma", (None, 0): "alpha alpha"}


def plain(texts, terms):
    words = {k: re.findall(r"[^\W_]+", (t or "").lower()) for k, t in texts.items()}
    mean = sum(map(len, words.values())) / len(words)
    tf = {k: Counter(w) for k, w in words.items()}
    df = {t: sum(t in c for c in tf.values()) for t in terms}
    idf = {t: log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) for t in terms}
    return {k: sum(idf[t] * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(words[k]) / mean)) for t in terms) for k, c in tf.items() if any(c[t] for t in terms)}


def frame(spark, texts):
    return spark.createDataFrame([(*k, t) for k, t in texts.items()], "doc long, part int, text string")


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    out = TextIndex(spark, str(tmp_path_factory.mktemp("index")), KEYS)
    out.append(frame(spark, texts))
    return out


def files(index, part):
    return {f for f in index.read(part).inputFiles()}


@pytest.mark.parametrize("query", ["alpha", "the delta", "日本 año x1", "nowhere", "gamma nowhere", "the of alpha beta"])
def test_scores_are_those_of_the_texts(index, texts, query):
    want = plain(texts, query.split())
    got = {(r["doc"], r["part"]): r["score"] for r in index.search(query).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    for k in (1, 5, 1000):
        best = [(r["doc"], r["part"]) for r in index.top(query, k).collect()]
        order = sorted(want, key=lambda x: (-round(want[x], 9), x[0] is not None, x[0] or 0, x[1]))
        assert [round(want[x], 9) for x in best] == [round(want[x], 9) for x in order[:k]] and len(set(best)) == len(best)


@pytest.mark.parametrize("phrase", ["alpha beta", "alpha beta gamma", "the the", "delta of the", "beta nowhere"])
def test_phrases(index, texts, phrase):
    words = phrase.split()
    want = {}
    for k, t in texts.items():
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if n := sum(w[i : i + len(words)] == words for i in range(len(w))):
            want[k] = n
    assert {(r["doc"], r["part"]): r["n"] for r in index.phrase(phrase).collect()} == want


def test_append_keeps_files_and_totals(spark, texts, tmp_path):
    index = TextIndex(spark, str(tmp_path / "grown"), KEYS)
    half = {k: t for n, (k, t) in enumerate(texts.items()) if n % 2 and k[0] is not None}
    assert index.search("alpha").collect() == [] and index.append(frame(spark, half)) == 1
    before = {p: files(index, p) for p in ("postings", "blocks", "units")}
    whole = {k: t for k, t in texts.items() if k[0] is not None}
    assert index.append(frame(spark, whole)) == 2
    assert all(before[p] < files(index, p) for p in before)
    want = plain(whole, ["alpha", "of"])
    got = {(r["doc"], r["part"]): r["score"] for r in index.search("alpha of").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_queries_read_their_buckets_only(index):
    plan = index.search("gamma nowhere")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and re.search(r"PushedFilters: \[[^\]]*term", plan)
    read = {re.search(r"bucket=(\d+)", f)[1] for f in index.of_terms("postings", ["gamma"]).inputFiles()}
    all_ = {re.search(r"bucket=(\d+)", f)[1] for f in files(index, "postings")}
    assert len(read) >= 1 and len(all_) <= BUCKETS and "text" not in index.read("postings").columns


def test_top_skips_blocks(index, monkeypatch):
    """The bound of long texts is under the best scores, so their blocks aren't asked for."""
    from tidemark.operators import textindex

    asked = []
    monkeypatch.setattr(textindex, "_within", lambda blocks, real=textindex._within: asked.append(len(blocks)) or real(blocks))
    stats = index.of_terms("blocks", ["x1"]).count()
    assert index.top("x1", 1).count() == 1
    assert asked and max(asked) < stats
