"""Label matching against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import labels


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def typo(rng, s):
    i, kind = rng.randrange(len(s)), rng.randrange(3)
    return s[:i] + {0: "", 1: s[i] * 2, 2: rng.choice("abez")}[kind] + s[i + (kind < 1 or kind == 2) :]


@pytest.mark.parametrize("least", [0.85, 0.7, 0.95])
def test_near_pairs_lose_nothing(spark, least):
    rng = random.Random(6)
    known = ["".join(rng.choices("abcde ", k=rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 13, 14, 20, 33]))).strip() for _ in range(150)] + ["aaaaaaa", "abababab"]
    known = sorted({k for k in known if k})
    other = sorted({t for k in known for t in (k, typo(rng, k) or "a", typo(rng, typo(rng, k) or "ab") or "a")})
    got = {tuple(r) for r in labels.near_pairs(spark.createDataFrame([(x,) for x in other], "x string"), spark.createDataFrame([(x,) for x in known], "x string"), least).collect()}
    want = {(a, b) for a in other for b in known if 1 - distance(a, b) / max(len(a), len(b)) >= least}
    assert want <= got


@pytest.mark.parametrize("block", [2, 1024])
def test_near_pairs_of_few_words_leave_the_join_once(spark, monkeypatch, block):
    """All labels here share their pairs of letters, so nearly all pairs meet; only near ones may come out."""
    monkeypatch.setattr(labels, "BLOCK", block)
    known = [f"{a} {b} {c} brand {n}" for a in ("small", "economy") for b in ("blue", "hot") for c in ("anvil", "rod", "gear") for n in (1, 2, 11, 21)]
    other = known + [k.replace("e", "i") for k in known] + [k[:3] + k[2:] for k in known] + ["niño año brand 1", "niña ano brand 1"]
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "x string")
    got = [tuple(r) for r in labels.near_pairs(df(other), df(known + ["niño año brand 1"])).collect()]
    want = {(a, b) for a in other for b in [*known, "niño año brand 1"] if distance(a, b) <= int(0.15 * max(len(a), len(b)) + 1e-9)}
    assert len(got) == len(want) and set(got) == want


def test_candidates_hold_more_than_one_shared_word(spark):
    known = [f"{a} {b} items" for a in ("net", "gross", "other") for b in ("sales", "income", "assets")]
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "x string")
    got = {tuple(r) for r in labels.candidates(df(["net sales of items", "assets items gross", "sales net items"]), df([*known, "net net sales"])).collect()}
    assert got == {("net sales of items", "net sales items"), ("net sales of items", "net net sales")}


def test_few_pairs_are_compared(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(4, 10))) for _ in range(300)]
    known = list({" ".join(rng.choices(words, k=3)) for _ in range(600)})
    other = [typo(rng, k) for k in known]
    met = labels.near_pairs(spark.createDataFrame([(x,) for x in other], "x string"), spark.createDataFrame([(x,) for x in known], "x string"))
    assert met.count() < 0.02 * len(known) * len(other)


ALIASES = [("sales", "net sales"), ("sales", "ventas netas"), ("sales", "sales"), ("receivable", "accounts receivable"), ("income", "net income"), ("ebitda", "ebitda"), ("assets", "total assets")]


def plain(label):
    best = None
    lw = label.split()
    for metric, alias in ALIASES:
        aw, near = alias.split(), 1 - distance(label, alias) / max(len(label), len(alias))
        places = [lw.index(x) if x in lw else -1 for x in aw]
        if label == alias:
            s, m = 1.0, "exact"
        elif lw[0] in ("other", "otros") and aw[0] not in ("other", "otros"):
            s, m = 0.0, "residual"
        elif len(aw) == 1 and lw[0] == alias and len(lw) > 1 and lw[1] in ("from", "por"):
            s, m = 0.0, "subline"
        elif label.startswith(alias + " "):
            s, m = 0.98, "prefix"
        elif len(aw) > 1 and -1 not in places and places == sorted(places) and len(lw) <= len(aw) + 2 and near < 0.88:
            s, m = 0.88, "words"
        else:
            s, m = near, "spelling"
        key = (s, metric, -len(alias), [-ord(c) for c in alias])
        if s >= 0.85 and (best is None or key > best[0]):
            best = (key, (label, metric, alias, round(s, 9), m))
    return best and best[1]


def test_best_matches_equal_all_pairs(spark):
    rng = random.Random(8)
    some = [a for _, a in ALIASES] + ["net sales of goods", "sales from abroad", "sales tax", "other accounts receivable", "accounts and notes receivable", "receivable accounts", "total current assets", "net consolidated income", "minority net income", "ebit", "ventas", "the company believes that net sales", "x", "sales " * 20, "assets total"]
    some += [typo(rng, a) for a in some for _ in range(6)]
    raw = spark.createDataFrame([(x,) for x in some] + [(None,), ("",), (" - ",), ("NET  SALES!",), ("Ventas Nétas",)], "t string").select(labels.normal(F.col("t")).alias("label"))
    aliases = spark.createDataFrame(ALIASES, "metric string, alias string")
    got = labels.best_matches(raw, aliases, residual=("other", "otros"), sublines=("from", "por"), negatives=("minority",), prose=r"\b(believes|expects)\b")
    wanted = {r["label"] for r in raw.collect() if r["label"] and len(r["label"]) <= 90 and len(r["label"].split()) <= 12 and not r["label"].startswith("minority") and not {"believes", "expects"} & set(r["label"].split())}
    assert {(r["label"], r["metric"], r["alias"], round(r["score"], 9), r["method"]) for r in got.collect()} == {p for x in wanted if (p := plain(x))}
    assert labels.best_matches(raw.limit(0), aliases).collect() == []


def test_consolidated_rows_win(spark):
    df = spark.createDataFrame([("p", "net sales mexico", "sales", 0.98), ("p", "net sales", "sales", 0.98), ("p", "net sales consolidated", "sales", 0.98), ("q", "net sales mexico", "sales", 1.0), ("q", "total net sales", "sales", 0.88)], "page string, label string, metric string, score double")
    got = {(r["page"]): (r["label"], r["rank"]) for r in labels.best_rows(df, ["page"], ("consolidated",), ("mexico",)).collect()}
    assert got == {"p": ("net sales consolidated", 2), "q": ("net sales mexico", -1)}
