"""Queries that SQL can't express against plain loops on the small tables; readers on files made here."""

from __future__ import annotations

import io
import math
import random
import re
import time
import zipfile
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import passages, search, strategy
from tidemark.plans import registry, retrieval
from tidemark.plans.study import scored
from tidemark.sources import bundles, readers


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def table(spark, sf_dir, name):
    return rows(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


@pytest.fixture(scope="module")
def study(spark, sf_dir):
    return [r for r in rows(scored(spark, sf_dir)) if r["z"] is not None and r["fwd"] is not None]


def test_hashing_embeddings(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents")}
    for r in rows(registry.QUERIES["hashing_embeddings"](spark, sf_dir)):
        v = [0.0] * 64
        for word in re.sub(r"[\W_]", " ", texts[r["doc_id"]].lower()).split():
            h = 0x811C9DC5
            for byte in word.encode():
                h = ((h ^ byte) * 0x01000193) % (1 << 32)
            v[h % 64] += 1 if h >= 1 << 31 else -1
        n = math.sqrt(sum(x * x for x in v)) or 1.0
        assert r["embedding"] == pytest.approx([x / n for x in v], abs=1e-6)


def test_flood_caps(spark, sf_dir):
    got = sorted(rows(registry.QUERIES["flood_caps"](spark, sf_dir)), key=lambda r: r["rank"])
    lang, source = Counter(), Counter()
    for r in got:
        fits = lang[r["lang"]] < 20 and source[r["source"]] < 3
        assert r["sunk"] == (not fits)
        if fits:
            lang[r["lang"]] += 1
            source[r["source"]] += 1
    assert got and [r["rank"] for r in got] == list(range(1, len(got) + 1))


def test_turn_redline(spark, sf_dir):
    turns: dict = {}
    for r in table(spark, sf_dir, "conversations"):
        turns.setdefault((r["conv_id"], r["role"]), []).append(r)
    got = {(r["conv_id"], r["turn"]): r for r in rows(registry.QUERIES["turn_redline"](spark, sf_dir))}
    split = lambda t: [s.strip() for s in re.findall(r"[^.!?\n]+[.!?]*", t or "") if re.search(r"[^\W_]", s)]
    for group in turns.values():
        group.sort(key=lambda r: r["turn"])
        for old, new in zip(group, group[1:]):
            if old["text"] is None:
                assert (new["conv_id"], new["turn"]) not in got
                continue
            a, b = split(old["text"]), split(new["text"])
            left, fresh, changed = [s for s in a if s not in b], [s for s in b if s not in a], 0
            for s in fresh:
                close = [(SequenceMatcher(None, o, s).ratio(), -i) for i, o in enumerate(left)]
                if close and max(close)[0] >= 0.6:
                    left.pop(-max(close)[1])
                    changed += 1
            r = got[new["conv_id"], new["turn"]]
            assert (r["kept"], r["changed"], r["added"], r["removed"]) == (len(b) - len(fresh), changed, len(fresh) - changed, len(left))


def test_document_chunks(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents")}
    chunks: dict = {}
    for r in rows(registry.QUERIES["document_chunks"](spark, sf_dir)):
        chunks.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        found = sorted(chunks.get(i, []), key=lambda r: r["ordinal"])
        assert [r["ordinal"] for r in found] == list(range(len(found)))
        spans = passages.sentences(text)
        heads = [m.start() for m in re.finditer(r"^#{1,6}\s+.*$", text, re.M)]
        starts, ends = {a for a, _ in spans}, {b for _, b in spans}
        for r in found:
            one = (r["start"], r["end"]) in spans
            assert r["start"] in starts and r["end"] in ends and (one or r["end"] - r["start"] <= 900)
            assert not any(r["start"] < h < r["end"] for h in heads)
        assert all(any(r["start"] <= a and b <= r["end"] for r in found) for a, b in spans)  # every sentence in some chunk
        for r, s in zip(found, found[1:]):
            assert r["start"] < s["start"] and r["end"] < s["end"] and r["end"] - s["start"] <= 150


def test_document_tone(spark, sf_dir):
    texts, t = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents")}, retrieval.TONE
    sign, turned = {**dict.fromkeys(t.positive, 1), **dict.fromkeys(t.negative, -1)}, 0
    for r in rows(registry.QUERIES["document_tone"](spark, sf_dir)):
        words, marks = re.findall(r"\w+", texts[r["doc_id"]].lower()), []
        for k, w in enumerate(words):
            if w in sign:
                flips = any(x in t.negations for x in words[max(0, k - 3) : k]) + any(x in t.burdens for x in words[max(0, k - 4) : k + 5])
                marks.append(sign[w] * (-1) ** flips)
                turned += flips == 1
        assert r["tone"] == pytest.approx(sum(marks) / len(marks) if marks else 0.0)
        assert (r["positive"], r["negative"]) == (sum(m > 0 for m in marks), sum(m < 0 for m in marks))
    assert turned


def test_fuzzy_labels(spark, sf_dir):
    got = rows(registry.QUERIES["fuzzy_labels"](spark, sf_dir))
    for r in got:
        best = (0.0, None)
        for k in retrieval.FUZZY_KNOWN:
            a, b = r["p_type"].split(), k.split()
            if not set(a) & set(retrieval.FUZZY_AGAINST.get(k, ())):
                score = len(set(a) & set(b)) / len(set(a) | set(b)) / 2 + SequenceMatcher(None, " ".join(a), " ".join(b)).ratio() / 2
                best = max(best, (score, k))
        assert r["score"] == pytest.approx(best[0], abs=1e-6) and r["label"] == (best[1] if best[0] >= 0.85 else None)
    assert len({r["p_type"] for r in got}) == len(got)


def newton(x, y):
    a, b = np.stack([np.ones(len(x)), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a @ b)))
        b = b + np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-6 * np.eye(2), a.T @ (y - p) - 1e-6 * b)
    return b


def test_conviction_model(spark, sf_dir, study):
    for r in rows(registry.QUERIES["conviction_model"](spark, sf_dir)):
        past = [s for s in study if r["qi"] - 8 <= s["qi"] < r["qi"]]
        y = np.array([float(np.sign(s["z"]) == np.sign(s["fwd"])) for s in past])
        assert r["n"] == len(past)
        if len(past) < 20 or len(set(y)) < 2:
            assert r["intercept"] is None
        else:
            assert [r["intercept"], r["slope"]] == pytest.approx(newton(np.array([abs(s["z"]) for s in past]), y).tolist(), rel=1e-5, abs=1e-6)


def pair_auc(score, y):
    up, down = score[y == 1], score[y == 0]
    return float(np.mean((up[:, None] > down[None]) + 0.5 * (up[:, None] == down[None])))


@pytest.mark.parametrize("name", ["walk_forward_auc", "left_out_auc"])
def test_auc_of_fits(spark, sf_dir, study, name):
    quarter, z, y = (np.array([f(s) for s in study]) for f in (lambda s: s["qi"], lambda s: s["z"], lambda s: float(s["fwd"] > 0)))
    score = np.full(len(study), np.nan)
    for q in set(quarter.tolist()):
        known = (quarter < q) & (quarter >= q - 8) if name == "walk_forward_auc" else quarter != q
        if known.sum() >= 20 and len(set(y[known])) == 2:
            b = newton(z[known], y[known])
            score[quarter == q] = 1 / (1 + np.exp(-(b[0] + b[1] * z[quarter == q])))
    ok = ~np.isnan(score)
    (r,) = rows(registry.QUERIES[name](spark, sf_dir))
    assert (r["pos"], r["neg"]) == (int((y[ok] == 1).sum()), int((y[ok] == 0).sum()))
    assert r["auc"] == pytest.approx(pair_auc(score[ok], y[ok]), abs=2e-3)  # near-equal scores may tie on one side only
    if name == "left_out_auc":
        rng, real, more = np.random.default_rng(0), np.mean(score[ok] * y[ok]), 0
        for _ in range(200):
            mixed = score.copy()
            for q in set(quarter.tolist()):
                at = np.flatnonzero(ok & (quarter == q))
                mixed[at] = score[rng.permutation(at)]
            more += np.mean(mixed[ok] * y[ok]) >= real
        assert abs(r["chance"] - (more + 1) / 201) < 0.2 and r["open"] == (r["auc"] > 0.5 and r["chance"] <= 0.05)


def test_permutation(spark, sf_dir, study):
    (r,) = rows(registry.QUERIES["permutation_test"](spark, sf_dir))
    quarter, z, fwd = (np.array([s[k] for s in study]) for k in ("qi", "z", "fwd"))
    assert r["real"] == pytest.approx(float(np.mean(z * fwd)))
    rng, more = np.random.default_rng(0), 0
    for _ in range(400):
        mixed = z.copy()
        for q in set(quarter.tolist()):
            at = np.flatnonzero(quarter == q)
            mixed[at] = z[rng.permutation(at)]
        more += np.mean(mixed * fwd) >= r["real"]
    assert abs(r["p"] - (more + 1) / 401) < 0.12


def test_multi_regression(spark, sf_dir):
    used = [s for s in rows(scored(spark, sf_dir)) if None not in (s["z"], s["dx"], s["fwd"])]
    groups = np.array([s["qi"] for s in used])
    m = np.array([[s["z"], s["dx"] / s["revenue"], s["fwd"]] for s in used])
    for q in set(groups.tolist()):
        m[groups == q] -= m[groups == q].mean(axis=0)
    x, y = m[:, :2], m[:, 2]
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    bread, n = np.linalg.inv(x.T @ x), len(set(groups.tolist()))
    u = np.array([x[groups == q].T @ (y - x @ beta)[groups == q] for q in set(groups.tolist())])
    se = np.sqrt(np.diag(bread @ (u.T @ u) @ bread * n / (n - 1)))
    got = {r["name"]: r for r in rows(registry.QUERIES["multi_regression"](spark, sf_dir))}
    assert [got["z"]["slope"], got["scaled"]["slope"]] == pytest.approx(beta.tolist(), rel=1e-6)
    assert [got["z"]["se"], got["scaled"]["se"]] == pytest.approx(se.tolist(), rel=1e-6)


def test_hit_rate_pvalues(spark, sf_dir, study):
    got = {r["slug"]: r for r in rows(registry.QUERIES["hit_rate_pvalues"](spark, sf_dir))}
    for slug, r in got.items():
        signs = [(np.sign(s["z"]), np.sign(s["fwd"])) for s in study if s["slug"] == slug]
        signs = [(a, b) for a, b in signs if a and b]
        k, n = sum(a == b for a, b in signs), len(signs)
        assert (r["hits"], r["n"]) == (k, n)
        if n:
            assert r["p_hits"] == pytest.approx(sum(math.comb(n, i) for i in range(k, n + 1)) / 2**n, rel=1e-9)
    ps = sorted(r["p_hits"] for r in got.values() if r["p_hits"] is not None)
    for r in got.values():
        if r["p_hits"] is not None:
            assert r["q"] == pytest.approx(min(1.0, min(p * len(ps) / (i + 1) for i, p in enumerate(ps) if p >= r["p_hits"])))


def workbook(cells: dict[str, object]) -> bytes:
    """A minimal workbook: numbers as values, texts shared or inline."""
    ns, shared, body = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', [], []
    for at, v in cells.items():
        if isinstance(v, str) and v.startswith("="):
            body.append(f'<c r="{at}" t="inlineStr"><is><t>{v[1:]}</t></is></c>')
        elif isinstance(v, str):
            body.append(f'<c r="{at}" t="s"><v>{len(shared)}</v></c>')
            shared.append(v)
        else:
            body.append(f'<c r="{at}"><v>{v}</v></c>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData><row>{''.join(body)}</row></sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{''.join(f'<si><t>{t}</t></si>' for t in shared)}</sst>")
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook({"A1": "Company", "B1": "1T2001", "A2": "=inline", "B2": 12.5}))
    (tmp_path / "b.xlsx").write_bytes(workbook({"AB10": 7}))
    got = {(r["file"], r["row"], r["column"]): r["value"] for r in rows(bundles.sheet_cells(spark, str(tmp_path)))}
    assert got == {("a.xlsx", 1, "A"): "Company", ("a.xlsx", 1, "B"): "1T2001", ("a.xlsx", 2, "A"): "inline", ("a.xlsx", 2, "B"): "12.5", ("b.xlsx", 10, "AB"): "7"}


def test_manifest_tells_what_changed(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    for name in ("same", "changed", "missing"):
        (data / name).write_text(name)
    bundles.write_manifest(spark, str(data), str(tmp_path / "manifest"))
    (data / "changed").write_text("other")
    (data / "missing").unlink()
    (data / "extra").write_text("x")
    assert {r["name"]: r["state"] for r in rows(bundles.verify(spark, str(data), str(tmp_path / "manifest")))} == {n: n for n in ("same", "changed", "missing", "extra")}


def test_catalog_file(spark, tmp_path):
    """A catalog database read in parts, each by its own predicate."""
    import sqlite3

    path = tmp_path / "catalog.db"
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE documents (id INTEGER, kind TEXT)")
        db.executemany("INSERT INTO documents VALUES (?, ?)", [(i, "ab"[i % 2]) for i in range(100)])
    got = rows(readers.catalog_file(spark, str(path), "documents", "id long, kind string", ["id < 10", "id >= 90 AND kind = 'a'"]))
    assert sorted(r["id"] for r in got) == [*range(10), *range(90, 100, 2)]


@pytest.mark.parametrize("kinds, firms, n", [(3, 4, 300), (40, 25, 4000), (1, 1, 50), (1, 5000, 20_000), (200, 60, 100_000)])
def test_floods_in_rounds(spark, kinds, firms, n):
    """The rounds end where a walk in order does."""
    rng = np.random.default_rng(kinds)
    a, b = rng.zipf(1.4, n) % kinds, rng.integers(0, firms, n)
    hits = list(zip(rng.permutation(n).tolist(), a.tolist(), [None if x == 0 else f"f{x}" for x in b]))
    df = spark.createDataFrame(pd.DataFrame(hits, columns=["rank", "kind", "firm"]), "rank long, kind long, firm string")
    got = {r["rank"]: r["sunk"] for r in search.cap_floods(df, "rank", "kind", "firm", 6, 10).collect()}
    kind, firm = Counter(), Counter()
    for rank, k, f in sorted(hits, key=lambda x: x[0]):
        sunk = kind[k] >= 6 or firm[f] >= 10
        assert got[rank] == sunk, rank
        if not sunk:
            kind[k] += 1
            firm[f] += 1
    assert len(got) == n


def test_draws_do_not_depend_on_how_groups_are_dealt(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, int(i % 4), float(x), float(x * 0.2 + y)) for i, (x, y) in enumerate(rng.normal(size=(200, 2)))], "k long, g int, s double, o double")
    whole = rows(strategy.permutation_p(df, ["k"], "g", "s", "o", 60))
    monkeypatch.setattr(strategy, "GROUP_ROWS", 10)
    (dealt,), (whole,) = rows(strategy.permutation_p(df, ["k"], "g", "s", "o", 60)), whole
    assert whole["p"] == dealt["p"] and whole["real"] == pytest.approx(float(np.mean([r["s"] * r["o"] for r in df.collect()])))


def test_vectors_of_other_lengths_do_not_meet(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=4 if i % 3 else 6).tolist()) for i in range(60)] + [(90, None), (91, []), (92, [0.0] * 4), (93, [1.0, None, 2.0, 3.0])]
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = rows(search.nearest(df.where("id in (1, 3, 91, 93)"), df, "id", "v", 5))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in data[:60]}
    for q in (1, 3):
        best = sorted((-float(unit[q] @ unit[i]), i) for i in unit if i != q and len(unit[i]) == len(unit[q]))[:5]
        assert [r["id"] for r in sorted((r for r in got if r["query"] == q), key=lambda r: r["rank"])] == [i for _, i in best]
    assert {r["query"] for r in got} == {1, 3}


def test_likeness_is_the_ratio_or_short_of_it():
    """Equal to SequenceMatcher at every least likeness, also beyond the length from which that leaves letters out; and much faster."""
    rng = random.Random(9)
    for _ in range(3000):
        letters = rng.choice(["ab", "abc ", "abcdefgh é", "漢字かな"])
        a, b = ("".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(2))
        if rng.random() < 0.3:
            b = a[: rng.randrange(len(a) + 1)] + b[:4] + a[rng.randrange(len(a) + 1) :]
        if rng.random() < 0.05:
            a, b = a * 9, b * 9
        ratio = SequenceMatcher(None, a, b).ratio()
        for least in (0.0, 0.6, ratio):
            assert passages.likeness(a, b, least) == (ratio if ratio >= least else -1.0)
    old, new = (". ".join("".join(rng.choices("ethrons ", k=150)) for _ in range(60)) + "." for _ in range(2))
    began = time.process_time()
    passages.redline(old, new)
    took = time.process_time() - began
    for a in old.split(". "):
        for b in new.split(". "):
            SequenceMatcher(None, a, b).ratio()
    assert took < (time.process_time() - began - took) / 2


def test_turn_redline_is_dealt_out_by_number(spark, sf_dir):
    """Few bytes of turns are long work: their partitions are not made fewer."""
    plan = registry.QUERIES["turn_redline"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


@pytest.mark.parametrize("pack", [20, 4096])
def test_redline_equals_all_ratios(monkeypatch, pack):
    """Bounds of many sentences at once, of those too long for it too."""
    monkeypatch.setattr(passages, "PACK", pack)
    rng = random.Random(10)
    make = lambda: "".join(rng.choices(rng.choice(["ab ", "abcdefgh é"]), k=rng.choice([1, 3, 10, 30, 210]))).strip() + "z" + rng.choice(".!?")
    for _ in range(200):
        old = [make() for _ in range(rng.randrange(8))]
        new = [rng.choice([make(), *old, *(o[: len(o) // 2] + "q" + o[len(o) // 2 :] for o in old)]) for _ in range(rng.randrange(8))]
        a, b = ([t[x:y] for x, y in passages.sentences(t)] for t in (" ".join(old), " ".join(new)))
        left, fresh, changed = [s for s in a if s not in b], [s for s in b if s not in a], 0
        for s in fresh:
            best = max(left, key=lambda o: SequenceMatcher(None, o, s).ratio(), default=None)
            if best is not None and SequenceMatcher(None, best, s).ratio() >= 0.6:
                left.remove(best)
                changed += 1
        assert passages.redline(" ".join(old), " ".join(new)) == {"kept": len(b) - len(fresh), "changed": changed, "added": len(fresh) - changed, "removed": len(left)}
