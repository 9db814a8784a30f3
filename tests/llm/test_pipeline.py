"""The pipeline stage by stage against brute force on the small tables."""

from __future__ import annotations

import re

import corpus_pipeline as cp
from tidemark.llm import common, lines, mixing, simhash, toxicity

from .test_operators import LONG, ROWS, RUN, SCHEMA, brute_lines, check_packing, union_find


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stage = dict(cp.STAGES)
    assert list(stage) == ["toxicity", "line_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    scratch = common.Scratch(spark, "test")

    a = scratch.save(stage["toxicity"](spark, docs, sf_dir), "a")
    model = toxicity.fit(docs, labels)
    clean = {r["doc_id"] for r in docs.collect() if 1 / (1 + __import__("math").exp(-toxicity.window_logits(r["text"] or "", model["scalars"], model["bias"]).max())) < toxicity.THRESHOLD}
    assert a.columns == docs.columns and {r["doc_id"] for r in a.collect()} == clean

    b = scratch.save(stage["line_dedup"](spark, a, sf_dir), "b")
    before = {r["doc_id"]: r["text"] or "" for r in a.collect()}
    after = {r["doc_id"]: r["text"] for r in b.collect()}
    gone = brute_lines(before)
    assert b.columns == docs.columns
    for i, t in before.items():
        left = len(lines.text_lines(t)) - gone[i]
        assert (i in after) == (left > 0 or gone[i] == 0)
        assert i not in after or len(lines.text_lines(after[i])) == left

    c = scratch.save(stage["simhash_near_dedup"](spark, b, sf_dir), "c")
    prints = {i: simhash.fingerprint(t) for i, t in after.items()}
    ids = sorted(prints)
    root = union_find([(x, y) for k, x in enumerate(ids) for y in ids[k + 1 :] if bin(prints[x] ^ prints[y]).count("1") <= 4])
    assert c.columns == docs.columns and sorted(r["doc_id"] for r in c.collect()) == [i for i in ids if root.get(i, i) == i]

    d = scratch.save(stage["source_mixing"](spark, c, sf_dir), "d")
    taken = {r["doc_id"]: r["taken"] for r in mixing.op10(spark, c).collect()}
    words: dict[int, int] = {}
    for r in d.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(common.WORD_PATTERN, r["text"]))
    assert d.columns == docs.columns and words == {i: n for i, n in taken.items() if n}

    e = [r.asDict() for r in stage["best_fit_packing"](spark, d, sf_dir).collect()]
    used, bound = check_packing(e, [(r["doc_id"], r["text"]) for r in d.collect()])
    assert used <= bound * 1.05 + 1


def test_run_and_empty(spark, sf_dir, tmp_path):
    assert cp.run(spark, sf_dir).count() > 0
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, f in cp.STAGES:
        out = f(spark, empty, sf_dir)
        assert out.count() == 0


def test_near_copies_by_row(spark):
    """Null and repeated ids: every group of near copies keeps one row, whatever the ids are."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    texts = [(None, 1), (None, 2), (None, 2), (5, 3), (5, 4), (5, 4), (7, 4), (3, 3), (None, 4), (None, 5), (9, 5)]
    df = spark.createDataFrame([(i, words(k), "en", "s", 1) for i, k in texts], "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(cp.STAGES)["simhash_near_dedup"](spark, df, "")
    assert out.columns == df.columns
    assert sorted((r["text"], r["doc_id"] or 0) for r in out.collect()) == [(words(1), 0), (words(2), 0), (words(3), 3), (words(4), 5), (words(5), 9)]


def test_awkward_rows(spark, sf_dir):
    """Nulls in any column, repeated ids with other texts, ties, a very long text, repeated rows and extra columns, stage by stage."""
    rows = [(*r, "x") for r in [*ROWS, *ROWS[-2:], (None, None, None, None, None), (6, "another text under an id that is taken", None, None, None), (20, "word " * 60_000, "en", "s1", None)]]
    docs = spark.createDataFrame(rows, SCHEMA + ", id string")
    stage = dict(cp.STAGES)
    texts = lambda df: sorted(str(r["text"]) for r in df.collect())

    a = stage["toxicity"](spark, docs, sf_dir)
    assert a.columns == docs.columns and texts(a) == texts(docs)

    b = stage["line_dedup"](spark, docs, sf_dir)
    assert b.columns == docs.columns and b.count() == len(rows)  # nothing was emptied
    kept = texts(b)
    assert sum(RUN.split("\n")[2] in t for t in kept) == 1 and "head\ntail" in kept

    c = stage["simhash_near_dedup"](spark, b, sf_dir)
    after = [r.asDict() for r in b.collect()]
    prints = [simhash.fingerprint(r["text"]) for r in after]
    root = union_find([(x, y) for x in range(len(after)) for y in range(x) if bin(prints[x] ^ prints[y]).count("1") <= 4])
    groups: dict[int, list[dict]] = {}
    for k, r in enumerate(after):
        groups.setdefault(root.get(k, k), []).append(r)
    got = [r.asDict() for r in c.collect()]
    assert c.columns == docs.columns and len(got) == len(groups)
    for g in groups.values():  # one row of each group, with its smallest id, null last
        assert sum(r in g and r["doc_id"] == min((x["doc_id"] for x in g if x["doc_id"] is not None), default=None) for r in got) == 1
    assert any(r["doc_id"] is None and r["text"] == "no id here" for r in got)

    d = stage["source_mixing"](spark, c, sf_dir)
    whole = [r["text"] or "" for r in got]
    mixed = [r.asDict() for r in d.collect()]
    assert d.columns == docs.columns and all(any(t.startswith(r["text"]) for t in whole) and r["n_chars"] == len(r["text"]) for r in mixed)
    sizes = lambda ts: sum(len(re.findall(common.WORD_PATTERN, t)) for t in ts)
    assert abs(sizes(r["text"] for r in mixed) - sizes(whole)) <= 4  # a word a source at most

    e = [r.asDict() for r in stage["best_fit_packing"](spark, d, sf_dir).collect()]
    assert max(r["length"] for r in e) <= 1024 and {r["doc_id"] for r in e} == {r["doc_id"] for r in mixed}
    assert max(len(t) for t in whole) >= len(LONG) // 2
