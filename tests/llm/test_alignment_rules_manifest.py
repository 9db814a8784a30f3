"""Token alignment, quality rules and the Merkle manifest against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import ROWS, SCHEMA, TEXTS, clash, none, odd, run  # noqa: F401
from tidemark.llm import alignment, common, merkle, queries, rules

A, B = (lambda: common.tokenizer_path("byte_bpe_50k.json")), (lambda: common.tokenizer_path("piece_bpe_32k.model"))
STRANGE = ["<|endoftext|> and <s> and <0x41>", "a  b \n c\t\td", "ﬁne ½ x́", "one ▁ two", "\x00 nul", "😀😀 漢字漢字", " led", "trailed ", "\n\n\nx", "z" * 700, "=" * 3000 + " -" * 900, "​ x　y", "end\r\n"]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


# alignment


def aligned(rows):
    """A walk over both token lists with two counters."""
    import sentencepiece
    from tokenizers import Tokenizer

    ta, sp = Tokenizer.from_file(A()), sentencepiece.SentencePieceProcessor(model_file=B())
    ta.encode_special_tokens = True
    bytes_a, bytes_b = alignment.bytes_a(A()), alignment.bytes_b(B())
    docs, counts = [], Counter()
    for doc_id, text in rows:
        spaced = (" " + (text or "")).encode()
        a, b = (ta.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        if b"".join(bytes_a[i] for i in a) != spaced or b"".join(bytes_b[i] for i in b) != spaced:
            a, b = [], []
        place = {}
        for side, ids, known in ((0, a, bytes_a), (1, b, bytes_b)):
            at = 0
            for i in ids:
                for byte in range(at, at + len(known[i])):
                    place.setdefault(byte, [None, None])[side] = (at, i)
                at += len(known[i])
        links = list(dict.fromkeys((x, y) for x, y in place.values()))
        links = [(x[1], y[1]) for x, y in links]
        both = {x[0] for x, _ in place.values()} & {y[0] for _, y in place.values()}
        groups, seen = [], set()
        for byte in sorted(place):
            (sa, ia), (sb, ib) = place[byte]
            if byte in both:
                groups.append(([], []))
            for side, start, i in ((0, sa, ia), (1, sb, ib)):
                if (side, start) not in seen:
                    seen.add((side, start))
                    groups[-1][side].append(str(i))
        counts.update(links)
        docs.append((doc_id, a, b, links, ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (d, len(a), len(b), g.count(";") + 1 if g else 0, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), sha256(g.encode()).hexdigest() if g else "")
        for d, a, b, ls, g in docs
    ]


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, odd, clash, none, monkeypatch, small):  # noqa: F811
    """``small``: blocks, rows and the broadcast are so small that documents and pairs take every other way."""
    if small:
        for name, value in {"BLOCK": 64, "ROW_LINKS": 50, "FREQUENT": 40, "COUNTED": 20}.items():
            monkeypatch.setattr(alignment, name, value)
    docs = odd.unionByName(spark.createDataFrame([(100 + i, t, "en", "s", 1) for i, t in enumerate(STRANGE)], SCHEMA))
    want = ordered(aligned([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert ordered(alignment.op11(spark, docs).collect()) == want
    assert len(run(alignment.op11, spark, clash)) == len(ROWS) and run(alignment.op11, spark, none) == []


def test_alignment_query(spark, sf_dir):
    got = queries.QUERIES["op11_alignment"](spark, sf_dir).collect()
    assert ordered(got) == ordered(aligned([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]))


# quality rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_measures(spark, odd, clash, none):  # noqa: F811
    texts = ["a b c a b c", "a b c b a b c", "x x x x", "x x x", "l\nl\n \n l\nl", "# * $ % & | < >", "one\x0btwo\x0cthree\r\nfour\x0b\n\x0b\n", "a b c d\na b c e\na b c d", "e f\x85g\xa0h"]
    docs = odd.unionByName(spark.createDataFrame([(200 + i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA))
    got = rules.measures(docs).select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert ordered(got) == ordered((r["doc_id"], *measured(r["text"])) for r in docs.collect())
    assert rules.measures(clash).count() == len(ROWS) and rules.measures(none).count() == 0


def test_quality_rules_query(spark, sf_dir):
    out = run(queries.QUERIES["op12_quality_rules"], spark, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"] for r in out} == set(texts)
    for r in out:
        n, chars, symbols, lines, repeats = measured(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n) and r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_rules_hold_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = rules.judge(spark, docs, labels.where("doc_id % 3 > 0")).where("not base_failed").join(labels.where("doc_id % 3 = 0"), F.col("id") == labels["doc_id"])
    n = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.1 * n[0, False]


def test_rules_find_conjunctions_in_order(spark):
    """Junk: many symbols with few words, or mostly capitals; a decoy condition that only fits the growing rows is pruned."""
    rows = []
    for i in range(3000):
        symbols, capitals, words = (i % 2) * 100, (i // 2 % 10) * 10, 100 + 400 * (i // 20 % 2)
        junk = symbols > 50 and words < 300 or capitals >= 80
        rows.append((i, words, words * 5, symbols * words // 100, 0, capitals * words * 5 // 100, 0, 5, 0, words, 10, 0, junk))
    cols = "id, n_words, word_chars, n_symbols, n_repeat_words, n_capitals, n_exclamations, n_stops, n_digits, n_distinct, n_lines, n_dup_lines"
    df = spark.createDataFrame(rows, ", ".join(f"{c.strip()} long" for c in cols.split(",")) + ", junk boolean")
    found = rules.learn(df)
    assert all(len(r.conditions) <= 3 for r in found)
    hit = df.withColumn("rule", rules.first_rule(found))
    assert hit.where("junk != (rule is not null)").count() == 0
    assert any(len(r.conditions) > 1 for r in found)


def test_rules_without_labels(spark, odd, clash, none):  # noqa: F811
    labels = spark.createDataFrame([(None, 0), (1, None), (4, 0), (4, 1), (7, 0)], "doc_id long, quality int")
    for docs, table in ((odd, labels), (odd, labels.limit(0)), (clash, labels)):
        out = run(rules.op12, spark, docs, table)
        assert len(out) == len(ROWS) and all(r["kept"] == (not r["base_failed"]) for r in out)
    assert run(rules.op12, spark, none, labels) == []


def test_rules_are_native(spark, sf_dir):
    plan = queries.QUERIES["op12_quality_rules"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|ExistingRDD", plan)


# manifest


def proved(rows):
    """Trees, proofs and folds by plain lists."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    h = lambda s: sha256(s.encode()).hexdigest()

    def leaf(r, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    langs = defaultdict(list)
    for r in rows:
        langs[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in sorted(langs[x], key=lambda r: r[:3])]) for x in order}
    top, out = tree([trees[x][-1][0] for x in order]), []
    for i, lang in enumerate(order):
        for j, (_, _, digest, r) in enumerate(sorted(langs[lang], key=lambda r: r[:3])):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None
            folded, beside = leaf(r, r["text"].translate(low)) if tampered else digest, ""
            for levels, k in ((trees[lang], j), (top, i)):
                for level in levels[:-1]:
                    start = k // 8 * 8
                    left, right = "".join(level[start:k]), "".join(level[k + 1 : start + 8])
                    folded, beside, k = h(left + folded + right), beside + left + right, k // 8
            root = top[-1][0]
            out.append((r["doc_id"], digest, trees[lang][-1][0], root, h(beside), folded, folded == root))
    return out


def test_manifest(spark, odd, clash, none):  # noqa: F811
    want = ordered(proved([r.asDict() for r in odd.collect()]))
    assert ordered(merkle.op13(spark, odd).collect()) == want == ordered(merkle.op13(spark, clash).collect())
    assert run(merkle.op13, spark, none) == []


@pytest.mark.parametrize("n, langs", [(1, 1), (8, 1), (9, 1), (64, 1), (65, 1), (1500, 3), (700, 600), (90, 9), (1025, 2)])
def test_manifest_shapes(spark, n, langs):
    """Runs that end full, one over, over many partitions; languages that fill several levels, one of them null, hot ones, repeated rows."""
    rows = [(i // 2 * 2 if i % 50 == 0 else i, f"Text {i}" if i % 7 else None, None if i % langs == 1 else f"é{i % langs}" if i % 3 or langs > 50 else "hot", "s", i) for i in range(n)] + [(3, "Same", "hot", "s", 1)] * (n // 3)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert ordered(merkle.op13(spark, docs).collect()) == ordered(proved([r.asDict() for r in docs.collect()]))


def test_manifest_query(spark, sf_dir):
    got = queries.QUERIES["op13_merkle_manifest"](spark, sf_dir).collect()
    assert ordered(got) == ordered(proved([r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]))
