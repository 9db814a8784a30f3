"""Functions and operators on small hand-made rows."""

from __future__ import annotations

import importlib
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numeric, periods
from tidemark.functions import text as tx
from tidemark.operators import events, panel, passages, quality, search, stats, surprise, valuation
from tidemark.sources import readers
from tidemark.streaming import outbox


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_numeric_nulls(spark):
    null = F.lit(None).cast("double")
    r = one(spark, a=numeric.safe_div(F.lit(1.0), F.lit(0.0)), b=numeric.winsorize(null, 3.0), c=numeric.winsorize(F.lit(-9.0), 3.0), d=numeric.mean_of([F.lit(1.0), null, F.lit(3.0)]), e=numeric.mean_of([F.lit(1.0), null]), f=numeric.clean(F.lit(float("nan"))), g=numeric.kelly(F.lit(0.2), F.lit(1.0)), h=numeric.admit(F.lit(5.0), 5.0, None))
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h) == (None, None, -3.0, 2.0, None, None, 0.0, None)


@pytest.mark.parametrize("text, label", [("Report 1Q24 final", "2024-1T"), ("reporte 3T2023", "2023-3T"), ("Q4 2022", "2022-4T"), ("segundo trimestre de 2021", "2021-2T"), ("2020-2T", "2020-2T"), ("FY2019 annual", "2019-FY"), ("no period", None)])
def test_periods(spark, text, label):
    assert one(spark, p=periods.parse_period(F.lit(text))).p == label


def test_period_arithmetic(spark):
    r = one(spark, a=periods.index_label(F.lit(2024 * 4 + 3)), b=periods.label_index(F.lit("2024-4T")), c=periods.quarter_end(F.lit(2023 * 4)).cast("string"), d=periods.shift_label(F.lit("2024-FY"), -1), e=periods.label_index(F.lit("2024-FY")))
    assert (r.a, r.b, r.c, r.d, r.e) == ("2024-4T", 2024 * 4 + 3, "2023-03-31", "2023-FY", None)


@pytest.mark.parametrize("text, value", [("1.234,5", 1234.5), ("1,234.5", 1234.5), ("(123)", -123.0), ("12 %", 12.0), ("0,25", 0.25), ("abc", None), ("", None)])
def test_numbers(spark, text, value):
    assert one(spark, v=tx.parse_number(F.lit(text))).v == value


def test_text_functions(spark):
    r = one(spark, a=tx.words(F.lit("Ünï, two  THREE!")), b=tx.shingles(F.lit("a b c d"), 3), c=tx.shingles(F.lit("a b"), 3), d=tx.slugify(F.lit(" Año Nuevo! ")), e=tx.words(F.lit("...")))
    assert (r.a, r.b, r.c, r.d, r.e) == (["ünï", "two", "three"], ["a b c", "b c d"], [], "ano-nuevo", [])
    assert tx.query_terms("The state of the union", frozenset(("the", "of"))) == ["state", "union"] and tx.match_expression(["a", 'b"']) == '"a" OR "b"""'


def test_masked_sue_window(spark):
    rows = [("s", i, x, f) for i, (x, f) in enumerate([(1.0, 1), (2.0, 2), (1.5, 3), (30.0, 9), (2.5, 5), (3.0, 6)])]
    df = spark.createDataFrame(rows, "slug string, qi int, dx double, filed int")
    got = {r.qi: r.sue for r in df.select("qi", surprise.masked_sue("dx", "filed", ["slug"], "qi", 8, 3).alias("sue")).collect()}
    assert got[4] == pytest.approx(2.5 / 0.5) and got[1] is None


def test_tercile_edges(spark):
    df = spark.createDataFrame([(1, float(i), str(i)) for i in range(8)] + [(2, None, "x")], "p int, v double, k string")
    counts = df.select(surprise.quantile_buckets("v", "p", "k").alias("b")).groupBy("b").count().collect()
    assert {r.b: r["count"] for r in counts} == {1: 3, 2: 2, 3: 3, None: 1}


def test_alignment_is_strict(spark):
    sessions = spark.createDataFrame([("2024-01-02 08:30:00", "2024-01-02 15:00:00"), ("2024-01-03 08:30:00", "2024-01-03 15:00:00")], "o string, c string")
    ev = spark.createDataFrame([("2024-01-02 08:30:00",), ("2024-01-02 08:29:59",), ("2024-01-03 15:00:00",)], "ts string")
    got = [(r.t0, r.in_session) for r in events.align(ev, "ts", sessions, "o", "c").orderBy("ts").collect()]
    assert got == [(0, False), (1, True), (None, True)]


def test_many_to_one_refuses_repeats(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="repeats a key"):
        panel.many_to_one(left, right, ["k"]).collect()


def test_special_functions():
    assert stats.incomplete_beta(2, 3, 0.5) == pytest.approx(0.6875)
    assert stats.incomplete_beta(5.0, 0.5, 10 / (10 + 2.228138852**2)) == pytest.approx(0.05, abs=1e-6)


def test_median_and_breaks(spark):
    r = one(spark, a=quality.median_of(F.array(F.lit(3.0), F.lit(1.0), F.lit(2.0), F.lit(10.0))), b=quality.median_of(F.array().cast("array<double>")))
    assert (r.a, r.b) == (2.5, None)


def test_metric_language(spark):
    df = spark.createDataFrame([(6.0, 0.0, None)], "a double, b double, c double")
    r = df.select(valuation.compile_metric("a / b").alias("x"), valuation.compile_metric("-(a - 2) * 3").alias("y"), valuation.compile_metric("a + c").alias("z")).first()
    assert (r.x, r.y, r.z) == (None, -12.0, None)
    for bad in ("__import__('os')", "a ** 2", "a if b else c", "a.b"):
        with pytest.raises(ValueError):
            valuation.compile_metric(bad)


def test_passages():
    text = "# One\nFirst sentence here. Second one! Third?\n# Two\nOther text."
    parts = passages.chunks(text, 30, 10)
    assert {h for _, _, h in parts} == {"One", "Two"} and all(b - a <= 60 for a, b, _ in parts)
    words = passages.Lexicon(frozenset(("gain", "rose")), frozenset(("fell", "loss")), burdens=frozenset(("debt",)))
    tone = lambda t: passages.tone(t, words)
    assert tone("no gain at all, and in the end a loss") == -1.0 and tone("sales rose") == 1.0 and tone("") == 0.0
    assert tone("the debt of the group fell") == 1.0 and tone("debt did not fell") == -1.0 and tone("sales rose, later on in the year they fell") == 0.0
    assert passages.redline("A stays. B goes away now.", "A stays. B goes away soon. New line.") == {"kept": 1, "changed": 1, "added": 1, "removed": 0}
    assert passages.merge_spans([(5, 9), (0, 3), (3, 4)]) == [(0, 4), (5, 9)]
    assert passages.snippet_windows([(500, 510), (520, 530), (5000, 5001)], 6000) == [(380, 650), (4880, 5121)]
    assert passages.label_score("Total revenue", "total revenue") == 1.0 and passages.label_score("", "x") == 0.0


def test_fusion_and_caps(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], "id int, rank int")
    b = spark.createDataFrame([(2, 1)], "id int, rank int")
    got = {r.id: r.score for r in search.reciprocal_rank_fusion([(a, 1.0), (b, 0.5)]).collect()}
    assert got[2] == pytest.approx(1 / 62 + 0.5 / 61) and got[1] == pytest.approx(1 / 61)
    hits = spark.createDataFrame([(i, "c", f"k{i % 2}") for i in range(6)], "rank int, concept string, company string")
    sunk = {r["rank"]: r.sunk for r in search.cap_floods(hits, "rank", "concept", "company", 4, 2).collect()}
    assert [sunk[i] for i in range(6)] == [False] * 4 + [True] * 2


def test_sources(spark, tmp_path):
    import gzip

    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    for folder, v in (("a", 1.0), ("b", 2.0)):
        with gzip.open(tmp_path / folder / "acme_2024-1T.json.gz", "wt") as f:
            f.write('{"Revenue": [{"value": %s, "unit": "MXN", "instant": "2024-03-31", "dimensions": {"x": "y"}}]}' % v)
    facts = readers.explode_facts(readers.json_facts(spark, f"{tmp_path}/*/*.json.gz", r"/(\w)/(\w+)_([^/.]+)\.json", {"b": 0, "a": 1}), "value", "slug", "period", "source")
    r = facts.first()
    assert facts.count() == 1 and (r.slug, r.period, r.source, r.concept, r.value) == ("acme", "2024-1T", "b", "Revenue", 2.0)
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>T</title><link>L</link></item></channel></rss>")
    assert readers.feed(spark, f"{tmp_path}/feed.xml").first().title == "T"
    page = spark.createDataFrame([(1, "<table><tr><th>A</th><td>1 <b>x</b></td></tr></table>")], "id int, html string")
    assert readers.html_table_rows(page, "html", "id").first().cells == ["A", "1 x"]
    assert readers.markdown([(1, None)], ("a", "b")).splitlines() == ["| a | b |", "| - | - |", "| 1 |  |"]
    wide, refused = readers.eav_pack(spark.createDataFrame([("e", "peer", "pe", "FY", None, None, None, 3.0), ("", "peer", "pe", "FY", None, None, None, 3.0), ("e", "peer", "zz", "FY", None, None, None, 3.0)], readers.PACK), ["pe"])
    assert wide.first().pe == 3.0 and {r.why for r in refused.collect()} == {"no entity", "unknown field"}


def test_outbox_stream(spark, tmp_path):
    rows = [(i, "doc", f"k{i % 3}", f"2024-01-01 00:00:0{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "event_id int, event_type string, dedupe_key string, created_at string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    subs = spark.createDataFrame([("index", "doc", 1, True), ("mail", "doc", 1, False)], "consumer_id string, event_type string, priority int, enabled boolean")
    seen = []
    q = outbox.run_outbox(stream, subs, {"index": lambda b, e: seen.extend(r.dedupe_key for r in b.collect())}, f"{tmp_path}/state")
    q.awaitTermination()
    assert sorted(seen) == ["k0", "k1", "k2"]
    r = one(spark, a=outbox.retry_delay(F.lit(1)), b=outbox.retry_delay(F.lit(3)), c=outbox.retry_delay(F.lit(50)))
    assert (r.a, r.b, r.c) == (30.0, 120.0, 3600.0)


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.entry(spark).count() > 0
    assert math.isfinite(len(entry.queries()))


def test_mmr_over_whole_groups(spark, sf_dir):
    import numpy as np

    from tidemark.operators import search
    from tidemark.plans import registry

    def brute(rows, k):
        rows = sorted(rows)
        x = np.array([v for _, _, v in rows], dtype=float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        s, chosen = np.array([r[1] for r in rows], dtype=float), []
        while len(chosen) < min(k, len(rows)):
            gain = 0.5 * s - 0.5 * ((x @ x[chosen].T).max(axis=1) if chosen else 0.0)
            gain[chosen] = -np.inf
            chosen.append(int(np.argmax(gain)))
        return [rows[i][0] for i in chosen]

    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    groups = {}
    for r in e:
        groups.setdefault(r["label"], []).append((r["vec_id"], r["embedding"][0], list(r["embedding"])))
    want = {(g, key, n) for g, rows in groups.items() for n, key in enumerate(brute(rows, 3), 1)}
    assert {(r["label"], r["vec_id"], r["pick"]) for r in registry.QUERIES["mmr_sentences"](spark, sf_dir).collect()} == want
    small = spark.createDataFrame([(None, 1, 0.5, [1.0, 0.0]), (None, 2, 0.5, [1.0, 0.0]), ("a", 3, 0.1, [0.0, 0.0])], "g string, k int, s double, v array<double>")
    assert sorted(map(tuple, search.greedy_mmr(small, "g", "k", "s", "v", 3).collect()), key=str) == [("a", 3, 1), (None, 1, 1), (None, 2, 2)]


def test_sheet_formulas_are_strict(spark):
    from tidemark.operators.audit import sheet_formula

    for bad in ("=A1", "=OFFSET(A,1)", "=__import__('os')", "='x'", "=A.b", "=[A]"):
        with pytest.raises((ValueError, SyntaxError)):
            sheet_formula(bad)
    row = spark.createDataFrame([(2.0, 0.0, None)], "A double, B double, C double")
    got = row.select(*[sheet_formula(f) for f in ("=A/B", "=SUM(A:C)", "=A+C", "=COUNT(A:C)", "=IF(A<>2,1,-ABS(A)^2)", "=ROUND(A/3,2)", "=MIN(A:C)")]).first()
    assert list(got) == [None, 2.0, None, 2.0, 4.0, 0.67, 0.0]


def test_filters_join(spark):
    from tidemark.operators.filters import Filter

    df = spark.range(20).selectExpr("id", "id % 4 as k", "concat('Name ', id) as name")
    f = Filter(values={"k": [1, 2]}, least={"id": 5}) & Filter(values={"k": [2, 3]}, patterns={"name": "name 1"})
    assert [r["id"] for r in f.apply(df).collect()] == [10, 14, 18]
    assert Filter().apply(df).count() == 20
