"""Tables from word positions against a loop, on pages with skewed columns and split headers."""

from __future__ import annotations

import re

import pytest

from tidemark.operators import wordtables

SCHEMA = "page string, text string, x0 double, x1 double, top double"


def put(page, line, top, *words):
    """Words of a line: (text, x0, x1[, height off the line])."""
    return [(page, w[0], float(w[1]), float(w[2]), float(top + (w[3] if len(w) > 3 else 0))) for w in words]


WORDS = [
    *put("a", 0, 10, ("Income", 10, 50), ("statement", 54, 100)),
    *put("a", 1, 30, ("4Q", 150, 165), ("2023", 168, 190), ("4Q", 250, 265, 1), ("2024", 268, 290, 2)),
    *put("a", 2, 50, ("Net", 10, 30), ("sales", 33, 60), ("1,200", 155, 185), ("1,350", 262, 292)),
    *put("a", 3, 70, ("Cost", 10, 30), ("(800)", 160, 195), ("-900", 240, 270), ("12.5%", 400, 430)),  # the last is under no column
    *put("a", 4, 90, ("Note", 10, 30), ("without", 33, 60), ("figures", 65, 90)),
    *put("a", 5, 110, ("77", 160, 180), ("88", 260, 280)),  # no label
    *put("b", 0, 10, ("1Q", 150, 165), ("1Q", 250, 265)),  # years stand below their quarters
    *put("b", 1, 22, ("2023", 148, 170), ("2024", 247, 269)),
    *put("b", 2, 40, ("EBITDA", 10, 50, 0), ("5", 155, 160, 1), ("7", 258, 263, 2)),  # a slope
    *put("b", 3, 60, ("Between", 10, 50), ("9", 204, 211)),  # as far from both columns, and beyond reach of neither
    *put("c", 0, 10, ("No", 10, 20), ("header", 24, 60), ("3", 150, 155)),
    *put("d", 0, 10, ("2022", 100, 120), ("2023", 130, 150)),
    *put("d", 1, 30, ("Twice", 10, 40), ("4", 123, 127)),  # the right one of two as near
    ("d", None, 1.0, 2.0, 30.0), ("d", "  ", 1.0, 2.0, 30.0), ("d", "lost", None, 2.0, 30.0), ("d", "lost", 1.0, 2.0, None),
    (None, "Page", 1.0, 20.0, 5.0), (None, "6", 30.0, 35.0, 5.0),
]


def loop(words, line=3.0, gap=8.0, reach=25.0):
    pages, out = {}, []
    for w in words:
        if (w[1] or "").strip() and None not in w[2:]:
            pages.setdefault(w[0], []).append(w)
    period = lambda t: (f"{m[2]}Q{m[1]}" if (m := re.fullmatch(r"([1-4])Q (\d{4})", t)) else f"{t}FY" if re.fullmatch(r"\d{4}", t) else None)
    for page, ws in pages.items():
        lines, last = [], None
        for w in sorted(ws, key=lambda w: (w[4], w[2], w[1])):
            if last is None or w[4] - last > line:
                lines.append([])
            lines[-1].append(w)
            last = w[4]
        lines = [sorted(x, key=lambda w: (w[2], w[3], w[1])) for x in lines]
        celled = []
        for x in lines:
            celled.append([])
            for w in x:
                if celled[-1] and w[2] - celled[-1][-1][2] <= gap:
                    c = celled[-1][-1]
                    celled[-1][-1] = (c[0] + " " + w[1], c[1], max(c[2], w[3]))
                else:
                    celled[-1].append((w[1], w[2], w[3]))
        head, at = [], -1
        for i, x in enumerate(celled):
            found = []
            for c in x:
                under = max(((min(c[2], b[2]) - max(c[1], b[1]), b[0]) for b in (celled[i + 1] if i + 1 < len(celled) else []) if min(c[2], b[2]) > max(c[1], b[1])), default=None)
                if p := period(c[0]) or (period(f"{c[0]} {under[1]}") if under else None):
                    found.append((p, c[1], c[2]))
            if len(found) >= 2:
                head, at = found, i
                break
        for i, x in enumerate(lines):
            numeric = [bool(re.fullmatch(r"\$?\(?-?\d[\d.,]*\)?%?", w[1])) for w in x]
            if i <= at or True not in numeric or numeric[0]:
                continue
            label = " ".join(w[1] for w in x[: numeric.index(True)])
            for place, w in enumerate([w for w, n in zip(x, numeric) if n]):
                centre, best = (w[2] + w[3]) / 2, None
                for k, (p, a, b) in enumerate(head):
                    far = abs(centre - (a + b) / 2)
                    if a - reach <= centre <= b + reach and far <= reach and (best is None or (far, -k) < best[:2]):
                        best = (far, -k, p)
                out.append((page, i, label, place, w[1], best[2] if best else None))
    return out


def test_rows(spark):
    df = spark.createDataFrame(WORDS, SCHEMA)
    lined = wordtables.lines(df, ["page"])
    head = wordtables.headers(wordtables.cells(lined, ["page"]), ["page"])
    got = [tuple(r) for r in wordtables.rows(lined, head, ["page"]).select("page", "line", "label", "place", "figure", "period").collect()]
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    want = [w for w in loop(WORDS) if w[0] is not None]  # pages are known by their key
    assert sorted((g for g in got if g[0] is not None), key=key) == sorted(want, key=key)
    periods = {(r[0], r[4]): r[5] for r in got}
    assert periods["a", "1,200"] == "2023Q4" and periods["a", "12.5%"] is None and periods["b", "7"] == "2024Q1" and periods["d", "4"] == "2023FY"
    assert wordtables.rows(lined.limit(0), head, ["page"]).collect() == []


@pytest.mark.parametrize(
    "figures, known, want",
    [
        ({"a": 5.0, "b": 7.0}, {"a": 5000.0, "b": 7100.0}, (1000.0, 2)),
        ({"a": 5.0}, {"a": 5000.0}, (1.0, 0)),  # one row may be a fluke
        ({"a": 5.0, "b": 7.0, "c": 9.0}, {"a": 5000.0, "b": 7.0, "c": 9.1}, (1.0, 2)),
        ({"a": 5.0, "b": 7.0}, {"a": 5000.0, "b": 7.0}, (1.0, 1)),  # a tie goes to 1
        ({"a": 0.2, "b": 7.0}, {"a": 200.0, "b": 0.0}, (1.0, 0)),
        ({"a": -4000.0, "b": 3000.0}, {"a": -4.0, "b": 3.0}, (0.001, 2)),
        ({"a": 1.0}, {}, (1.0, 0)),
    ],
)
def test_scale_vote(spark, figures, known, want):
    read = spark.createDataFrame([("p", k, "2023FY", v) for k, v in figures.items()], "page string, label string, period string, value double")
    facts = spark.createDataFrame([(k, "2023FY", v) for k, v in known.items()], "label string, period string, value double")
    assert [tuple(r) for r in wordtables.scales(read, facts, ["page"]).collect()] == [("p", *want)]
