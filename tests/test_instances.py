"""XBRL instances of two layouts with dimensions, duplicates and defects."""

from __future__ import annotations

import datetime as dt

import pytest

from tidemark.sources import instances

A = """<?xml version="1.0" encoding="UTF-8"?>
<xbrli:xbrl xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" xmlns:ifrs="http://ifrs" xmlns:mx="http://mx" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:iso4217="http://iso">
<!-- a comment --><?pi x?>
<xbrli:context id="now"><xbrli:entity><xbrli:identifier scheme="s">ACME</xbrli:identifier></xbrli:entity><xbrli:period><xbrli:instant> 2024-03-31 </xbrli:instant></xbrli:period></xbrli:context>
<xbrli:context id="q1"><xbrli:entity><xbrli:identifier scheme="s">ACME</xbrli:identifier></xbrli:entity><xbrli:period><xbrli:startDate>2024-01-01</xbrli:startDate><xbrli:endDate>2024-03-31T00:00:00</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="q1s"><xbrli:entity><xbrli:identifier scheme="s">ACME</xbrli:identifier><xbrli:segment><xbrldi:explicitMember dimension="mx:Segment">mx:Retail</xbrldi:explicitMember><xbrldi:explicitMember dimension="mx:Area">mx:North</xbrldi:explicitMember></xbrli:segment></xbrli:entity><xbrli:period><xbrli:startDate>2024-01-01</xbrli:startDate><xbrli:endDate>2024-03-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:unit id="mxn"><xbrli:measure>iso4217:MXN</xbrli:measure></xbrli:unit>
<xbrli:unit id="eps"><xbrli:divide><xbrli:unitNumerator><xbrli:measure>iso4217:MXN</xbrli:measure></xbrli:unitNumerator><xbrli:unitDenominator><xbrli:measure>xbrli:shares</xbrli:measure></xbrli:unitDenominator></xbrli:divide></xbrli:unit>
<ifrs:Assets contextRef="now" unitRef="mxn" decimals="-3">1234000</ifrs:Assets>
<ifrs:Assets contextRef="now" unitRef="mxn" decimals="0">1234321</ifrs:Assets>
<ifrs:Revenue contextRef="q1" unitRef="mxn" decimals="0">500</ifrs:Revenue>
<ifrs:Revenue contextRef="q1" unitRef="mxn" decimals="0">501</ifrs:Revenue>
<ifrs:Revenue contextRef="q1s" unitRef="mxn" decimals="0">-20.5e1</ifrs:Revenue>
<ifrs:Eps contextRef="q1" unitRef="eps" decimals="2">1.25</ifrs:Eps>
<ifrs:Debt contextRef="now" unitRef="mxn" xsi:nil="true"/>
<mx:Discussion contextRef="q1">&lt;p&gt;Sales &amp;amp; more&lt;/p&gt;</mx:Discussion>
<mx:Broken contextRef="missing" unitRef="gone" decimals="INF">7</mx:Broken>
<mx:Word contextRef="q1" unitRef="mxn">n/a</mx:Word>
<mx:NoContext>9</mx:NoContext>
</xbrli:xbrl>"""
B = """<x xmlns="http://www.xbrl.org/2003/instance" xmlns:d="http://xbrl.org/2006/xbrldi" xmlns:g="urn:g"><g:Revenue contextRef="c" unitRef="u">3</g:Revenue><g:Revenue contextRef="c" unitRef="u">3</g:Revenue>
<unit id="u"><measure>USD</measure></unit><context id="c"><entity><identifier scheme="s">B</identifier></entity><period><startDate>2023-01-01</startDate><endDate>2023-12-31</endDate></period><scenario><d:typedMember dimension="g:Country"><g:c>MX</g:c></d:typedMember></scenario></context></x>"""
FILES = [("a", A), ("b", B), ("cut", A[: A.index("<ifrs:Eps")]), ("none", None), ("empty", ""), ("text", "no xml at all"), ("bare", "<a/>")]


@pytest.fixture(scope="module")
def rows(spark):
    return instances.flat(spark.createDataFrame(FILES, "k string, xml string"), "xml", "k").persist()


def test_facts(rows):
    got = {(r["k"], r["concept"], r["text"]): r for r in instances.facts(rows, "k").collect()}
    day = dt.date
    a = got["a", "Revenue", "-20.5e1"]
    assert a["value"] == -205 and a["dimensions"] == {"Segment": "Retail", "Area": "North"} and (a["period_start"], a["period_end"], a["instant"]) == (day(2024, 1, 1), day(2024, 3, 31), None)
    assert got["a", "Eps", "1.25"]["unit"] == "MXN/shares" and got["a", "Assets", "1234000"]["instant"] == day(2024, 3, 31) and got["a", "Assets", "1234000"]["entity"] == "ACME"
    assert got["a", "Debt", None]["nil"] and got["a", "Debt", None]["value"] is None and got["a", "Word", "n/a"]["value"] is None
    broken = got["a", "Broken", "7"]
    assert broken["value"] == 7 and broken["unit"] is None and broken["dimensions"] is None and broken["entity"] is None
    assert got["b", "Revenue", "3"]["dimensions"] == {"Country": "MX"} and got["b", "Revenue", "3"]["space"] == "urn:g" and got["b", "Revenue", "3"]["unit"] == "USD"
    assert not [k for k in got if k[1] == "NoContext"] and {k[0] for k in got} == {"a", "b", "cut"}
    assert {r["k"] for r in rows.where("kind = 'error'").collect()} == {"cut", "text"}


def test_duplicates_and_totals(rows):
    found = instances.distinct_facts(instances.facts(rows.where("k in ('a', 'b')"), "k"), "k")
    got = {(r["k"], r["concept"], bool(r["dimensions"])): (r["value"], r["copies"], r["conflicting"]) for r in found.collect()}
    assert got["a", "Assets", False] == (1234321.0, 2, False)  # the coarser one is the finer one rounded
    assert got["a", "Revenue", False] == (501.0, 2, True) and got["a", "Revenue", True] == (-205.0, 1, False) and got["b", "Revenue", True] == (3.0, 2, False)
    totals = {(r["k"], r["concept"]): r["value"] for r in instances.consolidated(found, "k").collect()}
    assert totals["a", "Revenue"] == 501.0 and totals["b", "Revenue"] == 3.0  # none without dimensions: the one with the fewest


def test_texts(rows):
    assert [tuple(r) for r in instances.text_blocks(rows.where("k = 'a'"), ["Discussion"], "k").collect()] == [("a", "Discussion", "Sales & more")]


def test_a_large_file_is_not_held():
    import tracemalloc

    body = "".join(f'<g:F{i % 50} contextRef="c" unitRef="u">{i}</g:F{i % 50}>' for i in range(200_000))
    xml = B[: B.index("<g:Revenue")].encode() + body.encode() + b"</x>"
    tracemalloc.start()
    assert sum(1 for _ in instances.walk(xml)) == 200_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20
