"""XBRL instances as they are filed: facts under any element name, contexts with dimensions, units, text blocks.

A pull parser walks each file once and hands on flat rows as it meets them, so a file's tree is never held; what refers to
what is joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Namespaces of the instance, of dimensions and of the nil attribute.
XBRLI, XBRLDI, XSI = "http://www.xbrl.org/2003/instance", "http://xbrl.org/2006/xbrldi", "http://www.w3.org/2001/XMLSchema-instance"
FLAT = "kind string, ref string, name string, space string, text string, unit string, decimals string, nil boolean, start string, end string, instant string, entity string, dimensions map<string,string>"


def _local(tag: str) -> tuple[str, str]:
    """(namespace, local name)."""
    space, _, name = tag.rpartition("}")
    return space.lstrip("{"), name


def _text(e) -> str:
    return "".join(e.itertext()).strip()


def _bare(name: str) -> str:
    """A qualified name without its prefix, which each file chooses for itself."""
    return name.strip().rpartition(":")[2]


def _row(kind: str, ref=None, name=None, space=None, text=None, unit=None, decimals=None, nil=None, start=None, end=None, instant=None, entity=None, dimensions=None) -> tuple:
    return kind, ref, name, space, text, unit, decimals, nil, start, end, instant, entity, dimensions


def _context(e) -> tuple:
    found: dict = {"start": None, "end": None, "instant": None, "entity": None}
    dimensions = []
    for x in e.iter():
        space, name = _local(x.tag) if isinstance(x.tag, str) else ("", "")
        if space == XBRLDI and name == "explicitMember":
            dimensions.append((_bare(x.get("dimension", "")), _bare(_text(x))))
        elif space == XBRLDI and name == "typedMember":
            dimensions.append((_bare(x.get("dimension", "")), _text(x)))
        elif name in ("startDate", "endDate", "instant", "identifier"):
            found[{"startDate": "start", "endDate": "end", "instant": "instant", "identifier": "entity"}[name]] = _text(x)[:10] if name != "identifier" else _text(x)
    return _row("context", ref=e.get("id"), dimensions=sorted(dict(dimensions).items()), **found)


def _unit(e) -> tuple:
    parts = {"": []}
    part = ""
    for x in e.iter():
        name = _local(x.tag)[1] if isinstance(x.tag, str) else ""
        if name in ("unitNumerator", "unitDenominator"):
            part = name
            parts[part] = []
        elif name == "measure":
            parts[part].append(_bare(_text(x)))
    over, under = parts.get("unitNumerator", parts[""]), parts.get("unitDenominator", [])
    return _row("unit", ref=e.get("id"), name="*".join(over) + ("/" + "*".join(under) if under else ""))


def walk(xml: str | bytes | None) -> Iterator[tuple]:
    """Rows of ``FLAT`` of one file; a file that is no XML gives what could be read and a row of kind error."""
    from xml.etree import ElementTree as X

    if not xml:
        return
    parser = X.XMLPullParser(events=("start", "end"))
    depth, top = 0, None
    data = xml.encode() if isinstance(xml, str) else xml
    try:
        for at in range(0, len(data), 1 << 16):
            parser.feed(data[at : at + (1 << 16)])
            for event, e in parser.read_events():
                if event == "start":
                    depth += 1
                    top = e if depth == 1 else top
                    continue
                depth -= 1
                if depth != 1:
                    continue
                space, name = _local(e.tag) if isinstance(e.tag, str) else ("", "")
                if space == XBRLI and name == "context":
                    yield _context(e)
                elif space == XBRLI and name == "unit":
                    yield _unit(e)
                elif e.get("contextRef") is not None:
                    nil = e.get(f"{{{XSI}}}nil") in ("true", "1")
                    yield _row("fact", ref=e.get("contextRef").strip(), name=name, space=space, text=None if nil else _text(e), unit=e.get("unitRef"), decimals=e.get("decimals"), nil=nil)
                top.clear()  # what was handed on is forgotten
        parser.close()
    except X.ParseError as error:
        yield _row("error", text=str(error))


def flat(df: DataFrame, xml: str, *keys: str) -> DataFrame:
    """(keys, ``FLAT``) of the instances in a column of texts or bytes."""
    rows = df.select(*keys, xml)
    schema = StructType([*df.select(*keys).schema.fields, *StructType.fromDDL(FLAT).fields])
    n = len(keys)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def packed(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        out: list = []
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                for found in walk(row[n]):
                    out.append((*row[:n], *found))
                    if len(out) == 5000:
                        yield packed(out)
                        out = []
        if out:
            yield packed(out)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(run, schema)


def facts(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, concept, space, value, text, unit, decimals, nil, period_start, period_end, instant, entity, dimensions) from ``flat``.

    Value is the number of a fact with a unit; facts without one are texts. A reference to a context or unit that the file
    lacks leaves those columns null; of ids given twice the first by its content counts.
    """
    def once(kind: str, *columns: str) -> DataFrame:
        w = Window.partitionBy(*keys, "ref").orderBy(*[F.col(c) if c != "dimensions" else F.map_entries(c) for c in columns])
        return rows.where(F.col("kind") == kind).withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*keys, F.col("ref").alias(f"_{kind}"), *columns)

    contexts = once("context", "start", "end", "instant", "entity", "dimensions")
    units = once("unit", "name").withColumnRenamed("name", "measure")
    f = rows.where("kind = 'fact'").select(*keys, F.col("name").alias("concept"), "space", "text", F.col("unit").alias("_unit"), "decimals", "nil", F.col("ref").alias("_context"))
    out = f.join(contexts, [*keys, "_context"], "left").join(units, [*keys, "_unit"], "left")
    value = F.when(F.col("_unit").isNotNull(), F.expr("try_cast(replace(text, ',', '') as double)"))
    return out.select(*keys, "concept", "space", value.alias("value"), "text", F.col("measure").alias("unit"), "decimals", "nil", F.expr("try_cast(start as date)").alias("period_start"), F.expr("try_cast(end as date)").alias("period_end"), F.expr("try_cast(instant as date)").alias("instant"), "entity", "dimensions")


def distinct_facts(found: DataFrame, *keys: str) -> DataFrame:
    """One row per (keys, concept, dates, unit, dimensions) with copies, conflicting and the value given to most decimals.

    A fact repeated with the same number is one fact; with different ones it is conflicting unless the coarser is the finer
    one rounded to its decimals.
    """
    finest = F.coalesce(F.when(F.upper("decimals") == "INF", F.lit(99)).otherwise(F.expr("try_cast(decimals as int)")), F.lit(-99))
    by = [*keys, "concept", "unit", "period_start", "period_end", "instant", F.map_entries("dimensions").alias("_m")]
    told = found.where("value is not null").withColumn("_d", finest)
    g = told.groupBy(*by).agg(F.max_by("value", F.struct("_d", "value")).alias("_best"), F.collect_set(F.struct("_d", "value")).alias("_all"), F.count("*").alias("copies"), F.any_value("dimensions").alias("dimensions"))
    at = lambda x: F.when(x["_d"].between(-15, 15), F.round(F.col("_best") * F.pow(F.lit(10.0), x["_d"])) / F.pow(F.lit(10.0), x["_d"])).otherwise(F.col("_best"))
    conflict = F.exists("_all", lambda x: F.abs(x["value"] - at(x)) > 1e-9 * F.greatest(F.lit(1.0), F.abs(x["value"])))
    return g.select(*keys, "concept", F.col("_best").alias("value"), "unit", "period_start", "period_end", "instant", "dimensions", "copies", conflict.alias("conflicting"))


def consolidated(found: DataFrame, *keys: str) -> DataFrame:
    """Facts without dimensions; of a concept, period and unit that has none of those, the ones with the fewest."""
    w = Window.partitionBy(*keys, "concept", "unit", "period_start", "period_end", "instant")
    size = F.coalesce(F.size("dimensions"), F.lit(0))
    return found.withColumn("_s", size).withColumn("_m", F.min("_s").over(w)).where("_s = _m").drop("_s", "_m")


def text_blocks(rows: DataFrame, names: Sequence[str], *keys: str) -> DataFrame:
    """(keys, name, text) of the facts without a unit of the given names, their markup taken out."""
    from ..functions.text import strip_html

    found = rows.where((F.col("kind") == "fact") & F.col("unit").isNull() & F.col("name").isin(list(names)) & F.col("text").isNotNull())
    return found.select(*keys, "name", strip_html(F.col("text")).alias("text"))
