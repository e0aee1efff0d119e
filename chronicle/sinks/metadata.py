"""Metadata of a published table: column contract, CSVW schema, triples, Turtle, JSON-LD, pages.

The contract is a handful of rows. Triples are written by executors in a total order, so the same input gives
the same bytes; `turtle` and `json_ld` give the same texts for a few of them.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.functions.text import camel, camel_case
from chronicle.model import Model
from chronicle.sinks import tables

# Namespaces, the authority's address and names of datatypes, as the standards have them.
PREFIXES = {
    "dcat": "http://www.w3.org/ns/dcat#",
    "dct": "http://purl.org/dc/terms/",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
}
AUTHORITY = "http://publications.europa.eu/resource/authority/"
DATATYPES = {"string": "string", "bigint": "integer", "int": "integer", "double": "double", "boolean": "boolean", "timestamp": "dateTime"}


@dataclass(frozen=True)
class Column:
    name: str
    dtype: str
    nullable: bool = True
    unique: bool = False
    vocabulary: str | None = None
    origin: str = "derived"
    description: str = ""


def origin(name: str, model: Model, inferred: Sequence[str] = ()) -> str:
    """Where a published column comes from: upstream, derived, or inferred by a model."""
    if name in inferred:
        return "inferred"
    return "upstream" if export_field(name, model) in {f.column for f in model.fields} else "derived"


def export_field(name: str, model: Model) -> str:
    """The raw name of a published column."""
    return {v: k for k, v in model.renames.items()}.get(name, name)


def contract(schema: T.StructType, model: Model, inferred: Sequence[str] = (), unique: Sequence[str] = (), required: Sequence[str] = ()) -> list[Column]:
    """The contract of the published columns in their order."""
    said = {f.column: f.description for f in model.fields}
    out = []
    for f in schema.fields:
        raw = export_field(f.name, model)
        out.append(Column(f.name, f.dataType.simpleString(), f.name not in required, f.name in unique, f.name if f.name in model.vocabularies else None, origin(f.name, model, inferred), said.get(raw, "")))
    return out


def describe(spark: SparkSession, columns: Sequence[Column]) -> DataFrame:
    """The contract as a table."""
    rows = [(i, c.name, c.dtype, c.nullable, c.unique, c.vocabulary, c.origin, c.description) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "position int, name string, dtype string, nullable boolean, is_unique boolean, vocabulary string, origin string, description string")


def expand(curie: str) -> str:
    prefix, _, local = curie.partition(":")
    return PREFIXES[prefix] + local if prefix in PREFIXES else curie


def expanded(curie: SparkColumn) -> SparkColumn:
    """`expand` of a column's values."""
    known = F.create_map(*(F.lit(x) for pair in PREFIXES.items() for x in pair))
    return F.coalesce(F.concat(F.element_at(known, F.substring_index(curie, ":", 1)), F.regexp_extract(curie, "(?s)^[^:]*:(.*)$", 1)), curie)


def predicates(base: str, name: SparkColumn) -> SparkColumn:
    """`predicate` of a column's values, for names that aren't known."""
    return F.concat(F.lit(f"{base}#"), camel_case(name))


def authorities(scheme: str, code: SparkColumn) -> SparkColumn:
    """`authority` of a column's values."""
    return F.concat(F.lit(f"{AUTHORITY}{scheme}/"), code)


def predicate(base: str, name: str, known: Mapping[str, str] | None = None) -> str:
    """The property of a column: a known one, or else the table's own in camelCase."""
    return expand((known or {}).get(name, f"{base}#{camel(name)}"))


def authority(scheme: str, code: str) -> str:
    return f"{AUTHORITY}{scheme}/{code}"


def datatype_of(dtype: str) -> str:
    return DATATYPES.get(dtype, "json" if dtype.startswith(("array", "struct")) else "string")


def range_of(c: Column) -> str:
    return expand("skos:Concept") if c.vocabulary else expand("rdf:JSON") if datatype_of(c.dtype) == "json" else expand(f"xsd:{datatype_of(c.dtype)}")


def list_note(c: Column) -> str:
    """How a nested column is written in a cell; empty for a plain one."""
    if not c.dtype.startswith(("array", "struct", "map")):
        return ""
    kind = "objects" if "struct" in c.dtype else "values"
    return f"A JSON array of {kind}; an empty array if there are none." if c.dtype.startswith("array") else "A JSON object."


def vocab_note(c: Column, codes: Mapping[str, str], most: int = 12) -> str:
    """Which codes a closed column may hold: all of a few, or how many there are."""
    if not c.vocabulary or not codes:
        return ""
    names = sorted(codes)
    return f"One of {len(names)} codes" + (f": {', '.join(names)}." if len(names) <= most else f", from {names[0]} to {names[-1]}.")


def description_of(c: Column, codes: Mapping[str, str] | None = None) -> str:
    """What a column's description, its cells and its codes say together."""
    return " ".join(x for x in (c.description, list_note(c), vocab_note(c, codes or {})) if x)


def table_schema(columns: Sequence[Column], base: str, key: str, labels: Mapping[str, Mapping[str, str]] | None = None) -> dict:
    """CSVW."""
    cells = []
    for c in columns:
        codes = (labels or {}).get(c.vocabulary or "", {})
        cell = {"name": c.name, "titles": c.name, "datatype": datatype_of(c.dtype), "required": not c.nullable, "propertyUrl": predicate(base, c.name)}
        said = description_of(c, codes)
        cells.append(cell | ({"dc:description": said} if said else {}) | ({"valueUrl": f"{base}/{c.vocabulary}/{{{c.name}}}"} if c.vocabulary and not c.dtype.startswith("array") else {}))
    return {"@context": ["http://www.w3.org/ns/csvw", {"@language": "en"}], "tableSchema": {"primaryKey": key, "columns": cells}}


# ---------------------------------------------------------------- graphs

Triple = tuple[str, str, str, str, str | None, str | None]  # s, p, o, kind (iri, literal), language, datatype


def iri(s: str, p: str, o: str) -> Triple:
    return (s, expand(p), expand(o), "iri", None, None)


def literal(s: str, p: str, o: str, lang: str | None = None, datatype: str | None = None) -> Triple:
    return (s, expand(p), o, "literal", lang, expand(datatype) if datatype else None)


@dataclass(frozen=True)
class About:
    """What is said of a dataset; texts by language."""

    title: Mapping[str, str]
    description: Mapping[str, str] = field(default_factory=dict)
    keywords: Mapping[str, Sequence[str]] = field(default_factory=dict)
    publisher: str = ""
    licence: str = ""
    themes: Sequence[str] = ()
    languages: Sequence[str] = ()


def dataset_triples(uri: str, about: About, downloads: Mapping[str, tuple[str, int]]) -> list[Triple]:
    """The dataset and its distributions: name -> (media type, bytes)."""
    out = [iri(uri, "rdf:type", "dcat:Dataset"), literal(uri, "dct:publisher", about.publisher)]
    if about.licence:
        out.append(iri(uri, "dct:license", about.licence))
    out += [literal(uri, "dct:title", t, lang) for lang, t in sorted(about.title.items())]
    out += [literal(uri, "dct:description", t, lang) for lang, t in sorted((about.description or about.title).items())]
    out += [literal(uri, "dcat:keyword", w, lang) for lang, words in sorted(about.keywords.items()) for w in words]
    out += [iri(uri, "dcat:theme", authority("data-theme", t)) for t in about.themes]
    out += [iri(uri, "dct:language", authority("language", x)) for x in about.languages]
    for name, (media, size) in sorted(downloads.items()):
        d = f"{uri}/{name}"
        out += [iri(uri, "dcat:distribution", d), iri(d, "rdf:type", "dcat:Distribution"), iri(d, "dcat:downloadURL", f"{uri}/data/{name}"), literal(d, "dcat:mediaType", media), literal(d, "dcat:byteSize", str(size), datatype="xsd:integer")]
        if about.licence:
            out.append(iri(d, "dct:license", about.licence))
    return out


def vocabulary_triples(base: str, columns: Sequence[Column], codes: Mapping[str, Mapping[str, str]]) -> list[Triple]:
    """Properties of the columns, and a concept scheme for each vocabulary."""
    out: list[Triple] = []
    for c in columns:
        p = predicate(base, c.name)
        out += [iri(p, "rdf:type", "rdf:Property"), literal(p, "rdfs:label", c.name), iri(p, "rdfs:range", range_of(c))]
    for name, labels in sorted(codes.items()):
        scheme = f"{base}/{name}"
        out.append(iri(scheme, "rdf:type", "skos:ConceptScheme"))
        for code, label in sorted(labels.items()):
            out += [iri(f"{scheme}/{code}", "rdf:type", "skos:Concept"), iri(f"{scheme}/{code}", "skos:inScheme", scheme), literal(f"{scheme}/{code}", "skos:prefLabel", label)]
    return out


#: What each node of a class must say: property, whether it is a link or a text, how often at least and at most.
SHAPES: dict[str, Sequence[tuple[str, str, int, int | None]]] = {
    "dcat:Dataset": (("dct:title", "literal", 1, None), ("dct:description", "literal", 1, None), ("dct:publisher", "literal", 1, 1), ("dct:license", "iri", 0, 1), ("dcat:distribution", "iri", 1, None), ("dcat:theme", "iri", 0, None), ("dcat:keyword", "literal", 0, None)),
    "dcat:Distribution": (("dcat:downloadURL", "iri", 1, 1), ("dcat:mediaType", "literal", 1, 1), ("dcat:byteSize", "literal", 1, 1)),
    "rdf:Property": (("rdfs:label", "literal", 1, None), ("rdfs:range", "iri", 1, 1)),
    "skos:Concept": (("skos:inScheme", "iri", 1, 1), ("skos:prefLabel", "literal", 1, None)),
    "skos:ConceptScheme": (),
}


def conformance(triples: Sequence[Triple], shapes: Mapping[str, Sequence[tuple[str, str, int, int | None]]] = SHAPES) -> list[str]:
    """What the metadata breaks: missing or repeated properties, a text for a link or the reverse, several titles of one
    language, links to distributions and schemes that aren't there."""
    said: dict[tuple[str, str], list[Triple]] = {}
    for t in {*triples}:
        said.setdefault((t[0], t[1]), []).append(t)
    kind, out = expand("rdf:type"), []
    classes = {(t[0], t[2]) for t in triples if t[1] == kind}
    for name, rules in shapes.items():
        for node in sorted(s for s, o in classes if o == expand(name)):
            for prop, as_, least, most in rules:
                values = said.get((node, expand(prop)), [])
                if len(values) < least or (most is not None and len(values) > most):
                    out.append(f"{node}: {prop} stands {len(values)} times, expected {least} to {most or 'any'}")
                out += [f"{node}: {prop} is no {as_}" for v in values if v[3] != as_]
                out += [f"{node}: {prop} is empty" for v in values if not v[2]]
                languages = [v[4] for v in values if v[4]]
                if prop in ("dct:title", "dct:description", "skos:prefLabel") and len(languages) != len(set(languages)):
                    out.append(f"{node}: {prop} stands twice in one language")
    for prop, name in (("dcat:distribution", "dcat:Distribution"), ("skos:inScheme", "skos:ConceptScheme")):
        out += [f"{t[0]}: {prop} leads nowhere" for t in sorted({*triples}, key=str) if t[1] == expand(prop) and (t[2], expand(name)) not in classes]
    return out


def as_frame(spark: SparkSession, triples: Sequence[Triple]) -> DataFrame:
    return spark.createDataFrame(list(triples), "s string, p string, o string, kind string, lang string, datatype string").distinct()


def _term(o: str, kind: str, lang: str | None, datatype: str | None) -> str:
    if kind == "iri":
        return f"<{o}>"
    text = json.dumps(o, ensure_ascii=False)
    return f"{text}@{lang}" if lang else f"{text}^^<{datatype}>" if datatype else text


def turtle(triples: DataFrame) -> str:
    """In a total order, one subject after the other."""
    lines, last = [], None
    for r in triples.orderBy(*(F.asc_nulls_first(c) for c in ("s", "p", "o", "kind", "lang", "datatype"))).collect():
        lines.append(("" if last is None else " .\n\n") + f"<{r.s}>\n    " if r.s != last else " ;\n    ")
        lines.append(f"<{r.p}> {_term(r.o, r.kind, r.lang, r.datatype)}")
        last = r.s
    return "".join(lines) + (" .\n" if lines else "")


def _edges(triples: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The rows with whether they are the first and the last of their group; groups are counted up before they are joined."""
    least = triples.groupBy(*by).agg(F.min(F.struct(*order)).alias("__least"), F.max(F.struct(*order)).alias("__most"))
    own = F.struct(*order)
    joined = triples.join(least, list(by))
    return joined.withColumns({f"first_{name}": own.eqNullSafe(F.col("__least")), f"last_{name}": own.eqNullSafe(F.col("__most"))}).drop("__least", "__most")


def _ends(triples: DataFrame) -> tuple[str | None, str | None]:
    return tuple(triples.agg(F.min("s"), F.max("s")).first())


def write_turtle(triples: DataFrame, path: str) -> None:
    """`turtle` as a file, of any number of triples: sorted by ranges, written by executors."""
    if triples.isEmpty():
        return tables.write_text(triples.sparkSession, path, "")

    @F.pandas_udf("string")
    def term(o: pd.Series, kind: pd.Series, lang: pd.Series, datatype: pd.Series) -> pd.Series:
        none = lambda x: None if pd.isna(x) else x
        return pd.Series([_term(a, b, none(c), none(d)) for a, b, c, d in zip(o, kind, lang, datatype, strict=True)], dtype=object)

    order = ["s", "p", "o", "kind", "lang", "datatype"]
    rows = _edges(triples, ["s"], order[1:], "s")
    blank = F.when(F.col("s") == F.lit(_ends(triples)[0]), "").otherwise("\n")
    head = F.when(F.col("first_s"), F.concat(blank, F.lit("<"), "s", F.lit(">\n"))).otherwise("")
    line = F.concat(head, F.lit("    <"), "p", F.lit("> "), term("o", "kind", "lang", "datatype"), F.when(F.col("last_s"), " .").otherwise(" ;"))
    tables.write_lines(rows.withColumn("line", line).orderBy(*(F.asc_nulls_first(c) for c in order)).select("line"), path)


def write_json_ld(triples: DataFrame, path: str) -> None:
    """`json_ld` as a file, of any number of triples."""
    if triples.isEmpty():
        return tables.write_text(triples.sparkSession, path, "[]\n")

    def said(row) -> dict:
        return _node_value(row.o, row.kind, None if pd.isna(row.lang) else row.lang, None if pd.isna(row.datatype) else row.datatype)

    @F.pandas_udf("mark string, shown string, subject string, property string")
    def texts(s: pd.Series, p: pd.Series, o: pd.Series, kind: pd.Series, lang: pd.Series, datatype: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame({"s": s, "p": p, "o": o, "kind": kind, "lang": lang, "datatype": datatype})
        values = [said(r) for r in rows.itertuples()]
        shown = ["\n".join("      " + x for x in json.dumps(v, ensure_ascii=False, indent=2, sort_keys=True).split("\n")) for v in values]
        return pd.DataFrame({"mark": [json.dumps(v, sort_keys=True) for v in values], "shown": shown, "subject": [json.dumps(x, ensure_ascii=False) for x in s], "property": [json.dumps(x, ensure_ascii=False) for x in p]})

    first, last = _ends(triples)
    order = ["mark", "o", "kind", "lang", "datatype"]
    rows = triples.withColumn("t", texts("s", "p", "o", "kind", "lang", "datatype")).select("*", "t.*").drop("t")
    rows = _edges(_edges(rows, ["s"], ["p", *order], "s"), ["s", "p"], order, "p")
    head = F.when(F.col("first_s"), F.concat(F.when(F.col("s") == F.lit(first), "[\n").otherwise(""), F.lit('  {\n    "@id": '), "subject", F.lit(",\n"))).otherwise("")
    opened = F.when(F.col("first_p"), F.concat(F.lit("    "), "property", F.lit(": [\n"))).otherwise("")
    closed = F.when(F.col("last_p"), F.concat(F.lit("\n    ]"), F.when(F.col("last_s"), "").otherwise(","))).otherwise(",")
    tail = F.when(F.col("last_s"), F.when(F.col("s") == F.lit(last), "\n  }\n]").otherwise("\n  },")).otherwise("")
    line = F.concat(head, opened, "shown", closed, tail)
    tables.write_lines(rows.withColumn("line", line).orderBy(*(F.asc_nulls_first(c) for c in ("s", "p", *order))).select("line"), path)


def _node_value(o: str, kind: str, lang: str | None, datatype: str | None) -> dict:
    return {"@id": o} if kind == "iri" else {"@value": o} | ({"@language": lang} if lang else {}) | ({"@type": datatype} if datatype else {})


def json_ld(triples: DataFrame) -> str:
    """Nodes, properties and values sorted."""
    nodes: dict[str, dict] = {}
    for r in triples.collect():
        node = nodes.setdefault(r.s, {"@id": r.s})
        node.setdefault(r.p, []).append(_node_value(r.o, r.kind, r.lang, r.datatype))
    for node in nodes.values():
        for k, v in node.items():
            if k != "@id":
                v.sort(key=lambda x: json.dumps(x, sort_keys=True))
    return json.dumps([nodes[s] for s in sorted(nodes)], ensure_ascii=False, indent=2, sort_keys=True) + "\n"


def german_number(n: float, digits: int = 0) -> str:
    return f"{n:,.{digits}f}".translate(str.maketrans(",.", ".,"))


def german(x: SparkColumn, digits: int = 0) -> SparkColumn:
    """`german_number` of a column's values."""
    return F.translate(F.format_number(x, digits), ",.", ".,")


def measured(df: DataFrame) -> tuple[list[str], list[str]]:
    """The columns whose values are all different, and those without nulls: one row of counts for each column."""
    counts = [x for c in df.columns for x in (F.countDistinct(F.col(f"`{c}`")), F.count(F.col(f"`{c}`")))]
    n, *found = df.agg(F.count("*"), *counts).first()
    full = [c for i, c in enumerate(df.columns) if found[2 * i + 1] == n]
    return [c for i, c in enumerate(df.columns) if found[2 * i] == n], full


#: The pages' own words.
WORDS = {
    "en": {"downloads": "Downloads", "file": "File", "kind": "Type", "size": "Size", "licence": "Licence", "publisher": "Publisher", "keywords": "Keywords", "columns": "Columns", "vocabularies": "Vocabularies", "name": "Name", "type": "Type", "required": "Required", "origin": "Origin", "description": "Description", "code": "Code", "label": "Label", "yes": "yes", "no": "no", "bytes": "bytes"},
    "de": {"downloads": "Dateien", "file": "Datei", "kind": "Typ", "size": "Größe", "licence": "Lizenz", "publisher": "Herausgeber", "keywords": "Schlagwörter", "columns": "Spalten", "vocabularies": "Vokabulare", "name": "Name", "type": "Typ", "required": "Pflicht", "origin": "Herkunft", "description": "Beschreibung", "code": "Code", "label": "Bezeichnung", "yes": "ja", "no": "nein", "bytes": "Bytes"},
}


def number(n: float, lang: str) -> str:
    return german_number(n) if lang == "de" else f"{n:,.0f}"


def html_table(head: Sequence[str], rows: Sequence[Sequence[str]]) -> str:
    """Every cell is escaped."""
    e = html.escape
    cells = lambda tag, row: "".join(f"<{tag}>{e(str(x))}</{tag}>" for x in row)
    return f"<table><tr>{cells('th', head)}</tr>\n" + "".join(f"<tr>{cells('td', r)}</tr>\n" for r in rows) + "</table>\n"


def _page(about: About, sections: Callable[[str, Mapping[str, str]], str]) -> str:
    """A page with one section for each language of the title, in one document."""
    e = html.escape
    first = next(iter(about.title))
    body = "".join(f'<section lang="{e(x, quote=True)}"><h1>{e(about.title[x])}</h1>\n{sections(x, WORDS.get(x, WORDS["en"]))}</section>\n' for x in about.title)
    return f'<!doctype html>\n<html lang="{e(first, quote=True)}"><head><meta charset="utf-8"><title>{e(about.title[first])}</title></head>\n<body>{body}</body></html>\n'


def dataset_page(about: About, sizes: Mapping[str, tuple[str, int]], pages: Mapping[str, str]) -> str:
    """The dataset: what it is, whose, its files with type and size, and the other pages."""
    e = html.escape

    def section(lang: str, w: Mapping[str, str]) -> str:
        words = ", ".join(about.keywords.get(lang, ()))
        facts = [(w["publisher"], about.publisher), (w["licence"], about.licence), (w["keywords"], words)]
        listed = "".join(f'<li><a href="{e(n, quote=True)}">{e(n)}</a> ({e(kind)}, {number(size, lang)} {w["bytes"]})</li>\n' for n, (kind, size) in sorted(sizes.items()))
        others = "".join(f'<li><a href="{e(n, quote=True)}">{e(w[of])}</a></li>\n' for n, of in pages.items())
        return f"<p>{e(about.description.get(lang, ''))}</p>\n<dl>{''.join(f'<dt>{e(k)}</dt><dd>{e(v)}</dd>' for k, v in facts if v)}</dl>\n<h2>{e(w['downloads'])}</h2>\n<ul>{listed}</ul>\n<ul>{others}</ul>\n"

    return _page(about, section)


def columns_page(about: About, columns: Sequence[Column], labels: Mapping[str, Mapping[str, str]]) -> str:
    """The columns: type, whether always there, where from, what they say."""

    def section(_: str, w: Mapping[str, str]) -> str:
        rows = [(c.name, datatype_of(c.dtype), w["no"] if c.nullable else w["yes"], c.origin, description_of(c, labels.get(c.vocabulary or "", {}))) for c in columns]
        return f"<h2>{html.escape(w['columns'])}</h2>\n" + html_table([w[x] for x in ("name", "type", "required", "origin", "description")], rows)

    return _page(about, section)


def vocabularies_page(about: About, labels: Mapping[str, Mapping[str, str]]) -> str:
    """The codes of each vocabulary with their labels."""

    def section(_: str, w: Mapping[str, str]) -> str:
        parts = [f"<h3>{html.escape(name)}</h3>\n" + html_table([w["code"], w["label"]], sorted(codes.items())) for name, codes in sorted(labels.items())]
        return f"<h2>{html.escape(w['vocabularies'])}</h2>\n" + "".join(parts)

    return _page(about, section)
