"""Trees of XML documents as DataFrames.

Files are read as whole texts and repaired before they are parsed: a control character that XML
forbids makes a reader drop the rest of the record. One scan gives documents, link index and
contract violations alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicle import model as m
from chronicle.functions import text as t
from chronicle.functions.timeops import parse_iso

HREF = "`_xlink:href`"
LINK = "struct<link:array<struct<`_xlink:href`:string>>>"
DOCUMENT = (
    "_name string, _path string, _type string, property array<struct<_name:string,_type:string,text:string,value:string,blob:string,"
    f"links:{LINK},classifiedLinkLists:struct<classifiedLinkList:array<struct<classifierLinks:{LINK},links:{LINK}>>>>>,_corrupt_record string"
)
#: What a contract is made from. The parser passes over the rest, which makes most of its work.
HEADS = "_type string, property array<struct<_name:string,_type:string>>,_corrupt_record string"


def scan(spark: SparkSession, root: str, folders: Sequence[str] = ("",)) -> DataFrame:
    """(file, value, doc) of all *.xml below the folders; doc's attributes are null if a file can't be parsed.

    A missing folder is an error of the reader; no files at all is one here.
    """
    paths = [f"{root.rstrip('/')}/{f}".rstrip("/") for f in folders]
    files = spark.read.text(paths, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.xml")
    rows = files.select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", t.FORBIDDEN_IN_XML, "").alias("value"))
    if rows.isEmpty():
        raise FileNotFoundError(f"no documents below {', '.join(paths)}")
    return parsed(rows)


def parsed(rows: DataFrame, shape: str = DOCUMENT) -> DataFrame:
    """(file, value) with the document that each text holds; of what no parser reads, the text alone (`doc._corrupt_record`)."""
    return rows.withColumn("doc", F.from_xml("value", shape, {"rowTag": "document", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))


def well_formed() -> Column:
    """Whether a parsed row's text is XML: the parser reads all of it, and nothing but comments stands after the root."""
    ended = F.col("value").rlike(r"(?s)>\s*$")
    return F.col("doc._corrupt_record").isNull() & F.col("doc").isNotNull() & ended & walked(F.col("value"))["sound"]


def _hrefs(links: Column) -> Column:
    """A list of link targets; a link without one is empty text, a missing list is []."""
    return F.coalesce(F.transform(links["link"], lambda x: F.coalesce(x.getField("_xlink:href"), F.lit(""))), F.array().cast("array<string>"))


def _last(name: str) -> Column:
    """The last property of that name."""
    return F.try_element_at(F.filter(F.col("doc.property"), lambda p: p["_name"] == name), F.lit(-1))


def _classified(prop: Column, classifier: str) -> Column:
    """Links of the property's blocks whose first classifier link has that name, one block after the other."""
    blocks = prop["classifiedLinkLists"]["classifiedLinkList"]
    named = lambda b: t.classifier(F.try_element_at(_hrefs(b["classifierLinks"]), F.lit(1))).eqNullSafe(F.lit(classifier))
    return F.coalesce(F.flatten(F.transform(F.filter(blocks, named), lambda b: _hrefs(b["links"]))), F.array().cast("array<string>"))


def field(f: m.Field) -> Column:
    prop = _last(f.prop)
    if f.kind == m.TEXT:
        x = t.strip_html(prop["text"])
    elif f.kind == m.VALUE:
        x = t.clean(prop["value"])
    elif f.kind == m.DATE:
        x = parse_iso(t.clean(prop["value"]))
    elif f.kind == m.NUMBER:
        x = F.try_to_number(t.clean(prop["value"]), F.lit("S999999999999999999")).cast("long")
    elif f.kind == m.LINKS:
        x = F.coalesce(_hrefs(prop["links"]), F.array().cast("array<string>"))
    elif f.kind == m.CLASSIFIED:
        x = _classified(prop, f.classifier or "")
    else:
        raise ValueError(f"unknown kind {f.kind}")
    return x.alias(f.column)


def documents(scanned: DataFrame, model: m.Model, columns: Sequence[str] | None = None) -> DataFrame:
    """The declared raw table: every column is there, whether or not a document has it."""
    wanted = model.wanted(columns)
    by = {f.column: f for f in model.fields}
    identity = {
        "name": F.col("doc._name").alias("name"),
        "path": F.col("doc._path").alias("path"),
        "url": t.page_url(model.base_url, F.col("doc._path")).alias("url"),
    }
    rows = scanned.where(F.col("doc._type") == model.document_type)
    return rows.select(*(identity[c] if c in identity else field(by[c]) for c in wanted))


def linked(scanned: DataFrame, fields: Sequence[m.Field], types: Sequence[str]) -> DataFrame:
    """The index of linked documents: href, the fields, and for each whether the document has that property.

    A plain value goes before a text, and both lose their markup; of links the first counts.
    """
    rows = scanned.where(F.col("doc._type").isin(*types))
    cols = [F.col("doc._path").alias("href")]
    for f in fields:
        prop = _last(f.prop)
        said = t.strip_html(F.coalesce(prop["value"], prop["text"]))
        first = F.nullif(F.try_element_at(_hrefs(prop["links"]), F.lit(1)), F.lit(""))
        cols += [(first if f.kind == m.LINKS else said).alias(f.column), prop.isNotNull().alias(f"has_{f.column}")]
    return rows.select(*cols)


# ---------------------------------------------------------------- structure

CONTAINERS = {"RichText": "text", "String": "value", "Date": "value", "Long": "value", "LinkList": "links", "ClassifiedLinkLists": "classifiedLinkLists", "Blob": "blob"}


NAME = r"""[^\s<>/="'!?&]+"""
ATTRIBUTE = rf"""\s+{NAME}\s*=\s*(?:"[^"<]*"|'[^'<]*')"""
#: What holds no elements, and the elements' tags; a `>` may stand in an attribute.
MARKUP = rf"(?s)<(?:!--.*?-->|!\[CDATA\[.*?\]\]>|\?.*?\?>|![A-Z][^>]*>|/{NAME}\s*>|{NAME}(?:{ATTRIBUTE})*+\s*/?>)"


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's text, null if the tag has none; what other attributes say doesn't matter."""
    found = rf"""(?s)^<{NAME}(?:{ATTRIBUTE})*?\s+{name}\s*=\s*(?:"([^"<]*)"|'([^'<]*)')"""
    return F.coalesce(*(F.nullif(F.regexp_extract(tag, found, k), F.lit("")) for k in (1, 2)))


def walked(value: Column) -> Column:
    """(sound, props) of a text, by one walk over its tags with a stack of open elements.

    sound: each tag closes what was opened last, nothing stays open, there is one root, and no `<` stands outside of markup.
    props: (name, type, children) of each property right below the root, with the tags of its own children in order.
    """
    every = F.regexp_extract_all(value, F.lit(MARKUP), F.lit(0))
    read = lambda x: F.struct(x.alias("tag"), F.regexp_extract(x, rf"^</?({NAME})", 1).alias("name"), x.startswith("</").alias("closes"), x.endswith("/>").alias("alone"))
    tags = F.transform(F.filter(every, lambda x: ~(x.startswith("<!") | x.startswith("<?"))), read)
    prop = "struct<name:string,type:string,children:array<string>>"
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(True).alias("sound"), F.lit(0).alias("roots"), F.array().cast(f"array<{prop}>").alias("props"))

    def step(a: Column, x: Column) -> Column:
        tag, name, closes, alone = x["tag"], x["name"], x["closes"], x["alone"]
        depth = F.size(a["open"])
        left = F.when(closes, F.slice(a["open"], 1, F.greatest(depth - 1, F.lit(0)))).when(alone, a["open"]).otherwise(F.concat(a["open"], F.array(name)))
        fits = ~closes | F.coalesce(F.try_element_at(a["open"], F.lit(-1)) == name, F.lit(False))
        begun = F.struct(_attribute(tag, "name").alias("name"), _attribute(tag, "type").alias("type"), F.array().cast("array<string>").alias("children"))
        last = F.try_element_at(a["props"], F.lit(-1))
        grown = F.struct(last["name"].alias("name"), last["type"].alias("type"), F.concat(last["children"], F.array(name)).alias("children"))
        child = ~closes & (depth == 2) & F.coalesce(F.try_element_at(a["open"], F.lit(2)) == "property", F.lit(False))
        props = (
            F.when(~closes & (depth == 1) & (name == "property"), F.concat(a["props"], F.array(begun)))
            .when(child, F.concat(F.slice(a["props"], 1, F.greatest(F.size(a["props"]) - 1, F.lit(0))), F.array(grown)))
            .otherwise(a["props"])
        )
        return F.struct(left.alias("open"), (a["sound"] & fits).alias("sound"), (a["roots"] + (~closes & (depth == 0)).cast("int")).alias("roots"), props.alias("props"))

    stray = F.contains(F.regexp_replace(value, MARKUP, ""), F.lit("<"))
    return F.aggregate(tags, start, step, lambda a: F.struct((a["sound"] & (F.size(a["open"]) == 0) & (a["roots"] == 1) & ~stray).alias("sound"), a["props"].alias("props")))


def _exploded(rows: DataFrame, structs: Column) -> DataFrame:
    """A row for each struct, with nothing beside it: what else a row keeps is made again for each of its elements, so that a
    document would be parsed as often as it has properties. `explode` would also make the array once more, for a filter on its size."""
    return rows.select(F.explode_outer(structs).alias("__e")).where("__e is not null").select("__e.*")


def violations(scanned: DataFrame, contract: DataFrame) -> DataFrame:
    """(file, message) of every structural assumption that a document breaks.

    contract: (document_type, property, type). A document that can't be parsed is a violation,
    and so is a property that has not exactly its container as child.
    """
    types = [r[0] for r in contract.select("document_type").distinct().collect()]  # a handful, by contract
    root = F.regexp_extract("value", r"(?s)^\s*(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>|\s)*<([A-Za-z][\w.:-]*)", 1)
    doc = scanned.withColumn("root", root).withColumn("walked", walked(F.col("value")))
    whole_text = F.col("doc._corrupt_record").isNull() & F.col("doc").isNotNull() & F.col("value").rlike(r"(?s)>\s*$")
    readable = (F.col("root") != "") & whole_text & F.col("walked.sound")
    missing = F.array_compact(F.array(*(F.when(F.col(f"doc._{a}").isNull(), F.lit(a)) for a in ("name", "path", "type"))))
    first = (
        F.when(~readable, F.lit("document is not parseable as XML"))
        .when(F.col("root") != "document", F.concat(F.lit("root element is <"), F.col("root"), F.lit(">, expected <document>")))
        .when(F.size(missing) > 0, F.concat(F.lit("root lacks attributes "), F.array_join(missing, ", ")))
        .when(~F.col("doc._type").isin(*types), F.concat(F.lit("unknown document type "), F.col("doc._type")))
    )
    # One branch, so that a document is parsed and walked once: a faulty one is a row without a property, one without faults a row for each.
    judged = doc.select("file", F.col("doc._type").alias("document_type"), first.alias("whole"), F.col("walked.props").alias("props"))
    row = lambda whole, p: F.struct("file", "document_type", whole.alias("whole"), *(p(c).alias(c) for c in ("name", "type", "children")))
    nothing = {"name": "string", "type": "string", "children": "array<string>"}
    own = F.transform("props", lambda p: row(F.lit(None).cast("string"), lambda c: p[c]))
    faulty = F.array(row(F.col("whole"), lambda c: F.lit(None).cast(nothing[c])))
    props = _exploded(judged, F.when(F.col("whole").isNull(), own).otherwise(faulty))
    known = contract.select("document_type", F.col("property").alias("name"), F.col("type").alias("expected"))
    props = props.join(F.broadcast(known), ["document_type", "name"], "left")
    box = reduce(lambda acc, kv: acc.when(F.col("type") == kv[0], F.lit(kv[1])), CONTAINERS.items(), F.when(F.lit(False), F.lit(None)))
    tags = F.array_sort(F.array_distinct("children"))
    message = (
        F.when(F.col("whole").isNotNull(), F.col("whole"))
        .when(F.col("expected").isNull(), F.format_string("%s: unknown property %s of type %s", "document_type", "name", "type"))
        .when(F.col("expected") != F.col("type"), F.format_string("%s: property %s is %s, expected %s", "document_type", "name", "type", "expected"))
        .when(box.isNotNull() & ~tags.eqNullSafe(F.array(box)), F.format_string("%s property %s has children [%s], expected exactly <%s>", "type", "name", F.array_join(tags, ", "), box))
    )
    return props.select("file", message.alias("message")).where("message is not null")


def derive_contract(scanned: DataFrame) -> DataFrame:
    """(document_type, property, type) as an export has them; a property of two types is an error.

    The texts are read anew, heads of the properties only: a whole document takes more than twice as long. One that can't be parsed says nothing.
    """
    heads = F.transform("doc.property", lambda p: F.struct(F.col("doc._type").alias("document_type"), p["_name"].alias("property"), p["_type"].alias("type")))
    props = _exploded(parsed(scanned.select("value"), HEADS), F.when(F.col("doc._corrupt_record").isNull(), heads))
    found = props.groupBy("document_type", "property").agg(F.array_sort(F.collect_set("type")).alias("types")).persist()  # as many rows as the model has fields: documents are parsed once
    odd = found.where(F.size("types") != 1).limit(5).collect()
    if odd:
        raise ValueError("properties of several types: " + "; ".join(f"{r[0]}.{r[1]}: {r[2]}" for r in odd))
    return found.select("document_type", "property", F.element_at("types", 1).alias("type"))
