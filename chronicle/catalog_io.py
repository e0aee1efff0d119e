"""Queries of documents, guards, metadata, sinks and plans over the star-schema tables, each with its SQL.

XML is made from the tables' rows, so that DuckDB can say from the rows what the documents hold. What plans and
sinks write goes to the session's shared checkpoint folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle import model as m
from chronicle.catalog import EVENTS_SQL, QUERIES, SQL, VERSIONS_SQL, dealt, query, stamp, table
from chronicle.functions import arrays, text
from chronicle.operators import analytics, codelists, contract, history, linkage, sampling, segment, shape
from chronicle.plans.lifecycle import Plans
from chronicle.sinks import metadata, tables
from chronicle.sources import files, xml

_BEFORE = set(QUERIES)


def shared_folder(spark: SparkSession) -> str:
    """A new folder where driver and executors see it; only without a cluster it is one of this machine."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        named = tempfile.mkdtemp(prefix="catalog-")
    return f"{named.rstrip('/')}/catalog-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, said: str) -> None:
    """A small file, on any file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(said.encode()))
    out.close()


def values(*rows: tuple) -> str:
    """Rows of SQL literals."""
    one = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({', '.join(map(one, r))})" for r in rows)


# ---------------------------------------------------------------- documents

MODEL = m.Model(
    document_type="Customer",
    fields=[
        m.Field("title", "t:title", description="The name"),
        m.Field("note", "t:note", m.VALUE),
        m.Field("updated", "t:date", m.DATE),
        m.Field("rank", "t:rank", m.NUMBER),
        m.Field("contact", "t:contact", m.LINKS),
        m.Field("segment", "t:class", m.CLASSIFIED, "Segment"),
        m.Field("place", "t:class", m.CLASSIFIED, "Place"),
    ],
    base_url="https://site",
    slug_after="site/",
    contact="contact",
    coded=["segment", "place"],
    renames={"updated": "updated_at"},
    vocabularies={"segment": ["a", "b"]},
    drop=["note"],
    licence="https://licence/L",
    publisher="P",
)
XLINK = 'xmlns:xlink="http://www.w3.org/1999/xlink"'


def _prop(name: str, kind: str, *body):
    return F.concat(F.lit(f'<property name="{name}" type="{kind}">'), *body, F.lit("</property>"))


def _link(*to):
    return F.concat(F.lit('<link xlink:href="'), *to, F.lit('"/>'))


def _document(path, kind, *props):
    return F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<document {XLINK} name="n" path="'), path, F.lit('" type="'), kind, F.lit('">'), *props, F.lit("</document>"))


def customers_as_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): a document of each customer; names with a forbidden character and references, every fifth rank no number."""
    k, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    markup = F.concat(F.lit("<text>&lt;p&gt;&lt;![CDATA["), F.substring("c_name", 1, 4), F.lit("\u0002"), F.substring("c_name", 5, 40), F.lit(" &amp;amp; &amp;uuml;&lt;br/&gt;x]]&gt;&lt;/p&gt;</text>"))
    first = F.when(F.col("c_custkey") % 3 == 0, _prop("t:title", "RichText", F.lit("<text>first</text>"))).otherwise("")
    date = F.when(F.col("c_custkey") % 4 == 0, "2024").when(F.col("c_custkey") % 4 == 1, "2024-02-30").when(F.col("c_custkey") % 4 == 2, "2024-02-03T04:05:06+01:00").otherwise("2024-02-03")
    block = lambda name, to: F.concat(F.lit("<classifiedLinkList><classifierText/><classifierLinks>"), _link(F.lit(f"/Common/{name}")), F.lit("</classifierLinks><links>"), to, F.lit("</links></classifiedLinkList>"))
    classes = F.concat(F.lit("<classifiedLinkLists>"), block("Segment", _link(F.lit("/s/"), "c_mktsegment")), block("Odd", _link(F.lit("/o"))), block("Segment", _link(F.lit("/s/all"))), block("Place", F.when(F.col("c_custkey") % 2 == 0, _link(F.lit("/p/"), nation)).otherwise("")), F.lit("</classifiedLinkLists>"))
    doc = _document(
        F.concat(F.lit("/c/"), k), F.lit("Customer"), first, _prop("t:title", "RichText", markup),
        _prop("t:note", "String", F.lit("<value>  a  "), k, F.lit(" </value>")),
        _prop("t:date", "Date", F.lit("<value>"), date, F.lit("</value>")),
        _prop("t:rank", "Long", F.lit("<value>"), F.when(F.col("c_custkey") % 5 == 0, F.lit("x7")).otherwise(nation), F.lit("</value>")),
        _prop("t:contact", "LinkList", F.lit("<links>"), _link(F.lit("target:/n/"), nation), F.when(F.col("c_custkey") % 2 == 0, F.lit("<link/>")).otherwise(""), F.lit("</links>")),
        _prop("t:class", "ClassifiedLinkLists", classes),
    )
    return dealt(table(spark, sf_dir, "customer"), "c_custkey").select(F.concat(F.lit("c/"), k, F.lit(".xml")).alias("file"), F.regexp_replace(doc, text.FORBIDDEN_IN_XML, "").alias("value"))


TITLE_SQL = "c_name || ' & ü x'"
CUSTOMERS_SQL = f"""
SELECT '/c/' || c_custkey AS path, {TITLE_SQL} AS title, 'a ' || c_custkey AS note,
CASE c_custkey % 4 WHEN 2 THEN '2024-02-03 03:05:06' WHEN 3 THEN '2024-02-03 00:00:00' END AS updated,
CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END::BIGINT AS rank,
'target:/n/' || c_nationkey || CASE WHEN c_custkey % 2 = 0 THEN '|' ELSE '' END AS contact,
'/s/' || c_mktsegment || '|/s/all' AS segment, CASE WHEN c_custkey % 2 = 0 THEN '/p/' || c_nationkey ELSE '' END AS place,
'https://site/c/' || c_custkey || '.html' AS url FROM customer"""


@query(CUSTOMERS_SQL)
def xml_documents(spark, sf_dir):
    """Repair, last property, references, dates, numbers, links and classified links of a document."""
    raw = xml.documents(xml.parsed(customers_as_xml(spark, sf_dir)), MODEL)
    bag = lambda c: F.array_join(c, "|")  # noqa: E731  the documents' order
    return raw.select("path", "title", "note", stamp("updated").alias("updated"), "rank", bag("contact").alias("contact"), bag("segment").alias("segment"), bag("place").alias("place"), "url")


@query(f"""
WITH c AS ({CUSTOMERS_SQL}) SELECT replace(path, '/c/', 'c-') AS id_url, md5(replace(path, '/c/', 'c-')) AS id_hash, title || ' von P, https://licence/L, ' || url AS license_info, updated AS updated_at,
n_name AS contact_info_title, replace(segment, '/s/', '') AS segment FROM c LEFT JOIN nation ON split_part(replace(contact, 'target:/n/', ''), '|', 1) = n_nationkey::VARCHAR AND n_nationkey % 4 <> 0""")
def xml_export(spark, sf_dir):
    """The export of those documents: ids, attribution, first contact, codes, names."""
    raw = xml.documents(xml.parsed(customers_as_xml(spark, sf_dir)), MODEL)
    index = table(spark, sf_dir, "nation").where("n_nationkey % 4 <> 0").select(F.concat(F.lit("/n/"), F.col("n_nationkey").cast("string")).alias("href"), F.col("n_name").alias("title"))
    out = shape.process(raw, MODEL, index, ["title"])
    return out.select("id_url", "id_hash", "license_info", stamp("updated_at").alias("updated_at"), "contact_info_title", F.array_join("segment", "|").alias("segment"))


def nations_as_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked documents: nations with a region as their address document; every third has an empty city of its own, every fifth none."""
    n, k = table(spark, sf_dir, "nation"), F.col("n_nationkey").cast("string")
    own = F.when(F.col("n_nationkey") % 3 == 0, _prop("t:city", "String", F.lit("<value></value>"))).when(F.col("n_nationkey") % 3 == 1, _prop("t:city", "RichText", F.lit("<text>&lt;i&gt;"), "n_name", F.lit("&lt;/i&gt;</text>"))).otherwise("")
    doc = _document(F.concat(F.lit("/n/"), k), F.lit("Contact"), own, _prop("t:address", "LinkList", F.lit("<links>"), _link(F.lit("target:/r/"), F.col("n_regionkey").cast("string")), F.lit("</links>")), _prop("t:website", "LinkList", F.lit("<links>"), _link(F.lit("target:/r/"), F.col("n_regionkey").cast("string")), F.lit("</links>")))
    r = table(spark, sf_dir, "region")
    site = F.when(F.col("r_regionkey") % 2 == 0, _prop("t:url", "String", F.lit("<value>https://"), "r_name", F.lit("</value>"))).otherwise("")
    home = _document(F.concat(F.lit("/r/"), F.col("r_regionkey").cast("string")), F.lit("Address"), _prop("t:city", "String", F.lit("<value>"), "r_name", F.lit("</value>")), site)
    return n.select(k.alias("file"), doc.alias("value")).union(r.select("r_name", home))


INDEX = [m.Field("url", "t:url", m.VALUE), m.Field("city", "t:city", m.VALUE), m.Field("address", "t:address", m.LINKS), m.Field("website", "t:website", m.LINKS)]


@query("""
SELECT '/n/' || n_nationkey AS href, CASE n_nationkey % 3 WHEN 1 THEN n_name WHEN 2 THEN r_name END AS city, CASE WHEN r_regionkey % 2 = 0 THEN 'https://' || r_name ELSE 'https://site/r/' || r_regionkey || '.html' END AS website_url
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT '/r/' || r_regionkey, r_name, NULL FROM region""")
def xml_linked_index(spark, sf_dir):
    """Linked documents: an own field stays, even an empty one; an address and a website come from the linked document."""
    index = xml.linked(xml.parsed(nations_as_xml(spark, sf_dir)), INDEX, ["Contact", "Address"])
    return linkage.with_website(linkage.with_address(index, ["url", "city"]), "https://site").select("href", "city", "website_url")


@query("""
WITH m AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 IN (0, 1, 2, 3) THEN 'document is not parseable as XML' WHEN c_custkey % 7 = 4 THEN 'root element is <other>, expected <document>' WHEN c_custkey % 7 = 5 THEN 'Customer: unknown property t:new of type String' END AS message FROM customer)
SELECT message, count(*)::BIGINT AS n, (SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT 'c/' || k || '.xml' AS x FROM m AS o WHERE o.message = m.message ORDER BY x LIMIT 3)) AS examples FROM m WHERE message IS NOT NULL GROUP BY message""")
def xml_violations(spark, sf_dir):
    """Documents that are cut, whose elements cross, that have a second root or an unknown reference; another root; an unknown property."""
    sound = customers_as_xml(spark, sf_dir)
    k = F.regexp_extract("file", "([0-9]+)", 1).cast("long") % 7
    value = F.col("value")
    broken = (
        F.when(k == 0, F.substring(value, F.lit(1), F.length(value) - 20))
        .when(k == 1, F.replace(value, F.lit("</document>"), F.lit("<property name='t:x' type='String'><value></property></value></document>")))
        .when(k == 2, F.concat(value, F.lit("<document/>")))
        .when(k == 3, F.replace(value, F.lit("</document>"), F.lit("&nope;</document>")))
        .when(k == 4, F.replace(F.replace(value, F.lit("<document "), F.lit("<other ")), F.lit("</document>"), F.lit("</other>")))
        .when(k == 5, F.replace(value, F.lit("</document>"), F.lit('<property note="type=\'Long\' > name=\'t:note\'" name="t:new" type="String"><value><value>nested</value></value></property></document>')))
        .otherwise(value)
    )
    allowed = xml.derive_contract(xml.parsed(sound))
    found = contract.most_common(xml.violations(xml.parsed(sound.select("file", broken.alias("value"))), allowed))
    return found.select("message", "n", F.array_join("examples", "|").alias("examples"))


@query(f"SELECT * FROM (VALUES {values(('Customer', 't:class', 'ClassifiedLinkLists'), ('Customer', 't:contact', 'LinkList'), ('Customer', 't:date', 'Date'), ('Customer', 't:note', 'String'), ('Customer', 't:rank', 'Long'), ('Customer', 't:title', 'RichText'))}) AS t(document_type, property, type)")
def xml_contract(spark, sf_dir):
    return xml.derive_contract(xml.parsed(customers_as_xml(spark, sf_dir)))


# ---------------------------------------------------------------- plans

NATIONS = m.Model(
    document_type="Nation",
    fields=[m.Field("title", "t:title"), m.Field("keywords", "t:keywords", m.VALUE), m.Field("kind", "t:class", m.CLASSIFIED, "Kind")],
    base_url="https://site",
    slug_after="site/",
    coded=["kind"],
    renames={"kind": "kinds"},
)
MONDAY, WEEK = 1704682800.0, 7 * 86400  # 2024-01-08 03:00 UTC


@query("""
WITH n AS (SELECT n_nationkey AS k, n_name, n_regionkey, n_nationkey % 5 = 3 AS gone, n_nationkey % 4 = 1 AND n_nationkey % 5 <> 3 AS changed FROM nation)
SELECT 'n-' || k AS id_url, CASE WHEN changed THEN 'new ' ELSE '' END || n_name AS title, 'r' || n_regionkey AS kinds, '2024-W02' AS on_website_from, CASE WHEN gone THEN '2024-W03' END AS on_website_to,
CASE WHEN changed THEN '2024-W03' ELSE '' END AS previous_update_dates, gone AS absent, CASE WHEN k % 2 = 0 THEN 'kleine ' || upper(substr(n_name, 1, 1)) || '|Test' END AS terms,
(SELECT count(*) + count(*) FILTER (changed) FROM n)::BIGINT AS n_versions, (SELECT count(*) FILTER (NOT gone) FROM n)::BIGINT AS n_live FROM n""")
def published_history(spark, sf_dir):
    """Three loads of the nations' documents: all, all unchanged, then some changed and some gone; what is published then."""
    folder = shared_folder(spark)
    rows = table(spark, sf_dir, "nation").collect()
    plans = Plans(spark, NATIONS, f"{folder}/store")

    def export(name: str, changed: bool) -> str:
        for r in rows:
            if changed and r.n_nationkey % 5 == 3:
                continue
            title = ("new " if changed and r.n_nationkey % 4 == 1 else "") + r.n_name
            words = f"kleine {r.n_name[0].upper()}, Test" if r.n_nationkey % 2 == 0 else ""
            props = f'<property name="t:title" type="RichText"><text>{title}</text></property><property name="t:keywords" type="String"><value>{words}</value></property>'
            props += f'<property name="t:class" type="ClassifiedLinkLists"><classifiedLinkLists><classifiedLinkList><classifierLinks><link xlink:href="/Common/Kind"/></classifierLinks><links><link xlink:href="/k/r{r.n_regionkey}"/></links></classifiedLinkList></classifiedLinkLists></property>'
            put(spark, f"{folder}/{name}/n{r.n_nationkey}.xml", f'<document {XLINK} name="n" path="/n/{r.n_nationkey}" type="Nation">{props}</document>')
        return f"{folder}/{name}"

    first = export("one", False)
    plans.load(first, MONDAY, segment.rule_scorer, "r1")
    plans.load(first, MONDAY + WEEK, segment.rule_scorer, "r1")
    plans.load(export("two", True), MONDAY + 2 * WEEK, segment.rule_scorer, "r2")
    n_versions, n_live = plans.versions().count(), plans.live().count()
    out = plans.publish()
    return out.select("id_url", "title", F.array_join("kinds", "|").alias("kinds"), history.FROM, history.TO, F.array_join("previous_update_dates", "|").alias("previous_update_dates"), "absent", F.array_join("keywords_extracted", "|").alias("terms"), F.lit(n_versions).cast("long").alias("n_versions"), F.lit(n_live).cast("long").alias("n_live"))


@query("SELECT 'kept' AS said, count(*)::BIGINT AS n FROM nation UNION ALL SELECT 'again', count(*) FROM nation UNION ALL SELECT 'second writer refused', 1 UNION ALL SELECT 'after vacuum', count(*) FROM nation WHERE n_nationkey % 2 = 0")
def store_commits(spark, sf_dir):
    """A commit is whole or isn't: what is written without one isn't seen, of two writers one is refused."""
    nation = table(spark, sf_dir, "nation")
    schema = ", ".join(f"{n} {k}" for n, k in nation.dtypes)
    store = tables.Store(spark, shared_folder(spark))
    store.commit(-1, {"t": [store.write(nation, "t")]})
    out = [("kept", store.read("t", schema).count())]
    base, _ = store.current()
    part = store.write(nation.where("n_nationkey % 2 = 0"), "t")
    out.append(("again", store.read("t", schema).count()))
    store.commit(base, {"t": [part]})
    try:
        store.commit(base, {"t": []})
    except OSError:
        out.append(("second writer refused", 1))
    store.vacuum(1)
    out.append(("after vacuum", store.read("t", schema).count()))
    return spark.createDataFrame(out, "said string, n long")


@query("SELECT '/n/' || n_nationkey AS href, CASE WHEN n_nationkey % 4 = 0 THEN 'moved ' ELSE '' END || n_name AS city, '2024-01-08' AS since, NULL::VARCHAR AS until FROM nation WHERE n_nationkey % 4 <> 0 UNION ALL SELECT '/n/' || n_nationkey, n_name, '2024-01-08', '2024-01-15' FROM nation WHERE n_nationkey % 4 = 0 UNION ALL SELECT '/n/' || n_nationkey, 'moved ' || n_name, '2024-01-15', NULL FROM nation WHERE n_nationkey % 4 = 0")
def linked_history(spark, sf_dir):
    """Versions of linked documents, by their own key; closed ones stay where they are."""
    nation = table(spark, sf_dir, "nation")
    href = F.concat(F.lit("/n/"), F.col("n_nationkey").cast("string")).alias("href")
    store = tables.Store(spark, shared_folder(spark))
    ddl = f"href string, city string, row_hash string, {history.FROM} timestamp, {history.TO} timestamp"
    for day, moved in (("2024-01-08", False), ("2024-01-15", True), ("2024-01-22", True)):
        base, held = store.current()
        city = F.concat(F.when((F.col("n_nationkey") % 4 == 0) & F.lit(moved), "moved ").otherwise(""), F.col("n_name")).alias("city")
        merged = history.apply_live(store.read("open", ddl), nation.select(href, city), F.lit(day).cast("timestamp"), "href")
        closing = store.write(merged.where(F.col(history.TO).isNotNull()), "closed")
        store.commit(base, {"open": [store.write(merged.where(F.col(history.TO).isNull()), "open")], "closed": [*held.get("closed", []), closing]})
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return store.read(["open", "closed"], ddl).select("href", "city", day(history.FROM).alias("since"), day(history.TO).alias("until"))


@query(f"SELECT * FROM (VALUES {values(*((n, True) for n in ('LICENCE', 'columns.html', 'dataset.jsonld', 'dataset.ttl', 'index.html', 'table-schema.json', 'table.csv', 'vocabularies.html')))}) AS t(name, written) UNION ALL SELECT 'rows of table.csv: ' || count(*), true FROM nation")
def built_files(spark, sf_dir):
    """What a publication writes: table, contract, metadata that keeps its shapes, pages, licence."""
    folder = shared_folder(spark)
    for r in table(spark, sf_dir, "nation").collect():
        put(spark, f"{folder}/in/n{r.n_nationkey}.xml", f'<document {XLINK} name="n" path="/n/{r.n_nationkey}" type="Nation"><property name="t:title" type="RichText"><text>{r.n_name}</text></property></document>')
    put(spark, f"{folder}/LICENCE", "L")
    plans = Plans(spark, NATIONS, f"{folder}/store", base_url="https://site")
    plans.load(f"{folder}/in", MONDAY)
    names = plans.build(f"{folder}/out", about=metadata.About({"en": "Nations", "de": "Länder"}, publisher="P", licence="https://licence/L"), licence_file=f"{folder}/LICENCE")
    rows = [(n, size > 0) for n, (_, size) in tables.sizes(spark, f"{folder}/out", dict.fromkeys(names, "")).items()]
    rows.append((f"rows of table.csv: {spark.read.text(f'{folder}/out/table.csv').count() - 1}", True))
    return spark.createDataFrame(rows, "name string, written boolean")


# ---------------------------------------------------------------- files


@query("SELECT '/r/' || r_regionkey AS path, r_name AS title FROM region UNION ALL SELECT 'folder kept', 'false'")
def archive_export(spark, sf_dir):
    """An export fetched as an archive, unpacked where executors see it for as long as it is used."""
    import tempfile
    import zipfile
    from pathlib import Path

    small = m.Model("Region", [m.Field("title", "t:title")])
    with tempfile.TemporaryDirectory() as d:  # stands for the server
        with zipfile.ZipFile(Path(d, "e.zip"), "w") as z:
            for r in table(spark, sf_dir, "region").collect():
                z.writestr(f"deep/{r.r_regionkey}.xml", f'<document {XLINK} name="n" path="/r/{r.r_regionkey}" type="Region"><property name="t:title" type="RichText"><text>{r.r_name}</text></property></document>')
        with files.export(Path(d, "e.zip").as_uri(), spark=spark, shared=shared_folder(spark)) as root:
            rows = [(r.path, r.title) for r in xml.documents(xml.scan(spark, root), small).collect()]
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    kept = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.createDataFrame([*rows, ("folder kept", str(kept).lower())], "path string, title string")


def _answers(url: str, body: bytes, headers, timeout: float) -> bytes:
    """A server that joins words of one first letter and is busy at every second question."""
    import urllib.error

    values_ = json.loads(body)["tokens"]
    _answers.asked = getattr(_answers, "asked", 0) + 1
    if _answers.asked % 2:
        raise urllib.error.HTTPError(url, 503, "busy", None, None)
    return json.dumps({"results": [[0.9 if a[0] == b[0] else 0.1 for a, b in zip(v, v[1:], strict=False)] for v in values_]}).encode()


@query("""
WITH n AS (SELECT DISTINCT p_name FROM part), s AS (SELECT p_name, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM n)
SELECT p_name, CASE WHEN b = '' THEN a WHEN substr(a, 1, 1) = substr(b, 1, 1) THEN a || ' ' || b ELSE a || '|' || b END AS terms, md5(p_name) < '8' AS cached FROM s""")
def endpoint_answers(spark, sf_dir):
    """Terms by a model behind an endpoint that has to be asked again; what the cache has isn't asked for."""
    from chronicle.sources import endpoint

    part = table(spark, sf_dir, "part").select("p_name")
    scorer = endpoint.configured("http://model", "token", chunk=64, post=_answers, pause=lambda _: None)
    assert endpoint.configured("http://model", None) is None
    first = segment.scored(part.where(F.md5("p_name") < "8"), "p_name", scorer)
    cache = first.select(segment.cache_key(F.col("p_name"), "r").alias("key"), "probabilities")
    known, asked = segment.cached(part, cache, "p_name", "r")
    every = known.select("p_name", segment.tokens(F.col("p_name")).alias("tokens"), "probabilities", F.lit(True).alias("cached")).unionByName(segment.scored(asked, "p_name", scorer).withColumn("cached", F.lit(False)))
    return every.select("p_name", F.array_join(segment.decoded(F.col("tokens"), F.col("probabilities"))["terms"], "|").alias("terms"), "cached")



@query(f"WITH {VERSIONS_SQL.format(events=EVENTS_SQL)} SELECT user_id, event_type, strftime(f, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(t, '%Y-%m-%d %H:%M:%S') AS valid_to FROM versions")
def late_history(spark, sf_dir):
    """Versions of a stream of all events in shuffled micro-batches, where windows close and split afterwards: those of the events in order."""
    from chronicle.streaming import late

    folder, events = shared_folder(spark), table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    events.repartition(24).write.parquet(f"{folder}/in")  # each file has events of the whole time
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(f"{folder}/in")
    said = late.changes(stream, "user_id", "event_type", "ts", "60 days").writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    said.awaitTermination()
    got = late.settled(spark.read.parquet(f"{folder}/out"), "user_id", "event_type")
    return got.select("user_id", "event_type", stamp(history.FROM).alias("valid_from"), stamp(history.TO).alias("valid_to"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'a \"q\", ' || n_name || chr(10) || 'z' WHEN n_nationkey % 3 = 1 THEN n_name END AS said, '[' || n_regionkey || ',null]' AS cells FROM nation")
def csv_round_trip(spark, sf_dir):
    """One CSV file with quotes, line breaks, nulls and nested cells, written and read back."""
    k = F.col("n_nationkey")
    said = F.when(k % 3 == 0, F.concat(F.lit('a "q", '), "n_name", F.lit("\nz"))).when(k % 3 == 1, F.col("n_name"))
    df = table(spark, sf_dir, "nation").select("n_nationkey", said.alias("said"), F.array("n_regionkey", F.lit(None).cast("int")).alias("cells"))
    path = f"{shared_folder(spark)}/t.csv"
    tables.write_csv(df, path, ["n_nationkey"])
    tables.write_csv(df, path, ["n_nationkey"])  # takes its place
    return files.read_csv(spark, path, T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("said", T.StringType()), T.StructField("cells", T.StringType())]))


@query("SELECT r_regionkey, r_name, '[\"' || r_name || '\",null]' AS words FROM region")
def jsonl_round_trip(spark, sf_dir):
    path = f"{shared_folder(spark)}/t.jsonl"
    tables.write_jsonl(table(spark, sf_dir, "region").select("r_regionkey", "r_name", F.array("r_name", F.lit(None).cast("string")).alias("words")), path)
    return files.read_jsonl(spark, path, "r_regionkey int, r_name string, words array<string>").withColumn("words", F.to_json("words", {"ignoreNullFields": "false"}))


@query("SELECT n_nationkey::VARCHAR AS code, n_name AS label FROM nation ORDER BY length(n_nationkey::VARCHAR), n_nationkey::VARCHAR LIMIT 12")
def genericode_codes(spark, sf_dir):
    """A code list in its own order: by length of the code, then by code."""
    path = f"{shared_folder(spark)}/list.xml"
    rows = "".join(f'<Row><Value ColumnRef="code"><SimpleValue>{r.n_nationkey}</SimpleValue></Value><Value ColumnRef="name"><SimpleValue>{r.n_name}</SimpleValue></Value></Row>' for r in table(spark, sf_dir, "nation").collect())
    put(spark, path, f'<gc:CodeList xmlns:gc="x"><SimpleCodeList>{rows}</SimpleCodeList></gc:CodeList>')
    return files.genericode(spark, path).limit(12)


@query("""
SELECT n_nationkey::VARCHAR AS key, CASE WHEN n_nationkey % 3 = 0 THEN 'own ' || n_name WHEN n_nationkey % 3 = 1 THEN 'other ' || n_name END AS label FROM nation""")
def label_bundles(spark, sf_dir):
    """Labels from table cells: the first bundle that has a key says it."""
    n = table(spark, sf_dir, "nation")
    cell = lambda who: F.concat(F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit(f"</td><td>{who} "), "n_name", F.lit("</td></tr>"))
    bundle = lambda rows, who: files.label_cells(rows.groupBy("n_regionkey").agg(F.concat_ws("\n", F.collect_list(cell(who))).alias("value")))
    one, two = bundle(n.where("n_nationkey % 3 = 0"), "own"), bundle(n.where("n_nationkey % 3 < 2"), "other")
    return files.with_fallback(n.select(F.col("n_nationkey").cast("string").alias("key")), one, two)


@query("""
WITH c AS (SELECT p_name AS list, min(p_brand) FILTER (p_size < 25) AS pinned, max(p_brand) AS now FROM part GROUP BY 1)
SELECT list, pinned, now FROM c WHERE now > pinned""")
def registry_drift(spark, sf_dir):
    """Pinned versions that a registry has moved on from: a part's brands are its versions."""
    part = table(spark, sf_dir, "part").select(F.col("p_name").alias("list"), F.col("p_brand").alias("version"), "p_size")
    pinned = part.where("p_size < 25").groupBy("list").agg(F.min("version").alias("version"))
    return files.drifted_rows(pinned, part.drop("p_size"))


# ---------------------------------------------------------------- shape and order


@query("SELECT p_partkey AS key, p_brand AS brand, p_size FROM part")
def renamed_columns(spark, sf_dir):
    """Drops and renames what is there, and passes over what isn't."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    return shape.renamed(part, ["p_type", "nothing"], {"p_partkey": "key", "p_brand": "brand", "missing": "x"})


@query("SELECT o_orderkey, o_totalprice::VARCHAR IS NOT NULL AS has_price, list_value(o_orderstatus, o_orderpriority)[2] AS second, NULL::VARCHAR AS absent FROM orders")
def retyped_columns(spark, sf_dir):
    """Texts back to the declared types; a declared column that is missing is null."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_totalprice").cast("string").alias("price"), F.to_json(F.array("o_orderstatus", "o_orderpriority")).alias("words"))
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("absent", T.StringType())])
    return shape.retyped(o, schema).select("o_orderkey", F.col("price").isNotNull().alias("has_price"), F.element_at("words", 2).alias("second"), "absent")


@query("""
WITH p AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'FIRST' ELSE o_orderpriority END AS x FROM orders), f AS (SELECT o_custkey, x, min(o_orderkey) AS k FROM p GROUP BY 1, 2)
SELECT o_custkey, string_agg(x, '|' ORDER BY k) AS seen FROM f GROUP BY 1""")
def ordered_distinct(spark, sf_dir):
    """Each value once, in order of first sight."""
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda e: e["o_orderpriority"]).alias("x"))
    return lists.select("o_custkey", F.array_join(arrays.aliased(F.col("x"), {"1-URGENT": "FIRST", "2-HIGH": "FIRST"}), "|").alias("seen"))


@query("SELECT value, n FROM (SELECT CASE WHEN p_size % 7 <> 0 THEN p_type END AS value, count(*)::BIGINT AS n FROM part GROUP BY 1) ORDER BY n DESC, value NULLS FIRST LIMIT 3")
def most_common_values(spark, sf_dir):
    """Most common first, null among them; of equal ones null and then the least first."""
    return analytics.value_counts(table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 7 != 0, F.col("p_type")).alias("x")), "x").limit(3)


@query('SELECT "column", code, "match" FROM (SELECT \'c\' AS "column", r_name AS code, CASE WHEN r_regionkey % 2 = 0 THEN r_regionkey::VARCHAR END AS "match" FROM region) ORDER BY code, "match" NULLS LAST LIMIT 4')
def ordered_matches(spark, sf_dir):
    """Rows of an alignment in their order, those without a match last."""
    r = table(spark, sf_dir, "region")
    rows = r.select(F.lit("c").alias("column"), F.col("r_name").alias("code"), F.when(F.col("r_regionkey") % 2 == 0, F.col("r_regionkey").cast("string")).alias("match"))
    return codelists.matches(rows).limit(4)


@query("SELECT r_name || '.' || n_name AS path FROM region JOIN nation ON r_regionkey = n_regionkey ORDER BY path LIMIT 7")
def pivot_paths(spark, sf_dir):
    """The domain of a collapsed list, sorted."""
    parents = table(spark, sf_dir, "region").select(F.col("r_name").alias("parent"), F.col("r_regionkey").alias("vocab"))
    children = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("vocab"), F.col("n_name").alias("code"))
    return shape.pivot_paths(parents, children).limit(7)


@query("SELECT page_id, nullif(regexp_extract('/x/Common/' || regexp_extract(url, '([^/]+)$', 1), '/Common/([^/]+)$', 1), '') AS name FROM pages")
def classifier_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.classifier(F.concat(F.lit("/x/Common/"), text.leaf(F.col("url")))).alias("name"))


@query("""
WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_size % 3 = 0 AS marked FROM part),
n AS (SELECT *, CASE WHEN marked THEN 'XY' ELSE '' END || upper(a[1]) || a[2:] || upper(b[1]) || b[2:] AS name, a = 'small' AND b IN ('bolt', 'gear', 'ring') AND NOT marked AS whole FROM w)
SELECT name, CASE WHEN whole THEN lower(name) WHEN marked THEN 'xy_' || a || '_' || b ELSE a || '_' || b END AS col,
  CASE WHEN whole THEN lower(name) WHEN marked THEN 'xy' || upper(a[1]) || a[2:] || upper(b[1]) || b[2:] ELSE a || upper(b[1]) || b[2:] END AS back FROM n""")
def classifier_columns(spark, sf_dir):
    """Column names of classifiers, and camelCase names of columns; some are one word."""
    words = F.array_join(F.transform(F.split("p_name", " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 99))), "")
    part = table(spark, sf_dir, "part").select(F.concat(F.when(F.col("p_size") % 3 == 0, "XY").otherwise(""), words).alias("name")).distinct()
    out = part.withColumn("col", text.classifier_case(F.col("name"), ("SmallBolt", "SmallGear", "SmallRing"), ("XY",)))
    return out.withColumn("back", text.camel_case(F.col("col")))


# ---------------------------------------------------------------- contract and guards


@query(f"SELECT * FROM (VALUES {values(('missing column declared',), ('undeclared column n_name',), ('n_regionkey is int, declared bigint',))}) AS t(fault)")
def schema_faults(spark, sf_dir):
    want = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_regionkey", T.LongType()), T.StructField("declared", T.StringType())])
    return spark.createDataFrame([(x,) for x in contract.schema_faults(table(spark, sf_dir, "nation"), want)], "fault string")


@query("SELECT 'not_null' AS check_name, 'n_name' AS column_name, count(*)::BIGINT AS n_rows, count(*) FILTER (n_regionkey = 1)::BIGINT AS n_failed FROM nation UNION ALL SELECT 'unique', 'n_regionkey', count(*)::BIGINT, count(*)::BIGINT FROM nation")
def contract_of_present_columns(spark, sf_dir):
    """Checks of columns that aren't selected are left out; a frame check needs all of its columns."""
    rows = table(spark, sf_dir, "nation").withColumn("n_name", F.when(F.col("n_regionkey") != 1, F.col("n_name")))
    return contract.report(rows, [contract.not_null("n_name"), contract.not_null("gone"), contract.spans("gone", "n_name")], ["n_regionkey"])


@query("""
WITH n AS (SELECT n_regionkey, n_nationkey, CASE WHEN n_nationkey % 6 = 0 THEN 'Not_A slug' ELSE 'slug-' || n_nationkey END AS s, CASE WHEN n_nationkey % 4 = 0 THEN 'ftp://x' ELSE 'https://' || n_nationkey END AS u FROM nation)
SELECT 'slugs' AS check_name, 'codes' AS column_name, 5::BIGINT AS n_rows, count(DISTINCT n_regionkey) FILTER (s LIKE 'Not%')::BIGINT AS n_failed FROM n UNION ALL SELECT 'http_links', 'links', 5, count(DISTINCT n_regionkey) FILTER (u LIKE 'ftp%') FROM n""")
def named_list_checks(spark, sf_dir):
    """Open lists of slugs, and links that must lead to the web."""
    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation").select("n_regionkey", F.when(k % 6 == 0, F.lit("Not_A slug")).otherwise(F.concat(F.lit("slug-"), k.cast("string"))).alias("s"), F.struct(F.when(k % 4 == 0, F.lit("ftp://x")).otherwise(F.concat(F.lit("https://"), k.cast("string"))).alias("url")).alias("u"))
    rows = n.groupBy("n_regionkey").agg(F.collect_list("s").alias("codes"), F.collect_list("u").alias("links"))
    return contract.report(rows, [contract.slugs("codes"), contract.http_links("links")])


@query("""
SELECT 'not_null' AS check_name, 'p_name' AS column_name, (SELECT string_agg(k, '|' ORDER BY k) FROM (SELECT p_partkey::VARCHAR AS k FROM part WHERE p_size % 5 = 0 ORDER BY k LIMIT 3)) AS examples
UNION ALL SELECT 'range', 'p_size', (SELECT string_agg(k, '|' ORDER BY k) FROM (SELECT p_partkey::VARCHAR AS k FROM part WHERE p_size > 40 ORDER BY k LIMIT 3))""")
def contract_examples(spark, sf_dir):
    """All failures are reported, each with its first few rows."""
    rows = table(spark, sf_dir, "part").withColumn("p_name", F.when(F.col("p_size") % 5 != 0, F.col("p_name")))
    found = contract.offenders(rows, [contract.not_null("p_name"), contract.between("p_size", 1, 40), contract.not_null("p_brand")], "p_partkey")
    return found.select("check_name", "column_name", F.array_join("examples", "|").alias("examples"))


@query("""
SELECT 'duplicates' AS guard, 'n_regionkey is not unique: ' || (SELECT string_agg(n_regionkey::VARCHAR, ', ' ORDER BY n_regionkey) FROM (SELECT n_regionkey FROM nation GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 5)) AS said
UNION ALL SELECT 'null key', 'k is null' UNION ALL SELECT 'drift', 'columns changed: new [''n_name'', ''n_regionkey''], missing [''declared'']'
UNION ALL SELECT 'empty', 'the extract is empty' UNION ALL SELECT 'shrinkage', 'the extract has ' || (SELECT count(*) FROM part WHERE p_partkey % 2 = 0) || ' rows; ' || (SELECT count(*) FROM part) || ' are live'
UNION ALL SELECT 'fields', 'unknown fields: nope, other' UNION ALL SELECT 'undecided', 'c.' || min(n_name) FROM nation UNION ALL SELECT 'header', 'missing: b; extra: c' UNION ALL SELECT 'order', 'columns are out of order'""")
def refusals(spark, sf_dir):
    """What each guard says when it refuses."""
    nation, part = table(spark, sf_dir, "nation"), table(spark, sf_dir, "part")
    least = nation.agg(F.min("n_name")).first()[0]
    rows = spark.createDataFrame([("c", least, None)], "column string, code string, source string")
    guards = {
        "duplicates": lambda: history.refuse_duplicates(nation, "n_regionkey"),
        "null key": lambda: history.refuse_duplicates(nation.select(F.when(F.col("n_nationkey") > 3, F.col("n_nationkey")).alias("k")), "k"),
        "drift": lambda: history.refuse_drift(nation, ["n_nationkey", "declared"]),
        "empty": lambda: history.refuse_shrinkage(0, 0),
        "shrinkage": lambda: history.refuse_shrinkage(part.count(), part.where("p_partkey % 2 = 0").count()),
        "fields": lambda: MODEL.wanted(["title", "other", "nope"]),
        "undecided": lambda: codelists.decided(rows),
    }
    out = [("header", "; ".join(contract.header_faults(["a", "c"], ["a", "b"]))), ("order", "; ".join(contract.header_faults(["b", "a"], ["a", "b"])))]
    for name, guard in guards.items():
        try:
            guard()
        except ValueError as e:
            out.append((name, str(e)))
    return spark.createDataFrame(out, "guard string, said string")


# ---------------------------------------------------------------- reports



def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    fifth = k % 5
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", F.when(fifth == 0, F.col("n_name")).alias("rare"), F.lit(None).cast("string").alias("never"), F.lit("x").alias("same"),
        F.when(fifth < 2, F.array(F.lit("only"))).otherwise(F.array().cast("array<string>")).alias("one"), F.array(k % 3, k % 2).alias("many"), F.when(k > 2, F.lit('["a"]')).alias("cells"),
    )


@query("SELECT 'never' AS \"column\"")
def never_filled(spark, sf_dir):
    return analytics.never_filled(_holes(spark, sf_dir))


@query("SELECT 'rare' AS \"column\", 25::BIGINT AS n_rows, count(*) FILTER (n_nationkey % 5 = 0)::BIGINT AS n_filled, round(count(*) FILTER (n_nationkey % 5 = 0) / count(*), 4)::DOUBLE AS rate FROM nation")
def sparse_columns(spark, sf_dir):
    """Columns under a rate, the emptiest first: the second of them."""
    found = analytics.sparse(_holes(spark, sf_dir), 0.5).limit(2)
    return found.where("column <> 'never'")


@query("SELECT 'one' AS \"column\", count(*) FILTER (n_nationkey % 5 < 2)::BIGINT AS n_filled, 1::BIGINT AS n_values FROM nation UNION ALL SELECT 'many', count(*), (SELECT count(DISTINCT v) FROM (SELECT n_nationkey % 3 AS v FROM nation UNION SELECT n_nationkey % 2 FROM nation)) FROM nation")
def single_valued_lists(spark, sf_dir):
    """How many different elements each list column has."""
    rows = _holes(spark, sf_dir).withColumn("many", F.transform("many", lambda x: x.cast("string")))
    return analytics.single_valued_lists(rows, ["one", "many"])


@query("SELECT * FROM (VALUES ('never', 1::BIGINT), ('same', 1)) AS t(\"column\", n_values)")
def constant_columns(spark, sf_dir):
    return analytics.constant_columns(_holes(spark, sf_dir), ["rare", "never", "same", "n_nationkey"])


@query("SELECT 'cells' AS \"column\"")
def json_columns(spark, sf_dir):
    """Text columns with JSON arrays."""
    return spark.createDataFrame([(c,) for c in analytics.json_list_columns(_holes(spark, sf_dir))], "column string")


@query("SELECT count(DISTINCT p_brand || '.' || p_type)::BIGINT AS n_paths, count(DISTINCT p_type)::BIGINT AS n_children FROM part")
def lost_without_parent(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.array(F.concat("p_brand", F.lit("."), "p_type")).alias("paths"))
    return analytics.lost_without_parent(rows, "paths")


@query("SELECT p_type AS v, min(p_partkey) AS p FROM part GROUP BY 1")
def first_seen(spark, sf_dir):
    return sampling.first_seen(table(spark, sf_dir, "part").select(F.col("p_type").alias("v"), F.col("p_partkey").alias("p")), "v", "p")


POOL_SQL = "md5('{seed}:' || p_partkey::VARCHAR)"


@query(f"""
WITH s AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' ELSE 'big' END AS stratum FROM part),
r AS (SELECT p_partkey, row_number() OVER (PARTITION BY stratum ORDER BY {POOL_SQL.format(seed=3)}, p_partkey) AS rank FROM s),
m AS (SELECT p_partkey FROM part WHERE p_type LIKE '%STEEL%' OR p_size = 7 ORDER BY {POOL_SQL.format(seed=4)}, p_partkey LIMIT 6),
e AS (SELECT p_partkey, 2 AS o, 'stratum' AS pool FROM r WHERE rank <= 9 UNION ALL SELECT p_partkey, 1, 'pattern' FROM m UNION ALL SELECT p_partkey, 0, 'named' FROM part WHERE p_partkey IN (1, 2, 3))
SELECT p_partkey, arg_min(pool, o) AS pool FROM e GROUP BY 1""")
def pooled_sample(spark, sf_dir):
    """Strata, rows that a pattern marks, and named ones; each row once."""
    part = table(spark, sf_dir, "part")
    marked = F.col("p_type").contains("STEEL") | (F.col("p_size") == 7)
    return sampling.pooled_sample(part, "p_partkey", F.when(F.col("p_size") < 10, "small").otherwise("big"), 9, marked, 6, [1, 2, 3], 3).select("p_partkey", "pool")


@query("SELECT l_orderkey, '0' || repeat('1', count(*)::INTEGER - 1) AS labels FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1")
def gold_split(spark, sf_dir):
    """Labels of the rows of one split: an order's lines are one term."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("int").alias("n"))
    gold = rows.select(F.array(F.col("l_orderkey").cast("string")).alias("tokens"), F.array("n").alias("group_sizes"), F.when(F.col("l_orderkey") % 2 == 0, "test").otherwise("train").alias("split"))
    return segment.split_rows(gold, "test").select(F.col("tokens")[0].cast("long").alias("l_orderkey"), F.array_join(F.transform("labels", lambda x: x.cast("string")), "").alias("labels"))


@query("SELECT l_orderkey, string_agg(l_linenumber::VARCHAR, '|' ORDER BY l_linenumber) AS sizes FROM lineitem GROUP BY 1")
def sizes_of_spans(spark, sf_dir):
    """Sizes to half-open spans and back."""
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.col("l_linenumber").cast("int"))).alias("s"))
    back = segment.sizes_from_spans(segment.spans(F.col("s")))
    return lists.select("l_orderkey", F.array_join(F.transform(back, lambda x: x.cast("string")), "|").alias("sizes"))


@query("SELECT p_partkey, substr(sha256(p_name), 1, 12) || '.' || substr(sha256('w' || p_partkey), 1, 12) AS revision FROM part")
def revisions(spark, sf_dir):
    """Names of producers, by code and weights."""
    return table(spark, sf_dir, "part").select("p_partkey", segment.revision(F.col("p_name"), F.concat(F.lit("w"), "p_partkey")).alias("revision"))


# ---------------------------------------------------------------- metadata

COLUMNS = [
    metadata.Column("id_hash", "string", False, True, None, "derived", ""),
    metadata.Column("title", "string", True, False, None, "upstream", "The name"),
    metadata.Column("segment", "array<string>", True, False, "segment", "upstream", ""),
    metadata.Column("rank", "bigint", True, False, None, "upstream", ""),
]


def _columns(spark: SparkSession, sf_dir: str) -> list[metadata.Column]:
    schema = T.StructType([T.StructField("id_hash", T.StringType()), T.StructField("title", T.StringType()), T.StructField("segment", T.ArrayType(T.StringType())), T.StructField("updated_at", T.TimestampType()), T.StructField("guess", T.DoubleType())])
    return metadata.contract(schema, MODEL, inferred=["guess"], unique=["id_hash"], required=["id_hash"])


@query(f"""
WITH p AS (SELECT *, CASE WHEN p_size % 7 <> 0 THEN p_type END AS kind FROM part), n AS (SELECT count(*) AS n FROM p)
{" UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS name, '{t}' AS dtype, count({c}) < any_value(n) AS nullable, count(DISTINCT {c}) = any_value(n) AS is_unique, {v} AS vocabulary, '{o}' AS origin, '{d}' AS description FROM p, n" for i, (c, t, v, o, d) in enumerate((("p_partkey", "bigint", "NULL", "derived", ""), ("p_name", "string", "NULL", "upstream", "The name"), ("kind", "string", "'kind'", "derived", ""), ("p_size", "int", "NULL", "inferred", ""))))}""")
def contract_described(spark, sf_dir):
    """A table's contract: its types, and what of its columns its rows show to be unique and filled."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 7 != 0, F.col("p_type")).alias("kind"), "p_size")
    codes = [r[0] for r in part.where("kind is not null").select("kind").distinct().orderBy("kind").collect()]
    model = m.Model("Part", [m.Field("p_name", "t:name", description="The name")], vocabularies={"kind": codes})
    unique, full = metadata.measured(part)
    return metadata.describe(spark, metadata.contract(part.schema, model, inferred=["p_size"], unique=unique, required=full))


@query("SELECT * FROM (VALUES ('id_hash', 'string', true, 'https://b#idHash', NULL), ('title', 'string', false, 'https://b#title', 'The name'), ('segment', 'json', false, 'https://b#segment', 'A JSON array of values; an empty array if there are none. One of 5 codes: ' || (SELECT string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) FROM customer) || '.'), ('updated_at', 'dateTime', false, 'https://b#updatedAt', NULL), ('guess', 'double', false, 'https://b#guess', NULL)) AS t(name, datatype, required, property, said)")
def table_schema(spark, sf_dir):
    """CSVW of the published columns, with notes on lists and codes."""
    codes = {r[0]: r[0] for r in table(spark, sf_dir, "customer").select("c_mktsegment").distinct().collect()}
    said = metadata.table_schema(_columns(spark, sf_dir), "https://b", "id_hash", {"segment": codes})["tableSchema"]["columns"]
    return spark.createDataFrame([(c["name"], c["datatype"], c["required"], c["propertyUrl"], c.get("dc:description")) for c in said], "name string, datatype string, required boolean, property string, said string")


def _dataset(spark: SparkSession, sf_dir: str) -> list[metadata.Triple]:
    labels = {"region": {str(r.r_regionkey): r.r_name for r in table(spark, sf_dir, "region").collect()}}
    about = metadata.About({"en": "Regions", "de": "Regionen"}, {"en": "All of them"}, {"en": ["region", "world"], "de": ["Welt"]}, "P", "https://licence/L", ["REGI"], ["ENG"])
    return metadata.dataset_triples("https://d", about, {"t.csv": ("text/csv", 12345)}) + metadata.vocabulary_triples("https://d", COLUMNS[:2], labels)


NS = metadata.PREFIXES | {"eu": metadata.AUTHORITY}
DATASET_SQL = [
    ("https://d", "{rdf}type", "{dcat}Dataset", "iri", None, None),
    ("https://d", "{dct}publisher", "P", "literal", None, None),
    ("https://d", "{dct}license", "https://licence/L", "iri", None, None),
    ("https://d", "{dct}title", "Regions", "literal", "en", None),
    ("https://d", "{dct}title", "Regionen", "literal", "de", None),
    ("https://d", "{dct}description", "All of them", "literal", "en", None),
    ("https://d", "{dcat}keyword", "region", "literal", "en", None),
    ("https://d", "{dcat}keyword", "world", "literal", "en", None),
    ("https://d", "{dcat}keyword", "Welt", "literal", "de", None),
    ("https://d", "{dcat}theme", "{eu}data-theme/REGI", "iri", None, None),
    ("https://d", "{dct}language", "{eu}language/ENG", "iri", None, None),
    ("https://d", "{dcat}distribution", "https://d/t.csv", "iri", None, None),
    ("https://d/t.csv", "{rdf}type", "{dcat}Distribution", "iri", None, None),
    ("https://d/t.csv", "{dcat}downloadURL", "https://d/data/t.csv", "iri", None, None),
    ("https://d/t.csv", "{dcat}mediaType", "text/csv", "literal", None, None),
    ("https://d/t.csv", "{dcat}byteSize", "12345", "literal", None, "{xsd}integer"),
    ("https://d/t.csv", "{dct}license", "https://licence/L", "iri", None, None),
    ("https://d#idHash", "{rdf}type", "{rdf}Property", "iri", None, None),
    ("https://d#idHash", "{rdfs}label", "id_hash", "literal", None, None),
    ("https://d#idHash", "{rdfs}range", "{xsd}string", "iri", None, None),
    ("https://d#title", "{rdf}type", "{rdf}Property", "iri", None, None),
    ("https://d#title", "{rdfs}label", "title", "literal", None, None),
    ("https://d#title", "{rdfs}range", "{xsd}string", "iri", None, None),
    ("https://d/region", "{rdf}type", "{skos}ConceptScheme", "iri", None, None),
]
TRIPLES_SQL = f"""SELECT * FROM (VALUES {values(*(tuple(x.format(**NS) if isinstance(x, str) else x for x in t) for t in DATASET_SQL))}) AS t(s, p, o, kind, lang, datatype)
UNION ALL SELECT 'https://d/region/' || r_regionkey, '{NS["rdf"]}type', '{NS["skos"]}Concept', 'iri', NULL, NULL FROM region
UNION ALL SELECT 'https://d/region/' || r_regionkey, '{NS["skos"]}inScheme', 'https://d/region', 'iri', NULL, NULL FROM region
UNION ALL SELECT 'https://d/region/' || r_regionkey, '{NS["skos"]}prefLabel', r_name, 'literal', NULL, NULL FROM region"""


@query(TRIPLES_SQL)
def dataset_triples(spark, sf_dir):
    """The dataset in two languages, its files, columns and vocabularies."""
    return metadata.as_frame(spark, _dataset(spark, sf_dir))


@query(f"""
WITH t AS ({TRIPLES_SQL}),
o AS (SELECT *, row_number() OVER (ORDER BY s, p, o, kind, lang NULLS FIRST, datatype NULLS FIRST) AS n, lag(s) OVER (ORDER BY s, p, o, kind, lang NULLS FIRST, datatype NULLS FIRST) AS before FROM t),
w AS (SELECT n, CASE WHEN before IS NULL THEN '' WHEN s <> before THEN ' .' || chr(10) || chr(10) ELSE ' ;' || chr(10) || '    ' END || CASE WHEN before IS DISTINCT FROM s THEN '<' || s || '>' || chr(10) || '    ' ELSE '' END
|| '<' || p || '> ' || CASE WHEN kind = 'iri' THEN '<' || o || '>' ELSE '"' || o || '"' || coalesce('@' || lang, '^^<' || datatype || '>', '') END AS x FROM o)
SELECT string_agg(x, '' ORDER BY n) || ' .' || chr(10) AS turtle FROM w""")
def dataset_turtle(spark, sf_dir):
    """The same as Turtle, in a total order."""
    said = _dataset(spark, sf_dir)
    return spark.createDataFrame([(metadata.turtle(metadata.as_frame(spark, said[::-1])),)], "turtle string")


@query("""
WITH t AS (SELECT unnest(['<https://x/part/' || p_partkey || '>', '    <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/2004/02/skos/core#Concept> ;', '    <http://www.w3.org/2004/02/skos/core#prefLabel> "' || p_name || '"@en .']) AS line FROM part)
SELECT line, count(*)::BIGINT AS n FROM t GROUP BY 1 UNION ALL SELECT '', count(*) - 1 FROM part""")
def concepts_turtle(spark, sf_dir):
    """A concept for each part, written by executors as one file and read back line by line."""
    part, path = table(spark, sf_dir, "part"), f"{shared_folder(spark)}/parts.ttl"
    subject, none = F.concat(F.lit("https://x/part/"), F.col("p_partkey").cast("string")), F.lit(None).cast("string")
    said = lambda p, o, kind, lang: F.struct(subject.alias("s"), F.lit(metadata.expand(p)).alias("p"), o.alias("o"), F.lit(kind).alias("kind"), lang.alias("lang"), none.alias("datatype"))
    triples = part.select(F.explode(F.array(said("rdf:type", F.lit(metadata.expand("skos:Concept")), "iri", none), said("skos:prefLabel", F.col("p_name"), "literal", F.lit("en")))).alias("t")).select("t.*")
    metadata.write_turtle(triples, path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query(f"""
WITH t AS ({TRIPLES_SQL}) SELECT s AS node, replace(p, '{NS["rdf"]}type', '@type') AS p, o FROM t""")
def dataset_json_ld(spark, sf_dir):
    """The same as JSON-LD, read back node by node."""
    nodes = json.loads(metadata.json_ld(metadata.as_frame(spark, _dataset(spark, sf_dir))))
    rows = [(n["@id"], "@type" if p == NS["rdf"] + "type" else p, v.get("@id", v.get("@value"))) for n in nodes for p, values_ in n.items() if p != "@id" for v in values_]
    return spark.createDataFrame(rows, "node string, p string, o string")


@query(f"""
SELECT p_partkey, '{NS['eu']}country/' || p_type AS authority, CASE WHEN p_partkey % 2 = 0 THEN '{NS['skos']}' || p_name ELSE 'zz:' || p_name END AS expanded,
  'https://b#' || split_part(p_name, ' ', 1) || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS property FROM part""")
def curie_terms(spark, sf_dir):
    """IRIs of codes, prefixed names (unknown prefixes stay) and columns."""
    part = table(spark, sf_dir, "part")
    curie = F.concat(F.when(F.col("p_partkey") % 2 == 0, "skos:").otherwise("zz:"), "p_name")
    return part.select("p_partkey", metadata.authorities("country", F.col("p_type")).alias("authority"), metadata.expanded(curie).alias("expanded"), metadata.predicates("https://b", F.replace("p_name", F.lit(" "), F.lit("_"))).alias("property"))


FAULTS = [
    ("https://d: dct:title stands twice in one language",),
    ("https://d: dct:license is no iri",),
    ("https://d: dct:description stands 0 times, expected 1 to any",),
    ("https://d/t.csv: dcat:byteSize stands 2 times, expected 1 to 1",),
    ("https://d: dcat:distribution leads nowhere",),
    ("https://d#title: rdfs:label is empty",),
]


@query(f"SELECT * FROM (VALUES {values(*FAULTS)}) AS t(fault)")
def metadata_conformance(spark, sf_dir):
    """What metadata breaks of its shapes; sound metadata breaks nothing."""
    sound = _dataset(spark, sf_dir)
    assert not metadata.conformance(sound)
    lic, said, label = metadata.expand("dct:license"), metadata.expand("dct:description"), metadata.expand("rdfs:label")
    broken = [t for t in sound if not (t[0] == "https://d" and t[1] in (lic, said)) and not (t[0] == "https://d#title" and t[1] == label)]
    broken += [metadata.literal("https://d", "dct:license", "L"), metadata.literal("https://d", "dct:title", "Other", "en"), metadata.literal("https://d/t.csv", "dcat:byteSize", "7"), metadata.iri("https://d", "dcat:distribution", "https://none"), metadata.literal("https://d#title", "rdfs:label", "")]
    return spark.createDataFrame([(x,) for x in metadata.conformance(broken)], "fault string")


@query("SELECT c_custkey, replace(replace(replace(format('{:,.2f}', c_acctbal), ',', '_'), '.', ','), '_', '.') AS said FROM customer")
def german_numbers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", metadata.german(F.col("c_acctbal"), 2).alias("said"))


@query("""
SELECT r_regionkey::VARCHAR AS code, 'a &lt;b&gt; &amp; &quot;' || r_name || '&quot; &#x27;x&#x27;' AS cell, lang FROM region, (VALUES ('en'), ('de')) AS l(lang)""")
def landing_pages(spark, sf_dir):
    """The vocabulary page's cells in both languages, everything escaped."""
    import re

    labels = {"region": {str(r.r_regionkey): f"a <b> & \"{r.r_name}\" 'x'" for r in table(spark, sf_dir, "region").collect()}}
    about = metadata.About({"en": "Regions <all>", "de": "Regionen"}, publisher="P")
    page = metadata.vocabularies_page(about, labels)
    rows = []
    for lang, section in re.findall(r'<section lang="(\w+)">(.*?)</section>', page, re.S):
        rows += [(code, cell, lang) for code, cell in re.findall(r"<tr><td>(.*?)</td><td>(.*?)</td></tr>", section)]
    return spark.createDataFrame(rows, "code string, cell string, lang string")


NAMES = [n for n in QUERIES if n not in _BEFORE]


def queries() -> dict:
    return {n: QUERIES[n] for n in NAMES}


def oracle_sql() -> dict[str, str]:
    return {n: SQL[n] for n in NAMES if n in SQL}
