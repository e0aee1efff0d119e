"""Documents in, history, publication out; on a small tree of our own."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chronicle import catalog_io
from chronicle import model as m
from chronicle.operators import contract, history, linkage, segment
from chronicle.plans import lifecycle
from chronicle.plans.lifecycle import Plans
from chronicle.sinks import metadata
from chronicle.sources import files, xml

MODEL = m.Model(
    document_type="Scheme",
    fields=[
        m.Field("title", "t:title"),
        m.Field("keywords", "t:keywords", m.VALUE),
        m.Field("updated", "t:date", m.DATE),
        m.Field("rank", "t:rank", m.NUMBER),
        m.Field("contact", "t:contact", m.LINKS),
        m.Field("external", "t:external", m.LINKS),
        m.Field("area", "t:class", m.CLASSIFIED, "Area"),
        m.Field("place", "t:class", m.CLASSIFIED, "Place"),
        m.Field("sub_a", "t:sub", m.CLASSIFIED, "SubA"),
        m.Field("sub_b", "t:sub", m.CLASSIFIED, "SubB"),
    ],
    base_url="https://site",
    slug_after="Schemes/",
    contact="contact",
    external="external",
    coded=["area", "place", "sub_a", "sub_b"],
    aliases={"area": {"old": "new"}},
    pivots={"sub": [("a", "sub_a"), ("b", "sub_b")]},
    drop=["rank"],
    renames={"updated": "updated_at"},
    licence="L",
    publisher="P",
)
INDEX = [m.Field("title", "t:title"), m.Field("url", "t:url", m.VALUE), m.Field("city", "t:city", m.VALUE), m.Field("address", "t:address", m.LINKS), m.Field("website", "t:website", m.LINKS)]
X = 'xmlns:xlink="http://www.w3.org/1999/xlink"'


def links(*to):
    return "".join(f'<link xlink:href="{t}"/>' if t is not None else "<link/>" for t in to)


def prop(name, kind, body):
    return f'<property name="{name}" type="{kind}">{body}</property>'


def classified(*blocks):
    return "<classifiedLinkLists>" + "".join(f"<classifiedLinkList><classifierText/><classifierLinks>{links('/Common/' + c)}</classifierLinks><links>{links(*to)}</links></classifiedLinkList>" for c, to in blocks) + "</classifiedLinkLists>"


def doc(path, kind, *props):
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<document {X} name="{path.rsplit("/", 1)[-1]}" path="{path}" type="{kind}">{"".join(props)}</document>'


def rich(text):
    return f"<text>&lt;![CDATA[{text}]]&gt;</text>"


def scheme(path, title="&lt;p&gt;Tit\x02le &amp;amp; &lt;b&gt;more&lt;/b&gt;­&lt;/p&gt;", *more):
    return doc(path, "Scheme", prop("t:title", "RichText", rich(title)), *more)


@pytest.fixture()
def tree(tmp_path):
    def write(name, text):
        p = tmp_path / "export" / f"{name}.xml"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text, encoding="utf-8")

    write("s/one", scheme(
        "/Schemes/Sub/One", "&lt;p&gt;Tit\x02le &amp;amp; &lt;b&gt;more&lt;/b&gt;­&lt;/p&gt;",
        prop("t:keywords", "String", "<value>kleine Bäume und Wege, Test</value>"),
        prop("t:date", "Date", "<value>2024-02-30</value>"),
        prop("t:rank", "Long", "<value>x7</value>"),
        prop("t:contact", "LinkList", f"<links>{links('target:/c/1', 'target:/c/2')}</links>"),
        prop("t:external", "LinkList", f"<links>{links('target:/x/2', '/x/none', '/x/1', None)}</links>"),
        prop("t:class", "ClassifiedLinkLists", classified(("Area", ["/a/old", "/a/b", "/a/new"]), ("Place", ["/p/q"]), ("Area", ["/a/c"]), ("Odd", ["/z"]))),
        prop("t:sub", "ClassifiedLinkLists", classified(("SubB", ["/s/2"]), ("SubA", ["/s/1"]))),
    ))
    write("s/two", scheme("/Schemes/Two", "", prop("t:date", "Date", "<value>2024-02-03T04:05:06+01:00</value>"), prop("t:rank", "Long", "<value>7</value>"), prop("t:contact", "LinkList", "<links/>"), prop("t:title", "RichText", rich("last"))))
    write("s/three", scheme("/Schemes/Three", "third", prop("t:date", "Date", "<value>2024</value>")))
    write("x/1", doc("/x/1", "Link", prop("t:title", "RichText", rich("First")), prop("t:url", "String", "<value>https://one</value>")))
    write("x/2", doc("/x/2", "Link", prop("t:title", "RichText", rich("Second")), prop("t:url", "String", "<value>https://two</value>")))
    write("c/1", doc("/c/1", "Contact", prop("t:title", "RichText", rich("Office")), prop("t:address", "LinkList", f"<links>{links('target:/a/1')}</links>"), prop("t:website", "LinkList", f"<links>{links('target:/x/1')}</links>")))
    write("c/2", doc("/c/2", "Contact", prop("t:city", "String", "<value></value>"), prop("t:address", "LinkList", f"<links>{links('target:/a/1')}</links>"), prop("t:website", "LinkList", f"<links>{links('/w/none')}</links>")))
    write("a/1", doc("/a/1", "Address", prop("t:city", "String", "<value>Town</value>")))
    return str(tmp_path / "export"), write


def plans(spark, tmp_path, structure=None):
    return Plans(spark, MODEL, str(tmp_path / "store"), INDEX, ["Link", "Contact", "Address"], structure, "https://site")


def test_raw_table(spark, tree):
    root, _ = tree
    raw = xml.documents(xml.scan(spark, root), MODEL)
    assert raw.schema.names == MODEL.names() and dict(raw.dtypes) == {f.name: f.dataType.simpleString() for f in MODEL.raw_schema().fields}
    rows = {r["path"]: r for r in raw.collect()}
    one, two, three = (rows[f"/Schemes/{p}"] for p in ("Sub/One", "Two", "Three"))
    assert one["title"] == "Title & more" and two["title"] == "last"
    assert one["updated"] is None and three["updated"] is None and two["updated"].isoformat() == "2024-02-03T03:05:06"
    assert one["rank"] is None and two["rank"] == 7
    assert one["area"] == ["/a/old", "/a/b", "/a/new", "/a/c"] and one["place"] == ["/p/q"]
    assert one["external"] == ["target:/x/2", "/x/none", "/x/1", ""] and two["contact"] == [] and two["area"] == [] and two["keywords"] is None


def test_errors(spark, tree, tmp_path):
    with pytest.raises(ValueError, match="unknown fields: nope"):
        plans(spark, tmp_path).collect("/nowhere", ["nope"])
    (tmp_path / "void").mkdir()
    with pytest.raises(FileNotFoundError):
        xml.scan(spark, str(tmp_path / "void"))
    with pytest.raises(ValueError):
        m.Model("T", [m.Field("a", "a")], coded=["a"]).check()


def test_collect(spark, tree, tmp_path):
    root, _ = tree
    rows = {r["id_url"]: r for r in plans(spark, tmp_path).collect(root).collect()}
    one = rows["sub-one"]
    assert one["area"] == ["new", "b", "c"] and one["sub"] == ["a.1", "b.2"] and "rank" not in one and "updated_at" in one
    assert [tuple(x) for x in one["further_links"]] == [("https://two", "Second"), ("https://one", "First")] and rows["two"]["further_links"] == []
    assert one["contact_info_title"] == "Office" and one["contact_info_city"] == "Town" and rows["two"]["contact_info_title"] is None
    assert one["license_info"] == "Title & more von P, L, https://site/Schemes/Sub/One.html"
    assert plans(spark, tmp_path).collect(root, ["title"]).count() == 3


def test_address_keeps_an_empty_own_field(spark, tree, tmp_path):
    root, _ = tree
    p = plans(spark, tmp_path)
    rows = {r["href"]: r for r in p.index(xml.scan(spark, root)).collect()}
    assert rows["/c/1"]["city"] == "Town" and rows["/c/2"]["city"] is None
    assert rows["/c/1"]["website_url"] == "https://one" and rows["/c/2"]["website_url"] == "https://site/w/none.html" and rows["/a/1"]["website_url"] is None


def test_structure(spark, tree):
    root, write = tree
    derived = xml.derive_contract(xml.scan(spark, root))
    assert xml.violations(xml.scan(spark, root), derived).count() == 0
    write("bad/cut", scheme("/Schemes/Cut")[:-40])
    write("bad/cross", scheme("/Schemes/Cross").replace("</document>", "<a><b></a></b></document>"))
    write("bad/two", scheme("/Schemes/Two2") + "<document/>")
    write("bad/ref", scheme("/Schemes/Ref").replace("</document>", "&nope;</document>"))
    write("good/comment", scheme("/Schemes/Comment", "t") + "\n<!-- end <x> -->\n")
    write("bad/root", f"<other {X} name='n' path='p' type='Scheme'></other>")
    write("bad/attr", f"<document {X} name='n' type='Scheme'></document>")
    write("bad/type", doc("/t", "Unheard"))
    write("bad/prop", scheme("/Schemes/P", "t", prop("t:new", "String", "<value/>")))
    write("bad/prop2", scheme("/Schemes/P2", "t", prop("t:new", "String", "<value/>")))
    write("bad/kind", scheme("/Schemes/K", "t", prop("t:rank", "String", "<value/>")))
    write("bad/child", scheme("/Schemes/C", "t", prop("t:rank", "Long", "<value/><text/>")))
    write("bad/none", scheme("/Schemes/N", "t", prop("t:date", "Date", "")))
    found = contract.most_common(xml.violations(xml.scan(spark, root), derived)).collect()
    said = [r["message"] for r in found]
    assert len(said) == 8 and found[0]["n"] == 4 and "not parseable" in said[0] and found[1]["n"] == 2 and "unknown property t:new" in said[1] and len(found[1]["examples"]) == 2
    for part in ("not parseable", "root element is <other>", "lacks attributes path", "unknown document type Unheard", "t:rank is String, expected Long", "children [text, value]", "t:date has children []"):
        assert any(part in s for s in said), part
    with pytest.raises(contract.ContractError, match="2 times"):
        contract.refuse(xml.violations(xml.scan(spark, root), derived))


def test_walk_over_tags(spark):
    """Crossing, nesting and children in one fold: equal names nested, tags in attributes, comments and character data."""
    wrap = lambda body: f"<document name='n'>{body}</document>"
    cases = {
        wrap("<property name='a' type='String'><value>x</value></property>"): (True, [("a", "String", ["value"])]),
        wrap("<property note=\"type='Odd' > name='b'\" type='RichText' name=\"it's\"><text><text><value/></text></text></property>"): (True, [("it's", "RichText", ["text"])]),
        wrap("<property name='a' type='X'><![CDATA[</property><b>]]><!-- <value> --><text/><text>&lt;p&gt;</text><other/></property><property/>"): (True, [("a", "X", ["text", "text", "other"]), (None, None, [])]),
        wrap("<x><property name='deep'/></x>"): (True, []),
        wrap("<größe a='1'>ü</größe>"): (True, []),
        wrap("<a><b></a></b>"): (False, None),
        wrap("<a>"): (False, None),
        wrap("</a>"): (False, None),
        wrap("1 < 2"): (False, None),
        wrap("<a b=c/>"): (False, None),
        wrap("") + "<more/>": (False, None),
        wrap("") + "<!-- <more> -->": (True, []),
        "<document/>": (True, []),
        "no tags": (False, []),
        "": (False, []),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "value string").select("value", xml.walked(F.col("value")).alias("w")).collect()
    for r in rows:
        sound, props = cases[r["value"]]
        assert r["w"]["sound"] == sound, r["value"]
        assert props is None or [(p["name"], p["type"], p["children"]) for p in r["w"]["props"]] == props, r["value"]


def test_documents_are_made_and_parsed_once(spark):
    """Structure, its most common faults and the contract: one branch of the plan each, with nothing beside the exploded rows."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        made.add(1)
        return x

    rows = spark.createDataFrame([(f"f{i}", doc(f"/p/{i}", "Scheme", prop("t:a", "String", "<value/>"), prop("t:b", "Long", "<text/>" if i % 2 else "<value/>")).replace("</document>", "" if i == 0 else "</document>")) for i in range(20)], "file string, value string")
    scanned = xml.parsed(rows.select("file", seen("value").alias("value")))
    allowed = xml.derive_contract(scanned)
    assert sorted(map(tuple, allowed.collect())) == [("Scheme", "t:a", "String"), ("Scheme", "t:b", "Long")] and made.value == 20
    found = contract.most_common(xml.violations(scanned, allowed)).collect()
    assert [(r["n"], r["examples"]) for r in found] == [(10, ["f1", "f11", "f13"]), (1, ["f0"])] and made.value == 40


def test_a_contract_reads_heads_of_properties_only(spark):
    """One parse, of no more than types and names; what a property holds doesn't matter, and a document that can't be parsed says nothing."""
    odd = ["<links>x</links>", "<value>a<b/></value><value/>", "text", "<classifiedLinkLists>t</classifiedLinkLists>", '<property name="t:inner" type="Blob"/>', "<!-- <property name='t:said' type='Long'/> -->"]
    texts = [doc(f"/p/{i}", "Scheme", prop(f"t:{i}", "String", x)) for i, x in enumerate(odd)]
    broken = doc("/p/b", "Scheme", prop("t:b", "Long", ""), prop("t:c", "ClassifiedLinkLists", "<classifiedLinkLists><classifiedLinkList>"))
    halves = [doc("/p/h", "Scheme", prop("t:d", "Long", ""), prop("t:e", "Long", x)) for x in ("&nope;", "<value></x></value>")]  # the parser gives what stands before
    rows = spark.createDataFrame([(str(i), x) for i, x in enumerate([*texts, broken, *halves, texts[0][:-20], "", None])], "file string, value string")
    derived = xml.derive_contract(xml.parsed(rows))
    assert sorted(map(tuple, derived.collect())) == [("Scheme", f"t:{i}", "String") for i in range(len(odd))]
    plan = derived._jdf.queryExecution().optimizedPlan().toString()
    plan = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert plan.count("from_xml(") == 1 and "classifierLinks" not in plan


def test_documents_of_short_rows_are_dealt_out(spark):
    """The customers' bytes fit one task, their documents don't."""
    docs = catalog_io.customers_as_xml(spark, "/root/testdata/sf0.1")
    assert docs.rdd.getNumPartitions() >= 6


MONDAY = 1704682800.0  # 2024-01-08 03:00 UTC
WEEK = 7 * 86400


def test_load_publish_build(spark, tree, tmp_path):
    root, write = tree
    derived = xml.derive_contract(xml.scan(spark, root))
    p = plans(spark, tmp_path, spark.createDataFrame(derived.collect(), derived.schema))
    p.load(root, MONDAY, segment.rule_scorer, "r1")
    p.load(root, MONDAY + WEEK, segment.rule_scorer, "r1")  # nothing new
    assert p.versions().count() == 3 and p.segments().count() == 1
    write("s/three", scheme("/Schemes/Three", "changed", prop("t:date", "Date", "<value>2024</value>")))
    Path(root, "s/two.xml").unlink()
    p.load(root, MONDAY + 2 * WEEK, segment.rule_scorer, "r2")
    assert p.versions().count() == 4 and p.live().count() == 2 and p.segments().first()["revision"] == "r2"
    rows = {r["id_url"]: r for r in p.publish().collect()}
    assert rows["three"]["title"] == "changed" and rows["three"]["previous_update_dates"] == ["2024-W03"] and rows["three"]["last_updated"] == "2024-W03"
    assert rows["two"]["absent"] and rows["two"]["on_website_to"] == "2024-W03" and not rows["sub-one"]["absent"] and rows["sub-one"]["on_website_to"] is None
    assert rows["sub-one"]["on_website_from"] == "2024-W02" and rows["sub-one"]["keywords_extracted"] == ["kleine Bäume und Wege", "Test"]
    (tmp_path / "LICENCE").write_text("L")
    about = metadata.About({"en": "Schemes", "de": "Programme"}, publisher="P", licence="https://licence/L")
    build = lambda: p.build(str(tmp_path / "dist"), about=about, licence_file=str(tmp_path / "LICENCE"))
    names = build()
    assert {"LICENCE", "index.html", "columns.html", "vocabularies.html", "dataset.ttl"} <= set(names) and "LICENCE" in Path(tmp_path, "dist/index.html").read_text()
    before = {n: Path(tmp_path, "dist", n).read_bytes() for n in names}
    with open(tmp_path / "dist/table.csv", encoding="utf-8", newline="") as f:
        back = {r["id_url"]: r for r in csv.DictReader(f)}
    assert json.loads(back["sub-one"]["sub"]) == ["a.1", "b.2"] and json.loads(back["sub-one"]["further_links"])[0]["title"] == "Second" and back["two"]["keywords"] == ""
    build()
    assert before == {n: Path(tmp_path, "dist", n).read_bytes() for n in names}


def test_loads_are_whole(spark, tree, tmp_path, monkeypatch):
    """A load that fails on its way changes nothing: no version without its ledger row; closed windows aren't rewritten; a repeated href is refused."""
    root, write = tree
    p = plans(spark, tmp_path)
    p.load(root, MONDAY)
    _, held = p.store.current()
    write("s/three", scheme("/Schemes/Three", "changed"))
    monkeypatch.setattr(Plans, "_recorded", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        p.load(root, MONDAY + WEEK)
    monkeypatch.undo()
    assert p.store.current()[1] == held and p.versions().count() == 3
    p.load(root, MONDAY + WEEK)
    closed = p.store.current()[1]["versions/closed"]
    write("s/three", scheme("/Schemes/Three", "again"))
    p.load(root, MONDAY + 2 * WEEK)
    assert p.store.current()[1]["versions/closed"][:1] == closed and len(p.store.current()[1]["versions/closed"]) == 2 and p.versions().count() == 5
    write("c/3", doc("/c/1", "Contact", prop("t:title", "RichText", rich("Twice"))))
    with pytest.raises(history.HistoryError, match="href is not unique: /c/1"):
        p.load(root, MONDAY + 3 * WEEK)


def test_the_folded_history_is_maintained(spark, tree, tmp_path):
    """After each load the publication equals a full fold, of loads that were published and ones that weren't."""
    root, write = tree
    p = plans(spark, tmp_path)
    for i in range(40):
        write(f"s/n{i}", scheme(f"/Schemes/N{i}", "n"))
    folded = []
    for k, at in enumerate([0, WEEK, WEEK + 3600]):
        write("s/three", scheme("/Schemes/Three", f"title {k}"))
        if k == 1:
            Path(root, "s/two.xml").unlink()
        p.load(root, MONDAY + at)
        want = history.fold(p.versions(), "path", p.checkpoints()).drop("row_hash")
        got = p.snapshot()
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        if k != 1:
            folded.append(p.advance())
            assert sorted(map(repr, p.snapshot().collect())) == sorted(map(repr, want.collect()))
    assert folded[0] == 43 and max(folded[1:]) <= 2 and p.advance() == 0
    held = p.store.current()[1]
    assert len(held["folded/base"]) == 1 and len(held["folded/delta"]) == 1


def test_cache_answers(spark, tree, tmp_path, monkeypatch):
    """What the cache has isn't asked for again; another revision is another answer."""
    root, write = tree
    asked = spark.sparkContext.accumulator(0)

    def scorer(batch):
        asked.add(len(batch))
        return segment.rule_scorer(batch)

    p = plans(spark, tmp_path)
    p.load(root, MONDAY, scorer, "r1")
    n = asked.value
    assert n == 1 and p.segments().count() == 1
    base, _ = p.store.current()
    p.store.commit(base, {"segments": []})  # lost segments come back from the cache
    assert p.segment(scorer, "r1", MONDAY + 1) == 1 and asked.value == n and p.segments().first()["terms"] == ["kleine Bäume und Wege", "Test"]
    before = p.store.current()[1]
    assert p.segment(scorer, "r2", MONDAY + 2) == 1 and asked.value == n + 1
    after = p.store.current()[1]
    assert all(after[t][:-1] == before[t] for t in ("cache", "segments")) and p.segments().count() == 1  # appended
    monkeypatch.setattr(lifecycle, "MOST_PARTS", 1)

    class Redeployed:
        """A service that is another one by the time it answers."""

        def answers(self, batch):
            return [(p, "r4", "m") for p in segment.rule_scorer(batch)]

    assert p.segment(Redeployed(), "r3", MONDAY + 3) == 1 and p.segments().first()["revision"] == "r4"
    assert {r["revision"] for r in p.store.read("cache", lifecycle.CACHE).collect()} == {"r1", "r2", "r4"}
    assert [len(p.store.current()[1][t]) for t in ("cache", "segments")] == [1, 1]  # made into one
    assert p.segment(scorer, "r4", MONDAY + 4) == 0


def test_a_load_parses_once(spark, tree, tmp_path):
    root, _ = tree
    plan = xml.documents(xml.scan(spark, root).persist(), MODEL)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan
    spark.catalog.clearCache()


def test_guards_leave_the_history_alone(spark, tree, tmp_path):
    root, write = tree
    p = plans(spark, tmp_path)
    for i in range(110):
        write(f"s/n{i}", scheme(f"/Schemes/N{i}", f"n{i}"))
    p.load(root, MONDAY)
    for i in range(60):
        Path(root, f"s/n{i}.xml").unlink()
    with pytest.raises(history.HistoryError, match="live"):
        p.load(root, MONDAY + WEEK)
    assert p.live().count() == 113
    write("s/again", scheme("/Schemes/N100", "other"))
    for i in range(60):
        write(f"s/n{i}", scheme(f"/Schemes/N{i}", f"n{i}"))
    with pytest.raises(history.HistoryError, match="not unique: /Schemes/N100"):
        p.load(root, MONDAY + WEEK)
    assert p.versions().count() == 113
    with pytest.raises(history.HistoryError):
        history.refuse_shrinkage(0, 0)
    history.refuse_shrinkage(99, 1)
    with pytest.raises(history.HistoryError, match="new \\['b'\\]"):
        history.refuse_drift(spark.createDataFrame([(1, 2)], "a int, b int"), ["a"])


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x ""y""\nz"\n2,\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv")).orderBy("k").collect()] == [("1", 'x "y"\nz'), ("2", None)]
    (tmp_path / "b.csv").write_text("k,v\n1,2.5\n", encoding="utf-8")
    assert files.read_csv(spark, str(tmp_path / "b.csv"), infer=True).dtypes == [("k", "int"), ("v", "double")]
    (tmp_path / "a.jsonl").write_text('{"slug":"s","tokens":["a","b"]}\n', encoding="utf-8")
    assert files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "slug string, tokens array<string>").first()["tokens"] == ["a", "b"]
    assert files.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "l.xml").write_text('<gc:CodeList xmlns:gc="x"><SimpleCodeList><Row><Value ColumnRef="code"><SimpleValue>10</SimpleValue></Value><Value ColumnRef="label"><SimpleValue>ten</SimpleValue></Value></Row><Row><Value ColumnRef="code"><SimpleValue>2</SimpleValue></Value><Value ColumnRef="name"><SimpleValue>two</SimpleValue></Value></Row></SimpleCodeList></gc:CodeList>', encoding="utf-8")
    assert [tuple(r) for r in files.genericode(spark, str(tmp_path / "l.xml")).collect()] == [("2", "two"), ("10", "ten")]
    cells = files.label_cells(spark.createDataFrame([("<td>a</td><td>A</td><td>b</td><td>B</td>",), ("x",)], "value string"))
    assert sorted(map(tuple, cells.collect())) == [("a", "A"), ("b", "B")]
    got = files.with_fallback(spark.createDataFrame([("a",), ("c",), ("d",)], "key string"), cells, spark.createDataFrame([("a", "no"), ("c", "C")], "key string, label string"))
    assert sorted(map(tuple, got.collect()), key=str) == [("a", "A"), ("c", "C"), ("d", None)]
    assert files.drifted({"x": "2023-1", "y": "1"}, {"x": "2024-0", "y": "1"}) == {"x": ("2023-1", "2024-0")}
    (tmp_path / "registry.json").write_text('[{"identifier": "x", "version": "2"}, {"identifier": "x", "version": "1"}]', encoding="utf-8")
    assert files.registry((tmp_path / "registry.json").as_uri()) == {"x": "2"}
    with files.export("unused", str(tmp_path)) as d:
        assert d == str(tmp_path)
    import zipfile

    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("s/a.xml", "<a/>")
    with files.export((tmp_path / "e.zip").as_uri()) as d:
        assert Path(d, "s/a.xml").read_text() == "<a/>"
    assert not Path(d).exists()
    with files.export((tmp_path / "e.zip").as_uri(), spark=spark, shared=str(tmp_path / "shared")) as d:
        assert spark.read.text(f"{d}/s").count() == 1 and str(tmp_path / "shared") in d
    assert list((tmp_path / "shared").glob("export-*")) == []


def test_first_link_by(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "k int, o int, v string")
    assert linkage.first_by(rows, "k", F.col("o")).first()["v"] == "a"
