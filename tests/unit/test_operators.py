"""Contract, segmentation, code lists, reports, samples, metadata, streams."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.model import Field, Model
from chronicle.operators import analytics, codelists, contract, linkage, sampling, segment, shape
from chronicle.sinks import metadata, tables
from chronicle.sources import endpoint
from chronicle.streaming import streams


def value(spark, column):
    return spark.range(1).select(column.alias("r")).first()["r"]


def texts(*x):
    return F.array(*(F.lit(v) for v in x)).cast("array<string>")


# ---------------------------------------------------------------- contract


@pytest.mark.parametrize(
    "keywords,terms,want",
    [
        ("A b, C", ["A b", "C"], True),
        ("(A) b", ["A", "b"], True),
        ("A b", ["A", "b", "c"], False),
        ("A b", ["A"], False),
        ("A b", ["b", "A"], False),
        ("A b", ["A B"], False),
        (None, [], True),
        (None, ["A"], False),
        ("A", None, True),
        (None, None, True),
    ],
)
def test_span_partition(spark, keywords, terms, want):
    df = spark.createDataFrame([(keywords, terms)], "k string, t array<string>")
    assert df.select(contract.partition_holds(F.col("k"), F.col("t"))).first()[0] is want


def test_report_and_enforce(spark):
    rows = [(1, "a", [("https://x", "t")]), (2, None, [None]), (2, "b ", [])]
    df = spark.createDataFrame(rows, "id int, name string, links array<struct<url:string,title:string>>")
    checks = [contract.not_null("name"), contract.cleaned("name"), contract.elements("links", lambda e: e["url"].startswith("http")), contract.matches("id", "^[12]$"), contract.in_vocabulary("name", ["a"]), contract.spans("gone", "name")]
    got = {(r["column_name"], r["check_name"]): (r["n_rows"], r["n_failed"]) for r in contract.report(df, checks, ["id"]).collect()}
    assert got == {("name", "not_null"): (3, 1), ("name", "cleaned"): (3, 1), ("links", "elements"): (3, 1), ("id", "pattern"): (3, 0), ("name", "vocabulary"): (3, 1), ("id", "unique"): (3, 2)}
    with pytest.raises(contract.ContractError, match="not_null.*id: 2 of 3 rows fail unique"):
        contract.enforce(df, df.schema, checks, ["id"])
    assert contract.enforce(df.where("id = 1"), df.schema, checks, ["id"]).count() == 1
    faults = contract.schema_faults(df, T.StructType([T.StructField("id", T.LongType()), T.StructField("z", T.StringType())]))
    assert faults == ["missing column z", "undeclared column name", "undeclared column links", "id is int, declared bigint"]
    shown = {(r["check_name"]): r["examples"] for r in contract.offenders(df, checks, "id").collect()}
    assert shown["not_null"] == ["2"] and "pattern" not in shown


def test_messages(spark):
    rows = [("m", f"f{i}") for i in range(9)] + [("n", "f1")]
    got = contract.most_common(spark.createDataFrame(rows, "message string, file string")).collect()
    assert [(r["message"], r["n"], r["examples"]) for r in got] == [("m", 9, ["f0", "f1", "f2"]), ("n", 1, ["f1"])]
    w = contract.first_examples(spark.createDataFrame(rows, "message string, file string"), ["message"], "file")
    assert "WindowGroupLimit" in w._jdf.queryExecution().executedPlan().toString()  # no task gathers a message's examples
    null = contract.first_examples(spark.createDataFrame([(None, "a"), (None, "a"), ("m", None)], "message string, file string"), ["message"], "file")
    assert sorted(((r["message"], r["n"], r["examples"]) for r in null.collect()), key=str) == [("m", 1, []), (None, 2, ["a"])]
    assert contract.header_faults(["a", "c"], ["a", "b"]) == ["missing: b", "extra: c"] and contract.header_faults(["b", "a"], ["a", "b"]) == ["columns are out of order"] and contract.header_faults(["a"], ["a"]) == []


# ---------------------------------------------------------------- segmentation


def test_partitions(spark):
    flags = lambda *x: F.array(*(F.lit(v) for v in x)).cast("array<boolean>")
    sizes = lambda *x: F.array(*(F.lit(v) for v in x)).cast("array<int>")
    assert value(spark, segment.joins_to_sizes(flags(True, False, True))) == [2, 2] and value(spark, segment.joins_to_sizes(flags())) == [1]
    for s in ([1], [3], [1, 2, 1], [2, 2]):
        assert value(spark, segment.joins_to_sizes(segment.sizes_to_joins(sizes(*s)))) == s
    assert [tuple(r) for r in value(spark, segment.spans(sizes(2, 1)))] == [(0, 2), (2, 3)]
    assert value(spark, segment.sizes_from_spans(segment.spans(sizes(2, 1)))) == [2, 1]
    assert value(spark, segment.is_partition(sizes(2, 1), F.lit(3))) and not value(spark, segment.is_partition(sizes(2, 0, 1), F.lit(3))) and not value(spark, segment.is_partition(sizes(), F.lit(0)))
    assert value(spark, segment.terms(texts("(a", "b),", ";"), sizes(2, 1))) == ["a b"]
    assert value(spark, segment.bio(sizes(2, 1))) == [0, 1, 0]


@pytest.mark.parametrize("words,joins,want", [(["Wohnen,", "und", "Verkehr"], [False, False], [False, True]), (["Haus", "und", "Hof"], [False, False], [True, True]), (["a", "b"], [True], [True]), (["der"], [], [])])
def test_glue(spark, words, joins, want):
    assert value(spark, segment.glued(texts(*words), F.array(*map(F.lit, joins)).cast("array<boolean>"))) == want


def test_decode(spark):
    probs = lambda *x: F.array(*map(F.lit, x)).cast("array<double>")
    assert value(spark, segment.decoded(texts("(a)"), probs()))["terms"] == ["(a)"]
    got = value(spark, segment.decoded(texts("a", "b", "c"), probs(0.5)))
    assert got["terms"] == ["a b", "c"] and got["sizes"] == [2, 1]


def test_scores(spark):
    rows = spark.createDataFrame([([1, 1], [2]), ([2], [2]), ([3], [1, 1])], "p array<int>, g array<int>")
    r = segment.pooled(rows.select(segment.score(F.col("p"), F.col("g")).alias("score")), []).first()
    assert (r["hits"], r["support"], r["precision"], r["recall"]) == (1, 4, 1.0, 0.25) and r["precision_strict"] == pytest.approx(1 / 3)
    sweep = {round(x["threshold"], 2): x for x in segment.sweep(spark.createDataFrame([([0.4, 0.9], [1, 2]), ([], [1, 1])], "p array<double>, g array<int>"), "p", "g").collect()}
    assert len(sweep) == 19 and sweep[0.5]["f1"] == 1.0 and sweep[0.3]["hits"] == 2
    many, r = [], random.Random(2)
    for _ in range(60):
        gold = [r.randint(1, 4) for _ in range(r.randint(0, 5))]
        n = max(0, sum(gold) - 1) if r.random() < 0.9 else r.randint(1, 4)
        many.append(([None if r.random() < 0.05 else round(r.random(), 2) for _ in range(n)] if r.random() < 0.9 else [], gold))
    df = spark.createDataFrame(many, "p array<double>, g array<int>")
    got = {round(x["threshold"], 2): (x["hits"], x["support"], x["precision"], x["precision_strict"], x["recall"]) for x in segment.sweep(df, "p", "g").collect()}
    for t, x in got.items():  # each threshold on its own, by segmenting anew
        cut = F.when(F.size("p") == 0, F.array_repeat(F.lit(1), segment.total(F.col("g")))).otherwise(segment.joins_to_sizes(F.transform("p", (lambda t: lambda p: F.coalesce(p >= t, F.lit(False)))(t))))
        w = segment.pooled(df.select(segment.score(cut, F.col("g")).alias("score")), []).first()
        assert x == (w["hits"], w["support"], w["precision"], w["precision_strict"], w["recall"]), t
    acc = segment.gap_accuracy(spark.createDataFrame([([True, False], [True, True])], "p array<boolean>, g array<boolean>"), "p", "g")
    assert acc.first()[0] == 0.5


def test_labels(spark):
    rows = [("grüne Dächer, Solar",), ("no delimiter here",), ("one two three four, x",), ("land- und Wege; b (c; Haus Hof,",), (",",)]
    got = {r["v"]: (r["tokens"], r["labels"]) for r in segment.distant(spark.createDataFrame(rows, "v string"), "v").collect()}
    assert got == {rows[0][0]: (["grüne", "Dächer", "Solar"], [0, 1, 0]), rows[3][0]: (["land-", "und", "Wege", "b", "(c", "Haus", "Hof"], [0, 1, 1, 0, 1, 0, 0])}
    stats = segment.label_stats(spark.createDataFrame([([0, 1],), ([0],)], "labels array<int>")).first()
    assert tuple(stats) == (2, 3, 1, 0.3333) and segment.label_stats(spark.createDataFrame([], "labels array<int>")).first()["inside_rate"] == 0
    gold = spark.createDataFrame([(["a", "b"], [2], "train"), (["c"], [1], "test")], "tokens array<string>, group_sizes array<int>, split string")
    assert segment.split_rows(gold, "train").first()["labels"] == [0, 1]
    assert value(spark, segment.is_prose(F.lit("x, auf der Reise durch Berlin"))) and not value(spark, segment.is_prose(F.lit("Urlaub auf dem Bauernhof")))
    assert value(spark, segment.uncertain_gaps(F.array(F.lit(0.1), F.lit(0.2), F.lit(0.8)))) == [1, 2]
    assert value(spark, segment.cut_compounds(texts("Bau", "kleine", "Häuser"), F.array(F.lit(0.1), F.lit(0.9)))) == [0]


def test_scorer(spark):
    values = spark.createDataFrame([("kleine Häuser",), ("kleine Häuser",), ("x",), (None,)], "keywords string")
    got = {r["keywords"]: r["probabilities"] for r in segment.scored(values, "keywords", segment.rule_scorer).collect()}
    assert got == {"kleine Häuser": [0.95], "x": []}
    with pytest.raises(Exception, match="0 answers to 1 values"):
        segment.scored(values, "keywords", lambda batch: []).collect()
    stored = spark.createDataFrame([("x", None), ("kleine Häuser", "r1")], "keywords string, revision string")
    assert [r[0] for r in segment.stale(values, stored, "keywords", "r1").collect()] == ["x"]
    assert segment.revision_of(b"a", b"b").count(".") == 1
    cache = spark.createDataFrame([("kleine Häuser", [0.5])], "k string, probabilities array<double>").select(segment.cache_key(F.col("k"), "r1").alias("key"), "probabilities")
    hit, miss = segment.cached(values, cache, "keywords", "r1")
    assert [r["keywords"] for r in hit.collect()] == ["kleine Häuser"] and [r["keywords"] for r in miss.collect()] == ["x"] and segment.cached(values, cache, "keywords", "r2")[1].count() == 2


# ---------------------------------------------------------------- code lists


def test_codelists(spark):
    cats = spark.createDataFrame([("c", "l", "a", "Apples & Pears"), ("c", "l", "b", "Plums"), ("c", "l", "n", "None"), ("c", "l", "u", "Unknown")], "column string, codelist string, code string, label string")
    codes = spark.createDataFrame([("l", "10", "apples und pears"), ("l", "9", "Apples and"), ("l", "7", "Apples-und Pears")], "codelist string, code string, label string")
    hand = spark.createDataFrame([("c", "b", "10"), ("c", "b", "9")], "column string, code string, match string")
    none = spark.createDataFrame([("c", "n")], "column string, code string")
    got = codelists.align(cats, codes, hand, none)
    assert [(r["code"], r["match"], r["source"]) for r in codelists.matches(got).collect()] == [("a", "7", "label"), ("b", "10", "manual"), ("b", "9", "manual"), ("n", None, "no match"), ("u", None, None)]
    with pytest.raises(codelists.Undecided, match="c.u"):
        codelists.decided(got)
    rows = spark.createDataFrame([(["n", "n", "a"],), (["n"],)], "x array<string>")
    assert [(r["code"], r["n"]) for r in codelists.unmatched(got, rows, {"c": "x"}).collect()] == [("n", 2), ("u", 0)]
    assert value(spark, codelists.code_uri("h/{code}", F.lit(None).cast("string"))) is None


# ---------------------------------------------------------------- reports, samples, shape


def test_reports(spark):
    df = spark.createDataFrame([(1, "a", ["x"], None), (2, None, [], None), (3, "a", None, None)], "k int, s string, l array<string>, n string")
    assert {r["column"]: r["n_filled"] for r in analytics.fill_rates(df).collect()} == {"k": 3, "s": 2, "l": 1, "n": 0}
    assert [r[0] for r in analytics.never_filled(df).collect()] == ["n"] and [r[0] for r in analytics.sparse(df, 0.5).collect()] == ["n", "l"]
    assert [(r["value"], r["n"]) for r in analytics.value_counts(df, "s").collect()] == [("a", 2), (None, 1)]
    assert [r["column"] for r in analytics.constant_columns(df, ["k", "s", "n"]).collect()] == ["n"]
    assert analytics.json_list_columns(spark.createDataFrame([("[1]", "x"), (None, None)], "a string, b string")) == ["a"]
    assert {(r["column"], r["n_filled"], r["n_values"]) for r in analytics.single_valued_lists(df, ["l"]).collect()} == {("l", 1, 1)}
    paths = spark.createDataFrame([(["a.1", "b.1", "a.2"],)], "p array<string>")
    assert analytics.shared_children(paths, "p").first()["child"] == "1" and tuple(analytics.lost_without_parent(paths, "p").first()) == (3, 2)
    assert analytics.stubs(df, ["s", "l", "n"]).first()["k"] == 2


def test_samples(spark):
    df = spark.range(100).withColumn("s", F.when(F.col("id") < 3, "few").otherwise("many"))
    a = [r["id"] for r in sampling.sample(df, "id", 10, 1).orderBy("draw").collect()]
    assert a == [r["id"] for r in sampling.sample(df.repartition(7), "id", 10, 1).orderBy("draw").collect()] and a != [r["id"] for r in sampling.sample(df, "id", 10, 2).orderBy("draw").collect()]
    assert sampling.split(sampling.sample(df, "id", 10, 1), 4).where("split = 'test'").count() == 4
    strata = sampling.stratified(df, "id", F.col("s"), 5)
    assert strata.groupBy("stratum").count().orderBy("stratum").collect() == [("few", 3), ("many", 5)] and sampling.under_filled(strata, ["few", "many"], 5) == ["few"]
    pool = sampling.pooled_sample(df, "id", F.col("s"), 5, F.col("id") % 10 == 0, 4, [50, 51])
    assert pool.count() == pool.select("id").distinct().count() and pool.where("pool = 'named'").count() == 2
    assert sampling.first_seen(spark.createDataFrame([("a", 2), ("b", 1), ("a", 0)], "v string, p int"), "v", "p").orderBy("p").collect() == [("a", 0), ("b", 1)]


def test_shape(spark):
    schema = T.StructType([T.StructField("l", T.ArrayType(T.StringType())), T.StructField("n", T.LongType()), T.StructField("z", T.StringType())])
    assert shape.retyped(spark.createDataFrame([('["a"]', "7")], "l string, n string"), schema).first() == (["a"], 7, None)
    parents = spark.createDataFrame([("p", "v"), ("q", "v")], "parent string, vocab string")
    children = spark.createDataFrame([("v", "1"), ("v", "2")], "vocab string, code string")
    assert [r[0] for r in shape.pivot_paths(parents, children).collect()] == ["p.1", "p.2", "q.1", "q.2"]
    assert "BroadcastHashJoin" not in linkage.small(spark.range(10))._jdf.queryExecution().toString()


# ---------------------------------------------------------------- sinks and metadata


def test_cells_and_swap(spark, tmp_path):
    df = spark.createDataFrame([(1, [("a", None)], [datetime(2024, 1, 2)], None)], "k int, s array<struct<x:string,y:string>>, t array<timestamp>, n array<string>")
    row = tables.cells(df).first()
    assert json.loads(row["s"]) == [{"x": "a", "y": None}] and json.loads(row["t"])[0].startswith("2024-01-02T") and row["n"] is None
    path = str(tmp_path / "t")
    tables.swap(spark.range(3), path)
    tables.swap(spark.read.parquet(path).where("id > 0"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]
    tables.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "j"))
    assert "".join(p.read_text() for p in (tmp_path / "j").glob("part-*")) == '{"a":1,"b":null}\n'
    tables.write_text(spark, str(tmp_path / "LICENCE"), "L")
    assert tables.copy_beside(spark, str(tmp_path / "LICENCE"), str(tmp_path / "j")) == "LICENCE" and (tmp_path / "j/LICENCE").read_text() == "L"
    assert tables.sizes(spark, str(tmp_path), {"LICENCE": "text/plain", "none": "x"}) == {"LICENCE": ("text/plain", 1)}


def test_metadata(spark, tmp_path):
    model = Model("T", [Field("raw_a", "a", description="it's <a>")], renames={"raw_a": "the_a"}, vocabularies={"the_a": ["x"]})
    columns = metadata.contract(T.StructType([T.StructField("the_a", T.StringType()), T.StructField("l", T.ArrayType(T.StringType())), T.StructField("m", T.LongType())]), model, inferred=["m"], required=["the_a"])
    assert [c.origin for c in columns] == ["upstream", "derived", "inferred"] and metadata.export_field("the_a", model) == "raw_a"
    assert metadata.describe(spark, columns).count() == 3
    said = metadata.table_schema(columns, "https://b", "the_a")["tableSchema"]["columns"]
    assert said[0]["propertyUrl"] == "https://b#theA" and said[0]["required"] and [c["datatype"] for c in said] == ["string", "json", "integer"]
    assert metadata.range_of(columns[0]).endswith("#Concept") and metadata.authority("s", "c").endswith("/s/c")
    about = metadata.About({"en": 'T "q" <b>', "de": "Titel"}, {"en": "d"}, {"en": ["k"], "de": ["w"]}, "p", "https://l")
    triples = metadata.dataset_triples("https://d", about, {"b.csv": ("text/csv", 5), "a.csv": ("text/csv", 6)}) + metadata.vocabulary_triples("https://b", columns, {"v": {"x": "X"}})
    ttl, ld = metadata.turtle(metadata.as_frame(spark, triples)), metadata.json_ld(metadata.as_frame(spark, triples))
    for rows, name in ((triples, "some"), (triples + [metadata.literal("https://a/\u00e9\n\"", "dct:title", x, lang) for x in ('"q"\\', "a\nb", "\u00fc") for lang in ("de", "")], "odd"), ([], "none")):
        frame = metadata.as_frame(spark, rows).repartition(3)
        metadata.write_turtle(frame, str(tmp_path / f"{name}.ttl"))
        metadata.write_json_ld(frame, str(tmp_path / f"{name}.jsonld"))
        assert (tmp_path / f"{name}.ttl").read_text(encoding="utf-8") == metadata.turtle(frame)
        assert (tmp_path / f"{name}.jsonld").read_text(encoding="utf-8") == metadata.json_ld(frame)
    assert sorted(p.name for p in tmp_path.glob("[!.]*")) == sorted(f"{n}.{e}" for n in ("some", "odd", "none") for e in ("ttl", "jsonld"))
    assert ttl == metadata.turtle(metadata.as_frame(spark, triples[::-1])) and ld == metadata.json_ld(metadata.as_frame(spark, triples[::-1]))
    assert '"T \\"q\\" <b>"@en' in ttl and ttl.count(" .\n") == len({t[0] for t in triples}) == len(json.loads(ld))
    assert metadata.conformance(triples) == [] and metadata.german_number(1234.5, 1) == "1.234,5"
    assert any("leads nowhere" in x for x in metadata.conformance(triples + [metadata.iri("https://d", "dcat:distribution", "https://no")]))
    assert metadata.vocab_note(columns[0], {"x": "X"}) == "One of 1 codes: x." and metadata.vocab_note(columns[0], {str(i): "" for i in range(20)}) == "One of 20 codes, from 0 to 9."
    assert metadata.list_note(columns[1]).startswith("A JSON array") and metadata.list_note(columns[2]) == "" and "it's <a> One of" in metadata.description_of(columns[0], {"x": "X"})
    pages = [metadata.dataset_page(about, {"b.csv": ("text/csv", 5000)}, {"columns.html": "columns"}), metadata.columns_page(about, columns, {}), metadata.vocabularies_page(about, {"v": {"x": "<X>"}})]
    assert all(x.count("<section") == 2 and 'lang="de"' in x and "<b>" not in x for x in pages)
    assert "5,000 bytes" in pages[0] and "5.000 Bytes" in pages[0] and "it&#x27;s &lt;a&gt;" in pages[1] and "&lt;X&gt;" in pages[2]


def test_store(spark, tmp_path):
    store = tables.Store(spark, str(tmp_path / "s"))
    assert store.current() == (-1, {}) and store.read("t", "id long").count() == 0
    one = store.write(spark.range(3), "t")
    assert store.read("t", "id long").count() == 0  # written, not committed
    assert store.commit(-1, {"t": [one]}) == 0 and store.read("t", "id long").count() == 3
    two = store.write(store.read("t", "id long").where("id > 0"), "t")  # reads what it replaces
    base, _ = store.current()
    assert store.commit(base, {"t": [one, two], "u": [two]}) == 1 and store.read(["t", "u"], "id long").count() == 7
    with pytest.raises(OSError, match="isn't the last"):
        store.commit(base, {"t": []})
    assert store.commit(1, {"t": [two]}) == 2
    assert store.read("t", "id long").count() == 2 and store.vacuum(1) == [one] and store.read("t", "id long").count() == 2
    orphan = store.write(spark.range(1), "t")  # of a load that stopped
    (tmp_path / "s/_commits/new-x").write_text("{")
    assert store.vacuum(1) == [] and store.vacuum(1, older=-60) == [orphan] and not list((tmp_path / "s/_commits").glob("new-*"))
    (tmp_path / "s/_commits/0000000003.json").write_text('{"tables"')
    with pytest.raises(OSError, match="can't be read"):
        store.current()


def test_of_two_writers_one_is_refused(spark, tmp_path, monkeypatch):
    """The other one commits when this one has written its manifest, but not yet named it."""
    store = tables.Store(spark, str(tmp_path / "s"))
    store.commit(-1, {})
    named, late = tables._renamed, []

    def slow(*args, **kwargs):
        if not late:
            late.append(None)
            late[0] = store.commit(0, {"b": ["of the other"]})
        return named(*args, **kwargs)

    monkeypatch.setattr(tables, "_renamed", slow)
    with pytest.raises(OSError, match="another writer"):
        store.commit(0, {"a": ["of this one"]})
    assert late == [1] and store.current() == (1, {"b": ["of the other"]})
    assert sorted(p.name for p in (tmp_path / "s/_commits").glob("[!.]*")) == ["0000000000.json", "0000000001.json"]


def test_a_service_that_segments(spark):
    """Whole texts are sent, in chunks of the service's own size; each row says who gave it."""

    def texts(url, body, headers, timeout):
        values = json.loads(body)["keywords"]
        assert 0 < len(values) <= 40
        return json.dumps({"results": [{"terms": v.split("|"), "group_sizes": [1] * len(v.split("|"))} for v in values], "model": f"m{len(values)}", "revision": "r"}).encode()

    df = spark.range(100).selectExpr("IF(id = 3, NULL, concat('a|b', id % 90)) AS kw").coalesce(1)
    got = endpoint.segmented(df, "kw", endpoint.Segmenter("http://x", "t", chunk=40, post=texts)).collect()
    assert len(got) == 90 and all(r["terms"] == r["kw"].split("|") and r["sizes"] == [1, 1] and r["revision"] == "r" for r in got)
    assert max(int(r["model"][1:]) for r in got) > 32  # more than another scorer is asked for
    asked = []
    big = type("Big", (), {"chunk": 64, "__call__": lambda self, batch: asked.append(len(batch)) or [[0.5] * (len(w) - 1) for w in batch]})()
    rows = spark.range(100).selectExpr("concat('a b', id) AS kw").coalesce(1)
    assert segment.answered(rows, "kw", big).where("revision IS NULL").count() == 100


def test_endpoint():
    import urllib.error

    asked, paused = [], []

    def post(url, body, headers, timeout):
        values = json.loads(body)["tokens"]
        asked.append((len(values), headers["x-token"]))
        if len(asked) in (1, 2):
            raise urllib.error.HTTPError(url, 503, "busy", None, None) if len(asked) == 1 else urllib.error.URLError("gone")
        return json.dumps({"results": [[0.5] * (len(v) - 1) for v in values], "revision": "r7"}).encode()

    def texts(url, body, headers, timeout):
        values = json.loads(body)["keywords"]
        texts.asked.append((len(values), headers["x-tagger-token"]))
        return json.dumps({"results": [{"terms": v.split(), "group_sizes": [1] * len(v.split())} for v in values], "model": "m", "revision": f"r{len(texts.asked)}"}).encode()

    texts.asked = []
    s = endpoint.Segmenter("http://x", "t", chunk=2, post=texts)
    assert [(x["terms"], r) for x, r, m in s.answers(["a b", "c", "d"])] == [(["a", "b"], "r1"), (["c"], "r1"), (["d"], "r2")]
    assert texts.asked == [(2, "t"), (1, "t")] and s.revision() == "r3"
    e = endpoint.Endpoint("http://x", "t", chunk=2, post=post, pause=paused.append)
    assert e([["a", "b"], ["c", "d", "e"], ["f", "g"]]) == [[0.5], [0.5, 0.5], [0.5]]
    assert [n for n, _ in asked] == [2, 2, 2, 1] and paused == [1, 2] and e.revision() == "r7"

    def refuses(url, body, headers, timeout):
        asked.append(None)
        raise urllib.error.HTTPError(url, 422, "no", None, None)

    asked.clear()
    with pytest.raises(urllib.error.HTTPError):
        endpoint.Endpoint("http://x", "t", post=refuses, pause=paused.append)([["a", "b"]])
    assert len(asked) == 1 and paused == [1, 2]  # asked once, no pause
    short = endpoint.Endpoint("http://x", "t", post=lambda *_: b'{"results": []}')
    with pytest.raises(ValueError, match="asked for 1 values, got 0"):
        short([["a", "b"]])
    assert endpoint.configured("http://x", None) is None and endpoint.configured("", "t") is None and endpoint.configured("http://x", "t").url == "http://x"


# ---------------------------------------------------------------- streams


def test_stream_windows(spark, tmp_path):
    monday = datetime(2024, 1, 1)
    rows = [(1, "a", monday + timedelta(days=6, hours=23)), (1, "b", monday + timedelta(days=7)), (1, "b", monday + timedelta(days=8)), (1, "c", monday + timedelta(days=30))]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "user_id long, event_type string, ts timestamp_ntz").write.parquet(src)
    stream = spark.readStream.schema("user_id long, event_type string, ts timestamp_ntz").parquet(src)
    q = streams.weekly(streams.timed(stream, "ts", "1 day"), "ts", F.count("*").alias("n")).writeStream.format("memory").queryName("weeks").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert {(r["week"], r["n"]) for r in spark.table("weeks").collect()} == {("2024-W01", 1), ("2024-W02", 2)}
    q = streams.content_runs(streams.timed(stream, "ts", "1 day"), "user_id", "event_type", "ts").writeStream.format("memory").queryName("runs").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert [(r["event_type"], r["since"]) for r in spark.table("runs").orderBy("since").collect()] == [("a", rows[0][2]), ("b", rows[1][2])]


def test_stream_runs_end_when_idle(spark, tmp_path):
    """The last run of a key comes out once the watermark has left it behind; null is a content."""
    t = datetime(2024, 1, 1)
    hour = timedelta(hours=1)
    src, schema = str(tmp_path / "in"), "user_id long, event_type string, ts timestamp_ntz"
    spark.createDataFrame([(1, "a", t), (1, None, t + hour), (1, None, t + 2 * hour), (2, "z", t)], schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        q = streams.content_runs(streams.timed(stream, "ts", "1 hour"), "user_id", "event_type", "ts", idle=3_600_000).writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        return {(r["user_id"], r["event_type"], r["since"], r["until"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert (1, "a", t, t + hour) in run()
    spark.createDataFrame([(3, "q", t + 50 * hour)], schema).coalesce(1).write.mode("append").parquet(src)
    assert run() == {(1, "a", t, t + hour), (1, None, t + hour, t + 2 * hour), (2, "z", t, t)}


def test_stream_runs_leave_late_events_out(spark, tmp_path):
    """Events before what a key has seen don't turn a run's ends round."""
    t, hour = datetime(2024, 1, 1), timedelta(hours=1)
    src, schema = str(tmp_path / "in"), "user_id long, event_type string, ts timestamp_ntz"
    batches = [[(1, "a", t + 5 * hour), (1, "a", t + 6 * hour)], [(1, "b", t)], [(1, "b", t + hour), (1, "c", t + 8 * hour), (1, "d", t + 9 * hour)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        q = streams.content_runs(streams.timed(stream, "ts", "10 days"), "user_id", "event_type", "ts").writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    got = sorted((r["event_type"], r["since"], r["until"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", t + 5 * hour, t + 8 * hour), ("c", t + 8 * hour, t + 9 * hour)]


def test_stream_of_extracts(spark, tmp_path):
    got = []
    src = str(tmp_path / "in")
    spark.range(5).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)
    q = streams.extracts(stream, lambda df, i: got.append((i, df.count())), str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(120) and got == [(0, 5)]


def test_sliding_and_sessions(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t), (1, t + timedelta(minutes=5)), (1, t + timedelta(hours=3))], "k long, ts timestamp")
    assert streams.sliding(df, "ts", "10 minutes", "5 minutes", F.count("*").alias("n")).where("n = 2").count() == 1
    assert sorted(r["n"] for r in streams.sessions(df, "ts", "k", "1 hour", F.count("*").alias("n")).collect()) == [1, 2]
