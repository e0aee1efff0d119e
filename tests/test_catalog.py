"""Every query against its SQL on DuckDB, row for row."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("CATALOG_DATA", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(x):
        if isinstance(x, bool) or x is None:
            return str(x)
        if isinstance(x, float):
            return "nan" if math.isnan(x) else f"{x:.9g}"
        return str(x)

    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def kinds(frame):
    return {n: {"tinyint": "int", "smallint": "int"}.get(t, t) for n, t in frame.dtypes}


DUCK_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    want = duck.sql(SQL[name])
    names, got = canonical(frame.collect(), frame.columns)
    want_names, expected = canonical(want.fetchall(), want.columns)
    assert names == want_names
    assert got == expected
    assert got, "a query without rows says nothing"
    types = {c: DUCK_KINDS.get(str(t), str(t)) for c, t in zip(want.columns, want.types, strict=True)}
    assert kinds(frame) == types


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)


def test_the_tagger_beats_never_joining(spark):
    got = {r["by"]: r for r in QUERIES["tagger_quality"](spark, DATA).collect()}
    assert got["tagger"]["f1"] > got["never join"]["f1"] and got["tagger"]["support"] == got["never join"]["support"] > 100


def test_cut_references_of_pages_are_text(spark, tmp_path):
    """Pages that are cut inside a reference: `&amp` without its semicolon counts to HTML, but not to the query's SQL."""
    pages = [(i, x) for i, x in enumerate(["<b>a&amp</b> &amp;lt; &amp;amp", "&quo", "&quot &lt;i&gt; &&amp;", "x&am", "&copy 2 &copy;&notit;", "&", None, "&ampx&amp"])]
    spark.createDataFrame(pages, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    frame, want = QUERIES["strip_html"](spark, str(tmp_path)), con.sql(SQL["strip_html"])
    assert canonical(frame.collect(), frame.columns)[1] == canonical(want.fetchall(), want.columns)[1]
