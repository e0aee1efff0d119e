"""The layout against the definition in plain Python, and against its SQL, with small files and blocks."""

import random
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest

from chronicle.llm import cell_layout, oracles, queries

SCHEMA = "doc_id long, text string, source string, lang string, position int, z string"
OUT = ["doc_id", "z", "position", "file", "files_touched", "files_matching", "file_bounds"]


def brute(rows, file_rows):
    """By the definition: ranks, digits, positions, and every file held against every row's query."""
    values = []
    for doc_id, text, source, lang, *_ in rows:
        date = -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 365
        string = lambda x: (x is not None, (x or "").encode())
        values.append((string(source), string(lang), -1 if text is None else len(text.encode()), date))
    n = len(rows)
    columns = []
    for d in range(4):
        column = sorted(v[d] for v in values)
        first = {}
        for s, v in enumerate(column):
            first.setdefault(v, s)
        columns.append([8 * first[v[d]] // n for v in values])
    coordinates = list(zip(*columns, strict=True))
    z = [int("".join(f"{x:03b}"[r] for r in range(3) for x in c), 2) for c in coordinates]
    order = sorted(range(n), key=lambda i: (z[i], rows[i][0] is not None, rows[i][0] or 0))
    files = defaultdict(list)
    for position, i in enumerate(order):
        files[position // file_rows].append(i)
    bounds = {f: [(min(coordinates[i][d] for i in own), max(coordinates[i][d] for i in own)) for d in range(4)] for f, own in files.items()}
    out = []
    for position, i in enumerate(order):
        c = coordinates[i]
        reach = [(c[d] - (d > 1), c[d] + (d > 1)) for d in range(4)]
        touched = sum(all(lo <= b and a <= hi for (lo, hi), (a, b) in zip(reach, box, strict=True)) for box in bounds.values())
        matching = sum(any(all(lo <= coordinates[j][d] <= hi for d, (lo, hi) in enumerate(reach)) for j in own) for own in files.values())
        f = position // file_rows
        out.append((rows[i][0], z[i], position, f, touched, matching, ",".join(str(x) for pair in bounds[f] for x in pair)))
    return sorted(out, key=repr)


def table(seed, n, ids=None):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if r.random() < 0.35 else r.choice([None, "", "Ä", "z", "~", "src1", "src10", "src9"])
        text = r.choice([None, "", "x" * r.randint(1, 50), "ü" * r.randint(1, 50)])
        rows.append((ids(r, i) if ids else i, text, source, r.choice(["en", "en", "de", None]), 0, "z"))
    return rows


IDS = {
    "dense": None,
    "wide": lambda r, i: r.randint(-(2**63), 2**63 - 1),
    "two clusters": lambda r, i: (i % 2) * 2**40 + i,
    "repeated and null": lambda r, i: r.choice([None, 7, 7, 7, -1, r.randint(0, 9)]),
}


@pytest.mark.parametrize("kind", sorted(IDS))
def test_by_definition(spark, kind):
    rows = table(len(kind), 300, IDS[kind])
    df = spark.createDataFrame(rows, SCHEMA)
    got = cell_layout.described(df, file_rows=7, block_bits=3)
    assert got.columns == OUT and dict(got.dtypes)["file"] == "bigint"
    got = sorted(map(tuple, got.collect()), key=repr)
    want = brute(rows, 7)
    if kind != "repeated and null":
        assert got == want
        return
    assert [g[:2] + g[4:6] for g in got] == [w[:2] + w[4:6] for w in want]
    assert sorted(g[2:4] + g[6:] + g[1:2] for g in got) == sorted(w[2:4] + w[6:] + w[1:2] for w in want)


def test_same_as_sql(spark, tmp_path):
    con = duckdb.connect()
    spark.createDataFrame(table(3, 1500), SCHEMA).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for n, got in ((30, cell_layout.described(spark.read.parquet(str(tmp_path / "documents.parquet")), file_rows=30)), (1000, queries.op11_cell_layout(spark, str(tmp_path)))):
        want = con.sql(oracles.OP11.format(file_rows=n))
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cell_layout.described(empty).count() == 0
    one = [(5, None, None, None, 0, "z")]
    assert list(map(tuple, cell_layout.described(spark.createDataFrame(one, SCHEMA)).collect())) == [(5, 0, 0, 0, 1, 1, "0,0,0,0,0,0,0,0")]


def test_one_id_many_rows(spark):
    """More rows of one id than one row is made into at once."""
    df = spark.range(10_000).selectExpr("IF(id < 9000, 1L, id) AS doc_id", "'t' AS text", "'s' AS source", "'en' AS lang")
    got = cell_layout.described(df).toPandas()
    assert sorted(got["position"]) == list(range(10_000)) and (got["file"] == got["position"] // 1000).all()
    assert (got[got["doc_id"] == 1]["z"].nunique(), (got["doc_id"] == 1).sum()) == (1, 9000)


def test_other_dimensions(spark):
    """Three dimensions of the caller's, in four parts each."""
    from pyspark.sql import functions as F

    r = random.Random(1)
    rows = [(i, r.randint(-5, 5) if r.random() < 0.9 else None, r.choice("abc"), r.randint(-(2**62), 2**62)) for i in range(200)]
    df = spark.createDataFrame(rows, "key long, a int, b string, c long")
    dims = [cell_layout.Dimension("a", F.col("a"), 1), cell_layout.Dimension("b", F.col("b"), text=True), cell_layout.Dimension("c", F.col("c"))]
    made = cell_layout.layout(df, dims, parts=4, file_rows=10, id_col="key")
    got = {x["doc_id"]: x["z"] for x in made.positions().collect()}
    for i, *v in rows:
        c = [4 * sum((x[d + 1] is not None, x[d + 1] or type(v[d] or 0)()) < (v[d] is not None, v[d] or type(x[d + 1] or 0)()) for x in rows) // 200 for d in range(3)]
        assert got[i] == int("".join(f"{x:02b}"[k] for k in range(2) for x in c), 2)


def test_written_files(spark, tmp_path):
    rows = table(9, 500) + [(7, "same", "s", "en", 1, "q")] * 60 + [(7, "same", "s", "en", i, "q") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = cell_layout.written(df, str(tmp_path / "out"), files_a_task=4, file_rows=25)
    files = [pq.read_table(p, partitioning=None).to_pylist() for p in sorted(Path(tmp_path / "out").glob("*.parquet"))]
    assert sorted((tuple(r.values()) for own in files for r in own), key=repr) == sorted(rows, key=repr)
    assert sorted(map(len, files)) == [5] + [25] * 23
    by_id = defaultdict(set)
    for x in made.positions().collect():
        by_id[x["doc_id"]].add(x["file"])
    for own in files:  # a file's rows are those of one number
        assert set.intersection(*(by_id[r["doc_id"]] for r in own))
