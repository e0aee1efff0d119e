"""Tables from files: CSV, JSON lines, key/value tables, code lists, archives."""

from __future__ import annotations

import json
import shutil
import tempfile
import urllib.request
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@contextmanager
def export(location: str, directory: str | None = None, timeout: int = 300, spark: SparkSession | None = None, shared: str | None = None) -> Iterator[str]:
    """A folder with the export: the given one, or an archive fetched and unpacked for as long as it is used.

    It is unpacked on this machine; `shared`, a folder that the session's executors see, gets a copy for as long.
    """
    if directory is not None:
        yield directory
        return
    target = tempfile.mkdtemp(prefix="export-")
    copy = None
    try:
        archive = Path(target, "export.zip")
        with urllib.request.urlopen(location, timeout=timeout) as got, archive.open("wb") as out:
            shutil.copyfileobj(got, out)
        with zipfile.ZipFile(archive) as z:
            for name in z.namelist():
                if not Path(target, "content", name).resolve().is_relative_to(Path(target, "content").resolve()):
                    raise ValueError(f"the archive leaves its folder: {name}")
            z.extractall(Path(target, "content"))
        if spark is None or shared is None:
            yield str(Path(target, "content"))
            return
        jvm = spark.sparkContext._jvm
        copy = jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/export-{uuid.uuid4().hex}")
        fs = copy.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.copyFromLocalFile(jvm.org.apache.hadoop.fs.Path(Path(target, "content").as_uri()), copy)
        yield copy.toString()
    finally:
        if copy is not None:
            fs.delete(copy, True)
        shutil.rmtree(target, ignore_errors=True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """Quoted line breaks and doubled quotes. Without a schema all columns are texts, or inferred from all rows."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema=schema, inferSchema=infer and schema is None)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one if there is none yet. Any other error stays one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def genericode(spark: SparkSession, path: str) -> DataFrame:
    """(code, label) of a genericode list, by length of the code and code."""
    cell = "struct<_ColumnRef:string,SimpleValue:string>"
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"<(/?)[\w-]+:", "<$1").alias("value"))
    body = F.explode(F.regexp_extract_all("value", F.lit(r"(?s)(<Row\b.*?</Row>)"), F.lit(1)))
    rows = text.select(body.alias("raw")).select(F.from_xml("raw", f"Value array<{cell}>", {"rowTag": "Row"}).alias("r"))
    pick = lambda name: F.try_element_at(F.filter("r.Value", lambda v: F.lower(v["_ColumnRef"]) == name), F.lit(1))["SimpleValue"]
    found = rows.select(pick("code").alias("code"), F.coalesce(pick("label"), pick("name")).alias("label"))
    return found.orderBy(F.length("code"), "code")


def label_cells(bundles: DataFrame, text: str = "value") -> DataFrame:
    """(key, label) of table cells in label bundles: cells in turn are key and label."""
    cells = F.regexp_extract_all(text, F.lit(r"(?s)<td>(.*?)</td>"), F.lit(1))
    pairs = F.transform(F.sequence(F.lit(0), F.size("cells") - 2, F.lit(2)), lambda i: F.struct(F.col("cells")[i].alias("key"), F.col("cells")[i + 1].alias("label")))
    return bundles.select(cells.alias("cells")).where("size(cells) > 1").select(F.explode(pairs).alias("p")).select("p.*")


def with_fallback(wanted: DataFrame, *bundles: DataFrame) -> DataFrame:
    """Each wanted key's label from the first bundle that has one."""
    out = wanted
    for i, b in enumerate(bundles):
        out = out.join(b.groupBy("key").agg(F.min("label").alias(f"__{i}")), "key", "left")
    return out.withColumn("label", F.coalesce(*(f"__{i}" for i in range(len(bundles))))).drop(*(f"__{i}" for i in range(len(bundles))))


def registry(location: str, name: str = "identifier", version: str = "version", timeout: int = 60) -> dict[str, str]:
    """The latest version of each list that a registry (a JSON array of objects) names."""
    with urllib.request.urlopen(location, timeout=timeout) as got:
        rows = json.load(got)
    out: dict[str, str] = {}
    for r in rows:
        out[r[name]] = max(out.get(r[name], ""), r[version])
    return out


def drifted(pinned: dict[str, str], current: dict[str, str]) -> dict[str, tuple[str, str]]:
    """Versions that a registry has moved on from."""
    return {k: (v, current[k]) for k, v in sorted(pinned.items()) if current.get(k, v) > v}


def drifted_rows(pinned: DataFrame, registry: DataFrame) -> DataFrame:
    """(list, pinned, now) of lists whose latest version in a registry is past the pinned one; both have (list, version), a registry any number of each."""
    latest = registry.groupBy("list").agg(F.max("version").alias("now"))
    return pinned.withColumnRenamed("version", "pinned").join(latest, "list").where("now > pinned").select("list", "pinned", "now")
