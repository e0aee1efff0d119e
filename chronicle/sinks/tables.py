"""Writing: staged and swapped, flattened for CSV, one file where one file is asked for."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cells(df: DataFrame) -> DataFrame:
    """Nested columns as JSON texts; null fields stay in them, null cells stay null."""
    nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
    return df.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in nested}) if nested else df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def swap(df: DataFrame, path: str) -> None:
    """Writes beside the table, then puts it in its place; the table may be what df is read from.

    If the second rename fails, the old table goes back. For tables that are read while they change, see `Store`.
    """
    fs, at = _fs(df.sparkSession, path)
    stage, old = f"{path}.stage-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(stage)
    held = fs.exists(at(path))
    if held and not fs.rename(at(path), at(old)):
        raise OSError(f"{path} could not be put aside")
    if not fs.rename(at(stage), at(path)):
        if held:
            fs.rename(at(old), at(path))
        raise OSError(f"{stage} could not become {path}")
    if held:
        fs.delete(at(old), True)


def _renamed(spark: SparkSession, source, target, overwrite: bool) -> None:
    """A file gets another name in one step; if that is taken, it replaces what has it, or raises."""
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    context.rename(source, target, options)


class Store:
    """Tables below one folder, each a list of Parquet folders that a numbered manifest names.

    New folders are written first and the next manifest last: its text is written under a name of its own and renamed to
    its number, which is the commit. So all tables of a commit change at once or not at all, readers see whole
    commits only, and of two writers that began with the same manifest one is refused. A manifest that can't be read is an error.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _commits(self) -> list[int]:
        fs, at = _fs(self.spark, self.folder)
        if not fs.exists(at(f"{self.folder}/_commits")):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(at(f"{self.folder}/_commits"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, number: int) -> dict[str, list[str]]:
        fs, at = _fs(self.spark, self.folder)
        stream = fs.open(at(f"{self.folder}/_commits/{number:010d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["tables"]
        except (ValueError, KeyError) as e:
            raise OSError(f"commit {number} of {self.folder} can't be read") from e
        finally:
            stream.close()

    def current(self) -> tuple[int, dict[str, list[str]]]:
        """The last commit's number and its tables; -1 and none before the first."""
        numbers = self._commits()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (-1, {})

    def read(self, names: str | list[str], schema: str) -> DataFrame:
        """The rows of one or several tables; none yet: no rows."""
        _, held = self.current()
        paths = [f"{self.folder}/{p}" for n in ([names] if isinstance(names, str) else names) for p in held.get(n, [])]
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def part(self, part: str) -> DataFrame:
        """A folder's rows, committed or not."""
        return self.spark.read.parquet(f"{self.folder}/{part}")

    def write(self, df: DataFrame, name: str) -> str:
        """Writes a folder for a coming commit."""
        part = f"{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{part}")
        return part

    def write_buckets(self, df: DataFrame, name: str, key: str, buckets: int) -> str:
        """Writes a folder in buckets of a key, sorted in each; their number is a part of its name.

        Rows that are dealt by the key already, as a join of two such tables leaves them, aren't shuffled for it.
        """
        part, view = f"{name}/{buckets}x{uuid.uuid4().hex}", f"chronicle_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{self.folder}/{part}").saveAsTable(view)
        self.spark.sql(f"DROP TABLE {view}")  # the folder stays
        return part

    def buckets(self, part: str, key: str, schema: str) -> DataFrame:
        """A folder's rows, read so that Spark knows the buckets of the key, if it has any."""
        found = re.fullmatch(r"(?:.*/)?(\d+)x[0-9a-f]{32}", part)
        if not found:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}")
        view = f"chronicle_{re.sub('[^0-9a-f]', '', part[-32:])}"
        at = f"{self.folder}/{part}".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {view} ({schema}) USING parquet OPTIONS (path '{at}') CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {found[1]} BUCKETS")
        return self.spark.table(view)

    def commit(self, base: int, tables: Mapping[str, list[str]]) -> int:
        """The tables of commit `base` with these folders in place of their own; refused if it isn't the last one any more."""
        fs, at = _fs(self.spark, self.folder)
        last, held = self.current()
        if last != base:
            raise OSError(f"commit {base} isn't the last one any more")
        text = json.dumps({"tables": held | dict(tables)}, indent=1, sort_keys=True)
        stage = at(f"{self.folder}/_commits/new-{uuid.uuid4().hex}")
        out = fs.create(stage, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            _renamed(self.spark, stage, at(f"{self.folder}/_commits/{base + 1:010d}.json"), overwrite=False)
        except Py4JJavaError as e:
            fs.delete(stage, False)
            raise OSError(f"commit {base + 1} was made by another writer") from e
        return base + 1

    def vacuum(self, keep: int = 2, older: float = 7 * 86400) -> list[str]:
        """Removes older manifests than the last `keep`, and all folders and unfinished manifests that these don't name.

        What no manifest ever named may belong to a load that is under way: it goes if it is `older` seconds old. Returns the folders removed.
        """
        fs, at = _fs(self.spark, self.folder)
        numbers = self._commits()
        kept, old = numbers[-keep:], numbers[:-keep]
        wanted = {p for n in kept for ps in self._manifest(n).values() for p in ps}
        named = {p for n in old for ps in self._manifest(n).values() for p in ps}
        bound = 1000 * (time.time() - older)
        parts = self._parts(fs, at)
        gone = sorted(p for p, changed in parts.items() if p not in wanted and (p in named or changed < bound))
        for p in gone:
            fs.delete(at(f"{self.folder}/{p}"), True)
        for n in old:
            fs.delete(at(f"{self.folder}/_commits/{n:010d}.json"), False)
        for f in fs.listStatus(at(f"{self.folder}/_commits")) if numbers else ():
            if f.getPath().getName().startswith("new-") and f.getModificationTime() < bound:
                fs.delete(f.getPath(), False)
        return gone

    def _parts(self, fs, at) -> dict[str, int]:
        """All folders that `write` made, whether committed or not, and when they last changed."""
        found, todo = {}, [""] if fs.exists(at(self.folder)) else []
        while todo:
            below = todo.pop()
            for f in fs.listStatus(at(f"{self.folder}/{below}".rstrip("/"))):
                name = f.getPath().getName()
                path = f"{below}/{name}".lstrip("/")
                if f.isDirectory() and re.fullmatch(r"(\d+x)?[0-9a-f]{32}", name):
                    found[path] = f.getModificationTime()
                elif f.isDirectory() and path != "_commits":
                    todo.append(path)
        return found


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """One CSV file in a total order, staged and put in its place in one step; quotes doubled, empty text and null alike empty.

    For a publication that is one file by contract; larger tables stay Parquet.
    """
    fs, at = _fs(df.sparkSession, path)
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    cells(df).orderBy(*order).coalesce(1).write.csv(stage, header=True, escape='"', emptyValue="")
    part = next(f.getPath() for f in fs.listStatus(at(stage)) if f.getPath().getName().startswith("part-"))
    _renamed(df.sparkSession, part, at(path), overwrite=True)
    fs.delete(at(stage), True)


def _put(spark: SparkSession, path: str, write) -> None:
    """A file that `write` fills through a stream, staged and renamed; on the file system that its path names."""
    fs, at = _fs(spark, path)
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    out = fs.create(at(stage), True)
    try:
        write(out)
    finally:
        out.close()
    _renamed(spark, at(stage), at(path), overwrite=True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file."""
    _put(spark, path, lambda out: out.write(bytearray(text.encode())))


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def write_lines(lines: DataFrame, path: str) -> None:
    """One file of a sorted frame's only column, a line for each row: executors write its parts, which the file system's streams join in order."""
    spark = lines.sparkSession
    fs, at = _fs(spark, path)
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    lines.write.text(parts)
    copy, conf = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes, spark.sparkContext._jsc.hadoopConfiguration()

    def joined(out) -> None:
        for part in sorted(f.getPath().toString() for f in fs.listStatus(at(parts)) if f.getPath().getName().startswith("part-")):
            source = fs.open(at(part))
            try:
                copy(source, out, conf, False)
            finally:
                source.close()

    try:
        _put(spark, path, joined)
    finally:
        fs.delete(at(parts), True)


def first_line(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(at(path)), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def sizes(spark: SparkSession, folder: str, media: Mapping[str, str]) -> dict[str, tuple[str, int]]:
    """name -> (media type, bytes) of the files that are there."""
    fs, at = _fs(spark, folder)
    return {n: (m, fs.getFileStatus(at(f"{folder}/{n}")).getLen()) for n, m in media.items() if fs.exists(at(f"{folder}/{n}"))}


def write_jsonl(df: DataFrame, path: str) -> None:
    """A folder of JSON lines; null fields are written too."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def copy_beside(spark: SparkSession, source: str, folder: str) -> str:
    """Puts a file, such as a licence, beside the data, from one file system to another if need be. Returns its name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    (fs, at), (other, _) = _fs(spark, source), _fs(spark, folder)
    name = at(source).getName()
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at(source), other, at(f"{folder}/{name}"), False, True, conf)
    return name


def write_dimension(df: DataFrame, path: str) -> None:
    """A derived dimension: vocabulary, contract, labels."""
    swap(df, path)
