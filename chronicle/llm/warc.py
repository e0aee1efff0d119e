"""WARC archives: pages written as gzip members, one a record, and read back by tasks that split the files.

Writing. Payloads are compared by SHA-256. Of the pages with one payload (of `least` bytes or more) that with the smallest
page_id is a `response`, the others `revisit` it: headers alone, with the payload's digest and length. Only
payloads that occur more than once are joined, by their hash, to the rows; the payloads themselves aren't shuffled. Each task
appends its records to archives of about `archive_bytes` in the shared folder and puts out a manifest row for each one it
has closed; what a lost or repeated attempt leaves behind no manifest names, so it is never read.

Reading. Files are cut into byte ranges, and a task owns the records that start inside its range. It looks for the gzip
magic, takes a place for a member only if it decodes, checksum included, to a record whose headers give its exact
length, and goes on from that member's end. A payload may hold such bytes itself, so ranges are checked: the records
of a file must follow each other without gap or overlap. A file where they don't is read again from its beginning,
member by member. What even that can't read is listed by `gaps`.

Archives are opened through pyarrow's file systems (local or mounted folders, HDFS, object stores), by executors only.

Null payloads are empty. A null page_id counts as larger than any; ties are settled by url, null last. Rows equal in page_id,
url and payload are records of their own: one is the response. A null url is named after the page. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, bytes long, records long"
#: The date of all records, where the table has none.
DATE = "2024-01-01T00:00:00Z"
WINDOW = 1 << 18
#: Tasks of a reading at most; with more ranges, a task takes several.
MOST_TASKS = 20_000


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


# ---------------------------------------------------------------- records


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None, url: str | None, payload_digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr((page_id, url, payload_digest, copy)))}>"


def _uri(page_id: int | None, url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"


def member(page_id: int | None, url: str | None, payload: bytes, first: tuple[int | None, str | None] | None = None, copy: int = 0, level: int = 6) -> bytes:
    """A record as a gzip member: a response, or, where `first` names the page that has the payload, a revisit of that."""
    mark = digest(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if first is None:
        block += payload
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", _name(page_id, url, mark, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(page_id, url)),
        ("WARC-Payload-Digest", f"sha1:{mark}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if first is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(*first, mark, 0)), ("WARC-Refers-To-Target-URI", _uri(*first)), ("WARC-Refers-To-Date", DATE)]
        if first[0] is not None:
            fields.append(("Refers-To-Page-Id", str(first[0])))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    def http(self) -> tuple[dict[str, str], bytes]:
        """The fields and the payload of a block that is an HTTP message; of any other the block is the payload."""
        if not self.fields.get("content-type", "").startswith("application/http"):
            return {}, self.block
        head, _, payload = self.block.partition(b"\r\n\r\n")
        return _fields(head.split(b"\r\n")[1:]), payload


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Named fields, names in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def parsed(data: bytes) -> Record | None:
    """A member's bytes as a record, if its headers give their exact length."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not lines[0].startswith(b"WARC/"):
        return None
    fields = _fields(lines[1:])
    length = fields.get("content-length", "")
    if not {"warc-type", "warc-record-id", "warc-date"} <= set(fields) or not length.isdigit() or rest[int(length) :] != b"\r\n\r\n":
        return None
    return Record(fields, rest[: int(length)])


def member_at(file: pa.NativeFile, at: int) -> tuple[int, Record] | None:
    """The record whose member begins at a place, and where it ends; None if none does."""
    unpack = zlib.decompressobj(31)
    out, size, place = [], 0, at
    while not unpack.eof:
        raw = file.read_at(WINDOW, place)
        if not raw:
            return None
        place += len(raw)
        try:
            got = unpack.decompress(raw)
        except zlib.error:
            return None
        if size < 5 and got and not (b"".join(out) + got)[:5] == b"WARC/"[: size + len(got)]:
            return None
        out.append(got)
        size += len(got)
    record = parsed(b"".join(out))
    return None if record is None else (place - len(unpack.unused_data), record)


def _next_magic(file: pa.NativeFile, at: int, end: int) -> int:
    """The first place from `at` and before `end` where the magic stands, or `end`."""
    while at < end:
        raw = file.read_at(min(1 << 20, end - at) + len(MAGIC) - 1, at)
        k = raw.find(MAGIC)
        if k >= 0 and at + k < end:
            return at + k
        at += 1 << 20
    return end


def scan(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, int, Record]]:
    """Place, end and content of the records that start in a range; the first may be anywhere, each other follows the one before it."""
    at, follows = start, start == 0
    while at < end:
        if not follows:
            at = _next_magic(file, at, end)
            if at >= end:
                return
        got = member_at(file, at)
        if got is None:
            at, follows = at + (not follows), False
            continue
        yield at, got[0], got[1]
        at, follows = got[0], True


# ---------------------------------------------------------------- writing


def _said(pages: DataFrame, least: int, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(page_id, url, payload, first, copies): what the records of each page say; first is null where the page is its payload's first."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("hash"))
    key = ["hash", "page_id", "url"]
    order = F.struct(F.isnull("page_id").alias("a"), F.col("page_id").alias("page_id"), F.isnull("url").alias("b"), F.col("url").alias("url"))
    classes = rows.where(F.octet_length("payload") >= least).groupBy("hash").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    classes = c.checkpointed(classes.select("hash", "first"))
    few = classes.count() <= c.BROADCAST_KEYS // 4  # a row has the hash and a url
    held = F.broadcast(classes) if few else classes
    again = c.checkpointed(rows.select(*key).join(held, "hash", "left_semi").groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*(F.col(k).alias(f"same_{k}") for k in key)))
    rows = rows.withColumn("copies", F.lit(1).cast("long"))
    if not again.isEmpty():
        on = [(k, f"same_{k}") for k in key]
        once = c.by_keys(rows, again, on).groupBy(*key).agg(F.any_value("payload").alias("payload"), F.count("*").alias("copies"))
        rows = c.by_keys(rows, again, on, "left_anti").select(*key, "payload", "copies").unionByName(once)
    own = F.col("first.page_id").eqNullSafe(F.col("page_id")) & F.col("first.url").eqNullSafe(F.col("url"))
    told = rows.join(held, "hash", "left").withColumn("known", F.col("first").isNotNull())
    return told.select("page_id", "url", "payload", "copies", (F.col("known") & ~own).alias("revisits"), (F.col("known") & (F.col("copies") > 1)).alias("repeats"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))


class _Archives:
    """A task's archives, one open at a time."""

    def __init__(self, folder: str, most: int) -> None:
        task = TaskContext.get()
        self.system, self.path = opened(folder)
        self.stem, self.folder, self.most = f"{task.partitionId():06d}-{task.taskAttemptId()}", folder.rstrip("/"), most
        self.stream, self.size, self.records, self.number = None, 0, 0, 0
        self.system.create_dir(self.path, recursive=True)

    def add(self, raw: bytes) -> Iterator[tuple[str, int, int]]:
        if self.stream is None:
            self.stream = self.system.open_output_stream(f"{self.path}/{self.stem}-{self.number}.warc.gz", compression=None)
        self.stream.write(raw)
        self.size += len(raw)
        self.records += 1
        if self.size >= self.most:
            yield from self.closed()

    def closed(self) -> Iterator[tuple[str, int, int]]:
        """The manifest row of the open archive, when all of it is stored."""
        if self.stream is not None:
            self.stream.close()
            yield f"{self.folder}/{self.stem}-{self.number}.warc.gz", self.size, self.records
            self.stream, self.size, self.records = None, 0, 0
            self.number += 1


def written(pages: DataFrame, folder: str | None = None, least: int = 0, archive_bytes: int = 1 << 28, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes the pages' archives below a folder that all executors see (none given: one in the checkpoint folder); returns their manifest (path, bytes, records)."""
    said = _said(pages, least, id_col, url_col, payload_col)
    folder = folder or f"{c.shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, done = _Archives(folder, archive_bytes), []
        for batch in batches:
            for part in c.parts(batch, "payload"):
                for page_id, url, payload, copies, revisits, repeats, first_id, first_url in zip(*(x.to_pylist() for x in part.columns), strict=True):
                    first = (first_id, first_url)
                    for k in range(copies):
                        done += archives.add(member(page_id, url, payload, first if revisits or (repeats and k) else None, k))
        done += archives.closed()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "bytes", "records"])
        c.release()

    return c.checkpointed(c.bounded(said).mapInArrow(write, MANIFEST))


# ---------------------------------------------------------------- reading


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the files below a folder; none of their bytes are read."""
    return spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("bytes"))


FOUND = "path string, at long, stop long, record_type string, page_id long, refers_to long, url string, payload_bytes long, payload_digest string, intact boolean"


def _number(x: str | None) -> int | None:
    return int(x) if x is not None and re.fullmatch(r"-?\d{1,19}", x) else None


def _row(path: str, at: int, stop: int, record: Record, with_payload: bool) -> tuple:
    """What a record says of its page. Length and digest are the payload's own; those of a revisit, which has none, are what it says of it."""
    fields, (http, payload) = record.fields, record.http()
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:").upper() or None
    revisit = fields["warc-type"] == "revisit"
    size = _number(http.get("content-length")) if revisit else len(payload)
    mark = told if revisit else digest(payload)
    out = (path, at, stop, fields["warc-type"], _number(fields.get("page-id")), _number(fields.get("refers-to-page-id")), fields.get("warc-target-uri"), size, mark, revisit or told in (None, mark))
    return (*out, None if revisit else payload) if with_payload else out


def _scanned(ranges: DataFrame, tasks: int, with_payload: bool) -> DataFrame:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_()] + [pa.binary()] * with_payload
    schema = FOUND + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                system, own = opened(path)
                rows, held = [], 0
                with system.open_input_file(own) as file:
                    for at, stop, record in scan(file, start, end):
                        rows.append(_row(path, at, stop, record, with_payload))
                        held += len(record.block) if with_payload else 256
                        if held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)
        c.release()

    return ranges.select("path", "start", "end").repartition(tasks).mapInArrow(run, schema)


def gaps(found: DataFrame, files: DataFrame) -> DataFrame:
    """(path, at, start): where a file's records don't follow each other: the next begins at `start`, though it should at `at`."""
    ends = files.select("path", F.col("bytes").alias("at"), F.lit(None).cast("long").alias("stop"))
    before = F.coalesce(F.expr("lag(stop) OVER (PARTITION BY path ORDER BY at, stop NULLS LAST)"), F.lit(0).cast("long"))
    return found.select("path", "at", "stop").unionByName(ends).withColumn("before", before).where("at <> before").select("path", F.col("before").alias("at"), F.col("at").alias("start"))


def records(files: DataFrame, split_bytes: int = 8 << 20, with_payload: bool = False) -> DataFrame:
    """All records of archives (path, bytes): where they stand, what they say, whether the payload has its digest and, if asked for, the payload."""
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")).withColumn("end", F.least("bytes", F.col("start") + split_bytes))
    tasks = max(1, min(MOST_TASKS, ranges.count()))
    found = c.checkpointed(_scanned(ranges, tasks, False))
    wrong = gaps(found, files).select("path").distinct()
    wrong = c.checkpointed(wrong)
    if wrong.isEmpty():
        return _scanned(ranges, tasks, True) if with_payload else found
    whole = files.join(wrong, "path", "left_semi").select("path", F.lit(0).cast("long").alias("start"), F.col("bytes").alias("end"))
    right = ranges.join(wrong, "path", "left_anti")
    again = _scanned(whole, max(1, min(MOST_TASKS, wrong.count())), with_payload)
    return (_scanned(right, tasks, True) if with_payload else found.join(wrong, "path", "left_anti")).unionByName(again)


def round_trip(pages: DataFrame, least: int = 0, **options) -> DataFrame:
    """One row for each page, as its record in the archives says it: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    found = records(written(pages, least=least, **options))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
