"""The three plans: collect an export, load it into the history, publish the history.

Tables are Parquet below one folder, committed together (`sinks.tables.Store`): `versions` and `documents`, each
with its open windows apart from the closed ones, `loads`, `segments` and the scorer's `cache`. A load rewrites open
windows and appends those that close; closed ones are never read or written again. `folded` is the history as it was last
folded: a `base`, a `delta` of the entities folded since, and the checkpoints (`grid`) that it knows.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.functions.timeops import from_unix
from chronicle.model import Field, Model
from chronicle.operators import contract, history, linkage, maintained, segment, shape
from chronicle.sinks import metadata, tables
from chronicle.sources import xml

LOADS = "load_id double, status int, kind string"
CACHE = "key string, keywords string, probabilities array<double>, model string, revision string, loaded double"
#: Folders that a table of appended rows has at most before they are made into one.
MOST_PARTS = 16
SEGMENTS = "md5 string, keywords string, terms array<string>, model string, revision string, loaded double"


class Plans:
    """A model, its linked documents and its structure, over one folder of tables."""

    def __init__(self, spark: SparkSession, model: Model, folder: str, index_fields: Sequence[Field] = (), index_types: Sequence[str] = (), structure: DataFrame | None = None, base_url: str = "", buckets: int | None = None) -> None:
        """`buckets`: how many the open windows are stored in by their key (none given: as many as a shuffle has partitions). Tables that have another number keep it until they are next written."""
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark, self.model, self.folder = spark, model.check(), folder.rstrip("/")
        self.index_fields, self.index_types, self.structure, self.base_url = list(index_fields), list(index_types), structure, base_url
        self.store = tables.Store(spark, self.folder)

    # -------------------------------------------------- one export

    def scan(self, root: str) -> DataFrame:
        """One scan, checked against the structure before its values are trusted."""
        return self._checked(xml.scan(self.spark, root))

    def _checked(self, found: DataFrame) -> DataFrame:
        if self.structure is not None:
            contract.refuse(xml.violations(found, self.structure))
        return found

    def index(self, scanned: DataFrame) -> DataFrame | None:
        """The link index with addresses and websites filled in."""
        if not self.index_fields:
            return None
        index = xml.linked(scanned, self.index_fields, self.index_types)
        names = [f.column for f in self.index_fields]
        if "address" in names:
            index = linkage.with_address(index, [n for n in names if n not in ("address", "website")])
        return linkage.with_website(index, self.base_url) if {"website", "url"} <= set(names) else index

    def contact_fields(self) -> list[str]:
        return [f.column for f in self.index_fields if f.column not in ("address", "website")]

    def collect(self, root: str, fields: Sequence[str] | None = None, checks: Sequence[contract.Check] = ()) -> DataFrame:
        """The export as a table, validated; `fields` are raw columns."""
        wanted = self.model.wanted(fields)
        scanned = self.scan(root)
        needed = list(dict.fromkeys([*wanted, "url"]))
        raw = xml.documents(scanned, self.model, needed)
        out = shape.process(raw, self.model, self.index(scanned), self.contact_fields())
        broken = contract.report(out, checks).where("n_failed > 0").collect() if checks else []
        if broken:
            raise contract.ContractError("; ".join(f"{r.column_name}: {r.n_failed} rows fail {r.check_name}" for r in broken))
        return out

    # -------------------------------------------------- history

    def _versions(self, name: str, schema: T.StructType, parts: Sequence[str] = ("open", "closed")) -> DataFrame:
        ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), "row_hash string", f"{history.FROM} timestamp", f"{history.TO} timestamp"])
        return self.store.read([f"{name}/{p}" for p in parts], ddl)

    def versions(self) -> DataFrame:
        return self._versions("versions", self.model.raw_schema())

    def live(self) -> DataFrame:
        """Open windows only: closed ones are not read."""
        return self._versions("versions", self.model.raw_schema(), ["open"])

    def _merged(self, name: str, extract: DataFrame, key: str, now: float, held: dict[str, list[str]]) -> dict[str, list[str]]:
        """Folders for a commit: the open windows anew, and the closed ones with those that close now.

        Open windows are stored in buckets of the key, so neither the join nor the writing shuffles them; keys are unique and not null here.
        """
        declared = [c for c in self._versions(name, extract.schema, ["open"]).columns if c not in ("row_hash", history.FROM, history.TO)]
        history.refuse_drift(extract, declared)
        own = extract.select(*declared)
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields), "row_hash string", f"{history.FROM} timestamp", f"{history.TO} timestamp"])
        parts = held.get(f"{name}/open", [])
        live = self.store.buckets(parts[0], key, schema) if len(parts) == 1 else self._versions(name, own.schema, ["open"])
        merged = history.apply_keyed(live, own, from_unix(F.lit(now)), key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            closing = merged.where(F.col(history.TO).isNotNull())
            closed = held.get(f"{name}/closed", [])
            if not closing.isEmpty():
                closed = [*closed, self.store.write(closing, f"{name}/closed")]
            return {f"{name}/open": [self.store.write_buckets(merged.where(F.col(history.TO).isNull()), f"{name}/open", key, self.buckets)], f"{name}/closed": closed}
        finally:
            merged.unpersist()

    def load(self, root: str, now: float | None = None, scorer: segment.Scorer | None = None, revision: str = "") -> None:
        """One run: refused as a whole, before anything is committed, if the extract can't be trusted.

        The files are read and parsed once; versions, linked documents and ledger change in one commit.
        """
        now = time.time() if now is None else now
        base, held = self.store.current()
        scanned = xml.scan(self.spark, root).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            extract = xml.documents(self._checked(scanned), self.model)
            history.refuse_shrinkage(self.live().count(), extract.count())
            history.refuse_duplicates(extract, "path")
            index = self.index(scanned)
            if index is not None:
                history.refuse_duplicates(index, "href")
            changes = self._merged("versions", extract, "path", now, held)
            if index is not None:
                changes |= self._merged("documents", index, "href", now, held)
            self.store.commit(base, changes | self._recorded(now, "extract"))
        finally:
            scanned.unpersist()
        if scorer is not None:  # without one the terms stay null
            self.segment(scorer, revision, now)

    def _recorded(self, now: float, kind: str) -> dict[str, list[str]]:
        """The ledger with one more load."""
        row = self.spark.createDataFrame([(float(now), 0, kind)], LOADS)
        return {"loads": [self.store.write(self.store.read("loads", LOADS).unionByName(row).coalesce(1), "loads")]}

    def segments(self) -> DataFrame:
        """The last segment of each text: runs append theirs."""
        return self._last(self.store.read("segments", SEGMENTS), "md5")

    @staticmethod
    def _last(rows: DataFrame, key: str) -> DataFrame:
        rest = [c for c in rows.columns if c != key]
        last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("loaded", F.xxhash64(*rest))).alias("last"))
        return last.select(key, "last.*").select(*rows.columns)

    def _appended(self, held: dict[str, list[str]], name: str, key: str, schema: str, part: str) -> list[str]:
        """The table's folders with one more; when there are many, one of them all."""
        parts = [*held.get(name, []), part]
        if len(parts) <= MOST_PARTS:
            return parts
        every = self.store.read(name, schema).unionByName(self.store.part(part))
        return [self.store.write(self._last(every, key), name)]

    def segment(self, scorer: segment.Scorer, revision: str, now: float, producer: str = "scorer") -> int:
        """Terms of all keyword texts, of any version, that this revision has not seen yet. Answers that the cache
        has are not asked for again. An answer is kept under the revision that it names itself, if it names one.
        A run appends what is new to the cache and to the segments."""
        if "keywords" not in self.model.names():
            return 0
        base, held = self.store.current()
        cache = self.store.read("cache", CACHE)
        todo = segment.stale(self.versions(), self.segments(), "keywords", revision).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = todo.count()
            if not n:
                return 0
            known, asked = segment.cached(todo, cache.select("key", "probabilities", "loaded"), "keywords", revision)
            by = F.coalesce("revision", F.lit(revision))
            put = segment.answered(asked, "keywords", scorer).select(segment.cache_key(F.col("keywords"), by).alias("key"), "keywords", "probabilities", F.lit(producer).alias("model"), by.alias("revision"), F.lit(float(now)).alias("loaded"))
            part = self.store.write(put, "cache")  # answers are asked for once and read from here
            told = known.select("keywords", "probabilities", F.lit(revision).alias("revision")).unionByName(self.store.part(part).select("keywords", "probabilities", "revision"))
            decided = told.withColumn("d", segment.decoded(segment.tokens(F.col("keywords")), F.col("probabilities")))
            fresh = decided.select(F.md5("keywords").alias("md5"), "keywords", F.col("d.terms").alias("terms"), F.lit(producer).alias("model"), "revision", F.lit(float(now)).alias("loaded"))
            changes = {"cache": self._appended(held, "cache", "key", CACHE, part), "segments": self._appended(held, "segments", "md5", SEGMENTS, self.store.write(fresh, "segments"))}
            self.store.commit(base, changes | self._recorded(now, "segments"))
            return n
        finally:
            todo.unpersist()

    # -------------------------------------------------- publication

    def checkpoints(self) -> DataFrame:
        """From the ledger's extract loads; without a ledger, from the windows' ends."""
        attested = history.load_times(self.versions())
        ledger = self.store.read("loads", LOADS)
        times = attested if ledger.isEmpty() else history.ledger_times(ledger, attested)
        return history.weekly_checkpoints(times)

    def _state(self) -> tuple[DataFrame | None, DataFrame | None, list]:
        """The folded state as it is stored: its base, its delta, and the checkpoints that it knows."""
        _, held = self.store.current()
        base, delta, grid = (held.get(f"folded/{x}", []) for x in ("base", "delta", "grid"))
        if not base:
            return None, None, []
        found = self.store.part(base[0])
        if [f.name for f in found.schema[maintained.ROW].dataType.fields] != [*self.model.raw_schema().names, "row_hash"]:
            return None, None, []  # of another model
        known = [r[0] for r in self.store.part(grid[0]).orderBy("checkpoint").collect()]  # one a week
        return found, self.store.part(delta[0]) if delta else None, known

    def _changed(self, base: DataFrame | None, delta: DataFrame | None, old: list, new: list) -> DataFrame:
        state = base if base is None or delta is None else maintained.merged(base, delta, "path")
        return maintained.changed(self.versions(), "path", old, new, state)

    def advance(self) -> int:
        """Folds what loads have touched since the last time; returns the number of entities. The base is written anew once the delta is a quarter of it."""
        number, _ = self.store.current()
        base, delta, old = self._state()
        new = maintained.grid(self.checkpoints())
        part = self.store.write(self._changed(base, delta, old, new), "folded/delta")
        news = self.store.part(part)
        n = news.count()
        if n == 0 and old == new:
            return 0
        grid = self.store.write(self.spark.createDataFrame([(x,) for x in new], "checkpoint timestamp").coalesce(1), "folded/grid")
        changes = {"folded/grid": [grid]}
        if base is None or not maintained.advances(old, new):
            changes |= {"folded/base": [self.store.write(news, "folded/base")], "folded/delta": []}
        else:
            together = news if delta is None else maintained.merged(delta, news, "path")
            if 4 * together.count() > base.count():
                changes |= {"folded/base": [self.store.write(maintained.merged(base, together, "path"), "folded/base")], "folded/delta": []}
            else:
                changes["folded/delta"] = [part if delta is None else self.store.write(together, "folded/delta")]
        self.store.commit(number, changes)
        return n

    def snapshot(self) -> DataFrame:
        """The last content of each document that a checkpoint saw, with its history; loads that weren't folded yet are, on the way."""
        base, delta, old = self._state()
        new = maintained.grid(self.checkpoints())
        news = self._changed(base, delta, old, new)
        if base is None or not maintained.advances(old, new):
            state = news
        else:
            state = maintained.merged(base if delta is None else maintained.merged(base, delta, "path"), news, "path")
        return maintained.folded(state, "path", new).drop("row_hash")

    def publish(self) -> DataFrame:
        """The published table: snapshot, link index, segments, export shape."""
        self.advance()
        raw = self.snapshot()
        own = [history.FROM, history.TO, "previous_update_dates", "last_updated", "absent"]
        index = None
        if self.index_fields:
            schema = T.StructType([T.StructField("href", T.StringType())])
            index = history.latest(self._versions("documents", schema), "href")
        out = shape.process(raw, self.model, index, self.contact_fields(), self.segments())
        return out.select(*[c for c in out.columns if c not in own], *own)

    def build(self, target: str, order: str = "id_hash", about: metadata.About | None = None, licence_file: str | None = None, vocabularies: Mapping[str, Mapping[str, str]] | None = None) -> list[str]:
        """Publishes into a folder: CSV, column contract, triples, pages, licence. Returns the names written.

        Metadata that breaks its shapes is refused before the pages are written.
        """
        about = about or metadata.About({"en": self.model.document_type}, publisher=self.model.publisher, licence=self.model.licence)
        labels = vocabularies or {v: {c: c for c in codes} for v, codes in self.model.vocabularies.items()}
        table, base = self.publish(), self.base_url or "urn:dataset"
        target = target.rstrip("/")
        csv = f"{target}/table.csv"
        tables.write_csv(table, csv, [order])
        columns = metadata.contract(table.schema, self.model, unique=[order], required=[order])
        tables.write_json(self.spark, f"{target}/table-schema.json", metadata.table_schema(columns, self.base_url, order, labels))
        media = {"table.csv": "text/csv", "table-schema.json": "application/csvm+json"}
        if licence_file is not None:
            media[tables.copy_beside(self.spark, licence_file, target)] = "text/plain"
        sizes = tables.sizes(self.spark, target, media)
        said = metadata.dataset_triples(base, about, sizes) + metadata.vocabulary_triples(base, columns, labels)
        if faults := metadata.conformance(said):
            raise contract.ContractError("; ".join(faults))
        triples = metadata.as_frame(self.spark, said)
        metadata.write_turtle(triples, f"{target}/dataset.ttl")
        metadata.write_json_ld(triples, f"{target}/dataset.jsonld")
        pages = {
            "index.html": metadata.dataset_page(about, sizes, {"columns.html": "columns", "vocabularies.html": "vocabularies"}),
            "columns.html": metadata.columns_page(about, columns, labels),
            "vocabularies.html": metadata.vocabularies_page(about, labels),
        }
        for name, text in pages.items():
            tables.write_text(self.spark, f"{target}/{name}", text)
        faults = contract.header_faults(tables.first_line(self.spark, csv).split(","), table.columns)
        if faults:
            raise contract.ContractError("; ".join(faults))
        return [*media, "dataset.ttl", "dataset.jsonld", *pages]
