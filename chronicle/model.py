"""What an export holds, declared and never inferred: fields, links, renames, vocabularies.

A `Model` is a parameter of all operators; `Model.check` refuses declarations that contradict
each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, VALUE, DATE, NUMBER, LINKS, CLASSIFIED = "text", "value", "date", "number", "links", "classified"
LISTS = (LINKS, CLASSIFIED)
IDENTITY = ("name", "path", "url")


@dataclass(frozen=True)
class Field:
    """One column of the raw table: the property it is read from, and how.

    kind: text (markup), value, date, number, links (a list), classified (links under one classifier).
    """

    column: str
    prop: str
    kind: str = TEXT
    classifier: str | None = None
    description: str = ""


@dataclass(frozen=True)
class Model:
    document_type: str
    fields: Sequence[Field]
    folder: str = ""
    base_url: str = ""
    slug_after: str = "/"
    contact: str | None = None  # the list column whose first link is the contact
    external: str | None = None  # the list column of links to resolve
    coded: Sequence[str] = ()  # list columns of which the leaf is the code
    aliases: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # column -> code -> what it stands for
    pivots: Mapping[str, Sequence[tuple[str, str]]] = field(default_factory=dict)  # new column -> (parent, list column)
    drop: Sequence[str] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    vocabularies: Mapping[str, Sequence[str]] = field(default_factory=dict)  # column -> closed codes
    licence: str = ""
    publisher: str = ""

    def check(self) -> Model:
        columns = [f.column for f in self.fields]
        if len(set(columns)) != len(columns):
            raise ValueError("a column is declared twice")
        known = {*columns, *IDENTITY, *self.pivots, "id_url", "id_hash"}
        lists = {f.column for f in self.fields if f.kind in LISTS}
        for name, given in (("renames", self.renames), ("drop", self.drop)):
            if odd := sorted(set(given) - known):
                raise ValueError(f"{name} has unknown columns {odd}")
        sources = {c for pairs in self.pivots.values() for _, c in pairs}
        for name, given in (("coded", self.coded), ("aliases", self.aliases), ("pivots", sources), ("links", {self.contact, self.external} - {None})):
            if odd := sorted(set(given) - lists):
                raise ValueError(f"{name} has columns that are no lists: {odd}")
        return self

    def raw_schema(self) -> T.StructType:
        kinds = {DATE: T.TimestampType(), NUMBER: T.LongType(), LINKS: T.ArrayType(T.StringType()), CLASSIFIED: T.ArrayType(T.StringType())}
        return T.StructType([T.StructField(c, T.StringType()) for c in IDENTITY] + [T.StructField(f.column, kinds.get(f.kind, T.StringType())) for f in self.fields])

    def names(self) -> list[str]:
        return self.raw_schema().names

    def wanted(self, columns: Sequence[str] | None) -> list[str]:
        """The columns asked for; an unknown one is an error before anything is read."""
        if columns is None:
            return self.names()
        if odd := sorted(set(columns) - set(self.names())):
            raise ValueError(f"unknown fields: {', '.join(odd)}")
        return list(columns)
