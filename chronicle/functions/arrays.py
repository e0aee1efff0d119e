"""Array expressions with the engine's conventions: a missing list is empty, a null element fails a check."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def length(x: Column) -> Column:
    """0 for null."""
    return F.coalesce(F.array_size(x), F.lit(0))


def or_empty(x: Column, kind: str = "array<string>") -> Column:
    return F.coalesce(x, F.array().cast(kind))


def all_true(x: Column, test: Callable[[Column], Column]) -> Column:
    """Whether all elements pass; a null element doesn't, a null list does."""
    return F.coalesce(F.forall(x, lambda e: F.coalesce(test(e), F.lit(False))), F.lit(True))


def aliased(x: Column, aliases: Mapping[str, str]) -> Column:
    """Elements replaced by what they stand for, each kept once, in order of first sight."""
    if not aliases:
        return F.array_distinct(x)
    names = F.create_map(*[F.lit(v) for pair in aliases.items() for v in pair])
    return F.array_distinct(F.transform(x, lambda e: F.coalesce(F.element_at(names, e), e)))


def collapsed(columns: Sequence[tuple[str, Column]]) -> Column:
    """Lists of several columns as one list of `parent.child`, in the columns' order; nulls drop out."""

    def below(parent: str) -> Callable[[Column], Column]:
        return lambda e: F.concat(F.lit(f"{parent}."), e)

    return F.array_compact(F.concat(*(F.transform(or_empty(c), below(parent)) for parent, c in columns)))


def contains(x: Column, value) -> Column:
    """False for a null list."""
    return F.coalesce(F.array_contains(x, value), F.lit(False))


def contiguous(x: Column) -> Column:
    """Whether distinct whole numbers are a run without gaps; null for an empty list."""
    d = F.array_distinct(F.array_compact(x))
    return F.when(F.size(d) > 0, F.array_max(d) - F.array_min(d) + 1 == F.size(d))
