"""Time expressions in UTC: ISO dates, ISO weeks, schedule slots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def parse_iso(x: Column) -> Column:
    """A full ISO date or date-time; anything else is null. Without an offset it is UTC, whatever the session's zone."""
    timed = F.when(x.rlike("T|:"), x).otherwise(F.concat(x, F.lit(" 00:00:00")))
    whole = F.regexp_replace(F.regexp_replace(timed, ",", "."), r"([T ]\d{2}:\d{2})(?=Z|[+-]|$)", "$1:00")
    zoned = F.when(whole.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), whole).otherwise(F.concat(whole, F.lit("Z")))
    return F.when(x.rlike(ISO_DATE), F.try_to_timestamp(F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})$", "$1:$2")))


def iso_week(t: Column) -> Column:
    """`YYYY-Www`, which sorts as time does."""
    return F.concat(F.lpad(F.extract(F.lit("YEAROFWEEK"), t).cast("string"), 4, "0"), F.lit("-W"), F.lpad(F.weekofyear(t).cast("string"), 2, "0"))


def on_slot(t: Column, weekday: int = 1, hour: int = 3, tolerance: int = 1) -> Column:
    """Whether a time is within hours of the weekly slot; Monday is 1."""
    return (F.weekday(t) + 1 == weekday) & (F.abs(F.hour(t) - hour) <= tolerance)


def plausible(t: Column, first: int = 2000, last: int = 2100) -> Column:
    """Whether the year is in the range, ends included; null is."""
    return F.coalesce(F.year(t).between(first, last), F.lit(True))


def from_unix(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)
