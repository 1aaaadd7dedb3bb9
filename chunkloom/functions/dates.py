"""Date and time conversions to epoch seconds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, most specific first.
DATE_LAYOUTS = [
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyyMMdd",
    "yyyy/MM/dd",
    "yyyy-MM",
    "yyyy",
]


def wall_epoch(ts: Column) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC, whatever the session time zone is."""
    day = F.unix_date(F.to_date(ts)).cast("long") * 86400
    return day + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts).cast("long")


def to_epoch(ts: Column) -> Column:
    """Epoch seconds, fraction dropped: of an instant as it is, of a zone-less time as if it were UTC.

    Neither depends on the session's time zone; the kind of the column is known when the query is planned.
    """
    return F.when(F.typeof(ts) == "timestamp", F.unix_timestamp(ts)).otherwise(wall_epoch(ts))


def to_unix_or_now(text: Column, now: Column | int) -> Column:
    """Parse a date string; a string no layout accepts yields the run's own time."""
    tries = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in DATE_LAYOUTS]
    fallback = F.lit(now) if isinstance(now, int) else now
    return F.coalesce(wall_epoch(reduce(lambda a, b: F.coalesce(a, b), tries)), fallback.cast("long"))


def year_month(text: Column) -> Column:
    """First day of a ``yyyy-MM`` month."""
    return F.try_to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd")
