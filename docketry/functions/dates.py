"""Dates of legislative records, as columns; all in the session's zone, which is to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vote_date(raw: Column) -> Column:
    """Date of an ISO time with or without offset, or of "January 3, 2025, 02:15 PM" with or without a weekday; the first form that
    parses decides, null if none does. The date is the one that is written, whatever the offset."""
    flat = F.trim(F.regexp_replace(raw, r"\s+", " "))
    long = F.regexp_replace(flat, r"^[A-Z][a-z]+day, ", "")
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?$"), F.left(raw, F.lit(10)).try_cast("date"))
    return F.coalesce(iso, F.to_date(F.try_to_timestamp(long, F.lit("MMMM d, yyyy, hh:mm a"))))


def instant(raw: Column) -> Column:
    """An instant with offset or Z; null if it doesn't parse."""
    return F.when(raw.rlike(r"T.*(?:Z|[+-]\d{2}:?\d{2})$"), raw.try_cast("timestamp"))


def date_or_instant(raw: Column) -> Column:
    """A date (its midnight) or an instant."""
    return F.coalesce(instant(raw), F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), raw.try_cast("timestamp")))


def first_year(congress: Column) -> Column:
    """A congress sits for two years from 1789 on."""
    return 1789 + 2 * (congress - 1)


def congress_of_year(year: Column) -> Column:
    return F.floor((year - 1789) / 2).cast("int") + 1


def year_of(iso: Column) -> Column:
    return F.left(iso, F.lit(4)).try_cast("int")


def recent_congresses(current: Column | int, n: int) -> Column:
    """The latest n congresses, newest first, none under 1."""
    current = F.lit(current) if isinstance(current, int) else current
    return F.sequence(current, F.greatest(F.lit(1), current - n + 1), F.lit(-1))
