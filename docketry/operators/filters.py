"""Predicates and orders of the ingestion jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def congress_range(c: Column, low: int | None, high: int | None = None) -> Column:
    """Inclusive; no bound where None."""
    out = F.lit(True)
    if low is not None:
        out = out & (c >= low)
    return out & (c <= high) if high is not None else out


def within_lookback(ts: Column, run: Column, days: int) -> Column:
    """From `days` before the run on, the bound included; 0 and less keeps all, also rows without a time."""
    return F.lit(True) if days <= 0 else F.coalesce(ts >= run - F.make_dt_interval(F.lit(days)), F.lit(False))


def needs_text(expected: Column, stored: Column, congress: Column | None = None, congresses: tuple[int, ...] = ()) -> Column:
    """A text is expected that isn't the stored one; an empty list of congresses means all."""
    out = expected.isNotNull() & ~stored.eqNullSafe(expected)
    return out & congress.isin(*congresses) if congresses else out


def stale(checked: Column, run: Column, seconds: int) -> Column:
    """Never checked, or longer ago than that."""
    return checked.isNull() | (checked < run - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds).cast("decimal(18,6)")))


def any_in_window(numbers: Column, current: int, width: int) -> Column:
    """Some number lies in the last `width` up to current."""
    return F.coalesce(F.exists(numbers, lambda n: (n > current - width) & (n <= current)), F.lit(False))


def pending_first(pending: Column, congress: Column, key: Column) -> list[Column]:
    """Order of work: what was never fetched, then recent congresses."""
    return [pending.desc(), congress.desc(), key.asc()]


def split(rows: DataFrame, inside: Column) -> tuple[DataFrame, DataFrame]:
    """(rows for which it holds, all others)."""
    keep = F.coalesce(inside, F.lit(False))
    return rows.where(keep), rows.where(~keep)
