"""What came in against what is stored: new, changed or the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a missing date means differs by record: for each policy (incoming is null, stored is null).
POLICIES = {
    "vote": ("Unchanged", "Unchanged"),
    "bill": ("Unchanged", "Updated"),
    "member": ("Unchanged", "compare"),
    "amendment": ("Updated", "Updated"),
}


def changed_by_date(incoming: Column, stored: Column, policy: str, differs: Column | None = None) -> Column:
    """Updated or Unchanged by two update dates of a record that is stored. The member policy compares values where dates don't settle it."""
    no_incoming, no_stored = POLICIES[policy]
    compare = F.when(F.lit(True) if differs is None else differs, F.lit("Updated")).otherwise(F.lit("Unchanged"))
    say = lambda s: compare if s == "compare" else F.lit(s)
    later = compare if policy == "member" else F.lit("Updated")
    return F.when(incoming.isNull(), say(no_incoming)).when(stored.isNull(), say(no_stored)).when(incoming > stored, later).otherwise(F.lit("Unchanged"))


def stale_reason(incoming: Column, stored: Column) -> Column:
    """Why a stored record counts as up to date; null if it doesn't."""
    return F.when(incoming.isNull() | stored.isNull(), "missing date").when(incoming < stored, "regression").when(incoming == stored, "equal")


def is_placeholder(*required: Column) -> Column:
    """Some field is missing that a hydrated record has."""
    out = F.lit(False)
    for c in required:
        out = out | c.isNull()
    return out


def classify(incoming: DataFrame, stored: DataFrame, keys: list[str], date: str, policy: str, values: list[str] | None = None, placeholder: list[str] | None = None) -> DataFrame:
    """incoming with change (New, Backfill, Updated, Unchanged) and reason (of an Unchanged one).

    values are compared by the member policy; placeholder names stored columns of which none may be null in a hydrated record, else the change
    is a Backfill."""
    other = sorted({date, *(values or []), *(placeholder or [])})
    s = stored.select(*keys, *[F.col(c).alias(f"_{c}") for c in other], F.lit(True).alias("_was"))
    rows = incoming.join(s, keys, "left")
    differs = None
    if values is not None:
        differs = F.lit(False)
        for c in values:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    change = F.when(F.col("_was").isNull(), F.lit("New"))
    if placeholder:
        change = change.when(is_placeholder(*[F.col(f"_{c}") for c in placeholder]), F.lit("Backfill"))
    change = change.otherwise(changed_by_date(F.col(date), F.col(f"_{date}"), policy, differs))
    rows = rows.withColumn("change", change).withColumn("reason", F.when(F.col("change") == "Unchanged", stale_reason(F.col(date), F.col(f"_{date}"))))
    return rows.select(*incoming.columns, "change", "reason")


def classify_text(best: DataFrame, stored: DataFrame, key: str, code: str) -> DataFrame:
    """best (key, code; has_selection boolean) with change: no selection is Skipped, one without a code Failed; else New, Changed or Unchanged against
    the stored code."""
    s = stored.select(key, F.col(code).alias("_code"))
    change = (
        F.when(~F.col("has_selection"), "Skipped").when(F.col(code).isNull(), "Failed").when(F.col("_code").isNull(), "New")
        .when(F.col("_code") != F.col(code), "Changed").otherwise("Unchanged")
    )
    return best.join(s, key, "left").withColumn("change", change).select(*best.columns, "change")


def keyed_diff(left: DataFrame, right: DataFrame, keys: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """(keys, diff): Added, Removed, Changed or Same for the keys of two tables, whatever their order; null keys meet, and nulls equal nulls."""
    values = [c for c in left.columns if c not in keys and c not in ignore]
    a = left.select(*[F.col(k).alias(f"a_{k}") for k in keys], *[F.col(c).alias(f"a_{c}") for c in values], F.lit(True).alias("_a"))
    b = right.select(*[F.col(k).alias(f"b_{k}") for k in keys], *[F.col(c).alias(f"b_{c}") for c in values], F.lit(True).alias("_b"))
    rows = a.join(b, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys], "full_outer")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    diff = F.when(F.col("_a").isNull(), "Added").when(F.col("_b").isNull(), "Removed").when(same, "Same").otherwise("Changed")
    return rows.select(*[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys], diff.alias("diff"))


def routed(change: Column, positions_changed: Column) -> Column:
    """Whether an event is sent: new records and those whose positions changed; not for metadata alone."""
    return (change == "New") | ((change == "Updated") & F.coalesce(positions_changed, F.lit(False)))


def member_events(members: DataFrame, terms: DataFrame, mapped: DataFrame, key: str, congress: str, position: str, chamber: str = "chamber") -> DataFrame:
    """The members of whom an event is sent. Their chamber is that of their latest term; a senator's event waits until their id is mapped, all others, also those without a
    term or a known chamber, are sent at once."""
    now = terms.groupBy(key).agg(F.max_by(chamber, F.struct(F.coalesce(congress, F.lit(-1)), -F.col(position))).alias("_chamber"))
    known = mapped.select(key, F.lit(True).alias("_mapped")).distinct()
    rows = members.join(now, key, "left").join(known, key, "left")
    return rows.where((F.coalesce("_chamber", F.lit("")) != "Senate") | F.col("_mapped").isNotNull()).select(*members.columns)


def availability(candidates: DataFrame, offered: DataFrame, known: DataFrame, key: str, identity: list[str], error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(results (key, result, reason), new versions (offered's columns but error)) of candidates checked for versions that aren't known.

    offered holds what was found for them, a row with an error being a check that failed. A failed check fails alone and has no new versions, one without new versions is
    Skipped, others have Succeeded. Nulls in the identity equal each other."""
    mine = offered.join(candidates.select(key), key, "left_semi")
    failed = mine.where(F.col(error).isNotNull()).groupBy(key).agg(F.min(error).alias("_why"))
    same = [F.col(f"m.{key}") == F.col(f"k.{key}")] + [F.col(f"m.{c}").eqNullSafe(F.col(f"k.{c}")) for c in identity]
    fresh = mine.where(F.col(error).isNull()).drop(error).join(failed, key, "left_anti").alias("m").join(known.alias("k"), same, "left_anti")
    found = fresh.select(key).distinct().withColumn("_new", F.lit(True))
    rows = candidates.select(key).join(failed, key, "left").join(found, key, "left")
    result = F.when(F.col("_why").isNotNull(), "Failed").when(F.col("_new").isNull(), "Skipped").otherwise("Succeeded")
    return rows.select(key, result.alias("result"), F.coalesce("_why", F.when(F.col("_new").isNull(), F.lit("no-new-versions"))).alias("reason")), fresh
