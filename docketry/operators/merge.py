"""Keyed writes as joins: the next version of a table from the stored one and what came in.

Incoming tables have one row for a key at most (see rank.py). Plain equality joins the keys, so a null key meets nothing and is inserted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MergeSpec:
    """How a keyed write treats matches: the columns it owns (None: all), those in which a null keeps what is stored, and a guard over
    the two rows s and i under which it updates at all. `on_update` are columns set to a constant by each update."""

    keys: tuple[str, ...]
    update: tuple[str, ...] | None = None
    keep_if_null: tuple[str, ...] = ()
    guard: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None
    on_update: dict[str, object] = field(default_factory=dict)


def merge(stored: DataFrame, incoming: DataFrame, spec: MergeSpec, status: str | None = None) -> DataFrame:
    """The next version of stored, with its columns; with `status`, also a column of that name: Inserted, Updated or Kept.

    Columns that incoming lacks are null on insert and stay on update.
    """
    s, i = stored.alias("s"), incoming.withColumn("_came", F.lit(True)).alias("i")
    joined = s.withColumn("_was", F.lit(True)).alias("s").join(i, [F.col(f"s.{k}") == F.col(f"i.{k}") for k in spec.keys], "full_outer")
    old, new = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"i.{c}"))
    was, came = F.col("s._was").isNotNull(), F.col("i._came").isNotNull()
    hit = was & came
    if spec.guard is not None:
        hit = hit & F.coalesce(spec.guard(old, new), F.lit(False))
    owned = set(incoming.columns if spec.update is None else spec.update) & set(incoming.columns)
    out = []
    for c in stored.columns:
        if c in spec.on_update:
            value = F.when(hit, F.lit(spec.on_update[c]))
        elif c in owned and c not in spec.keys:
            value = F.when(hit, F.coalesce(new(c), old(c)) if c in spec.keep_if_null else new(c))
        else:
            value = F.when(F.lit(False), F.lit(None))
        insert = new(c) if c in incoming.columns else F.lit(None).cast(stored.schema[c].dataType)
        out.append(value.when(was, old(c)).otherwise(insert).cast(stored.schema[c].dataType).alias(c))
    if status:
        out.append(F.when(~was, "Inserted").when(hit, "Updated").otherwise("Kept").alias(status))
    return joined.select(*out)


def append_or_touch(stored: DataFrame, entries: DataFrame, identity: list[str], touch: list[str]) -> DataFrame:
    """stored with the entries that it lacks by identity appended; of those that it has only the `touch` columns are set. Of several entries of one identity the
    largest touch values count. An entry with a null in its identity is always new."""
    new = entries.groupBy(*identity).agg(F.max(F.struct(*touch)).alias("_t")).select(*identity, *[F.col(f"_t.{c}").alias(c) for c in touch])
    return merge(stored, new, MergeSpec(tuple(identity), update=tuple(touch)))


def insert_absent(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """stored and a minimal row for each key of incoming that it lacks; columns that incoming lacks are null."""
    new = incoming.dropna(subset=keys).dropDuplicates(keys).join(stored.select(*keys).distinct(), keys, "left_anti")
    return stored.unionByName(new.select(*[c for c in incoming.columns if c in stored.columns]), allowMissingColumns=True)


def replace_children(stored: DataFrame, incoming: DataFrame, parents: list[str], touched: DataFrame | None = None) -> DataFrame:
    """All children of the touched parents (those of incoming if none are given) give way to the incoming ones."""
    gone = (incoming if touched is None else touched).select(*parents).distinct()
    return stored.join(gone, parents, "left_anti").unionByName(incoming, allowMissingColumns=True).select(*stored.columns)


def replace_valid_children(stored: DataFrame, incoming: DataFrame, parents: list[str], valid: Column) -> tuple[DataFrame, DataFrame]:
    """(next version, rejected rows): a parent with one bad row keeps its stored children, and its rows are rejected."""
    marked = incoming.withColumn("_ok", F.coalesce(valid, F.lit(False)))
    bad = marked.groupBy(*parents).agg(F.bool_and("_ok").alias("_all")).where("NOT _all").select(*parents)
    rows = incoming.join(bad, parents, "left_anti")
    return replace_children(stored, rows, parents), incoming.join(bad, parents, "left_semi")


def trim_tail(rows: DataFrame, counts: DataFrame, key: str, index: str, count: str) -> DataFrame:
    """Rows whose index is under the count that is known for their key; keys without a count keep all."""
    return rows.join(counts.select(key, F.col(count).alias("_n")), key, "left").where(F.col("_n").isNull() | (F.col(index) < F.col("_n"))).select(*rows.columns)


def set_where(rows: DataFrame, changes: DataFrame, keys: list[str], columns: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """UPDATE ... FROM: columns of rows that meet a row of changes get f(stored, changed)."""
    c = changes.select(*keys, *[F.col(x).alias(f"_{x}") for x in columns], F.lit(True).alias("_hit"))
    out = rows.join(c, keys, "left")
    return out.select(*[F.when(F.col("_hit"), columns[x](F.col(x), F.col(f"_{x}"))).otherwise(F.col(x)).alias(x) if x in columns else F.col(x) for x in rows.columns])


def reconcile(rows: DataFrame, truth: DataFrame, keys: list[str], column: str) -> DataFrame:
    """rows with the column of truth where the two differ, nulls counting as values; `changed` tells which."""
    t = truth.select(*keys, F.col(column).alias("_t"), F.lit(True).alias("_hit"))
    out = rows.join(t, keys, "left")
    differs = F.coalesce(F.col("_hit"), F.lit(False)) & ~F.col(column).eqNullSafe(F.col("_t"))
    return out.select(*[F.when(differs, F.col("_t")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in rows.columns], differs.alias("changed"))


def advance(stored: DataFrame, proposals: DataFrame, key: str, code: str, order: str) -> DataFrame:
    """(key, code, order): the stored stage, or a proposed one that is strictly further on; of equals the stored one stays."""
    both = stored.select(key, code, order, F.lit(1).alias("_s")).unionByName(proposals.select(key, code, order, F.lit(0).alias("_s")))
    best = both.where(F.col(order).isNotNull()).groupBy(key).agg(F.max_by(F.struct(code, order), F.struct(order, "_s", code)).alias("_b"))
    return best.select(key, f"_b.{code}", f"_b.{order}")


class NothingToArchive(ValueError):
    """A record is to be archived that isn't stored."""


def archive(parents: DataFrame, changed: DataFrame, keys: list[str], children: dict[str, DataFrame] | None = None, run: str = "", keep: dict[str, tuple[str, ...]] | None = None, strict: bool = False) -> dict[str, DataFrame]:
    """Copies of the changed parents and their children, with one history_id for each parent and run, as "" and the children's names.

    keep names the columns that the history of a child has (all if it isn't named). Changed keys without a parent make no history; with strict they raise NothingToArchive, whose text
    names some of them."""
    wanted = changed.select(*keys)
    if strict:
        lost = wanted.join(parents.select(*keys), keys, "left_anti").distinct().limit(5).collect()
        if lost:
            raise NothingToArchive(f"not stored: {[tuple(r) for r in lost]}")
    history = F.xxhash64(F.lit(run), *[F.col(k) for k in keys]).alias("history_id")
    old = parents.join(wanted, keys, "left_semi")
    out = {"": old.select(history, *parents.columns)}
    having = wanted if strict else old.select(*keys)  # with strict all are stored
    for name, rows in (children or {}).items():
        columns = [c for c in (keep or {}).get(name, rows.columns) if c in rows.columns]
        # keys that come more than once make no copies in a semi-join, so that no table of distinct ones is built and sorted
        out[name] = rows.join(having, keys, "left_semi").select(history, *columns)
    return out
