"""Names and keys of one source resolved to the ids of another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.landing import written


def resolve(rows: DataFrame, ids: DataFrame, key: str, id_key: str, id_col: str, missing: str = "null") -> DataFrame:
    """rows with the id of their key. A key that nothing has: "null" keeps the row, "drop" drops it, "flag" adds `unresolved`."""
    out = rows.join(ids.select(F.col(id_key).alias("_k"), F.col(id_col)), F.col(key) == F.col("_k"), "inner" if missing == "drop" else "left").drop("_k")
    return out.withColumn("unresolved", F.col(id_col).isNull()) if missing == "flag" else out


def resolve_two_arms(rows: DataFrame, left_ids: DataFrame, right_ids: DataFrame, arm: Column, key: str, left: str, right: str) -> DataFrame:
    """Rows of two kinds, each with its own register (key, id): those for which arm is true get `left`, the others `right`; one of the two is always
    null. Rows that their register lacks are dropped."""
    a = rows.where(arm).join(left_ids.select(key, F.col("id").alias(left)), key).withColumn(right, F.lit(None).cast("long"))
    b = rows.where(~arm).join(right_ids.select(key, F.col("id").alias(right)), key).withColumn(left, F.lit(None).cast("long"))
    return a.unionByName(b)


def exactly_one(a: Column, b: Column) -> Column:
    return a.isNull() != b.isNull()


def resolve_fuzzy(rows: DataFrame, people: DataFrame, last: str, first: str, state: str, id_col: str, position: str, row_id: str) -> DataFrame:
    """rows with the id of the person of that last name and state. A sole candidate is taken; of several the one with the same first name, else the first
    listed whose first name has the same initial; else null. Case and surrounding blanks don't matter. row_id tells rows apart."""
    norm = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    p = people.where(F.col(last).isNotNull() & F.col(state).isNotNull()).select(
        norm(F.col(last)).alias("_l"), norm(F.col(state)).alias("_s"), norm(F.col(first)).alias("_f"), F.struct(F.col(position).alias("p"), F.col(id_col).alias("id")).alias("_p")
    )
    # the first listed of each first name, of each initial and of all, so that rows meet one person each and not all of a name
    named = p.groupBy("_l", "_s", "_f").agg(F.count("*").alias("_n"), F.min("_p").alias("_p"))
    initial = named.groupBy("_l", "_s", F.left("_f", F.lit(1)).alias("_i")).agg(F.min("_p").alias("_by_initial"))
    listed = named.groupBy("_l", "_s").agg(F.sum("_n").alias("_n"), F.min("_p").alias("_any"))
    key = {"_l": norm(F.col(last)), "_s": norm(F.col(state)), "_f": norm(F.col(first))}
    r = rows.withColumns(key | {"_i": F.when(key["_f"] != "", F.left(key["_f"], F.lit(1)))})
    r = r.join(listed, ["_l", "_s"], "left").join(named.select("_l", "_s", "_f", F.col("_p").alias("_by_first")), ["_l", "_s", "_f"], "left").join(initial, ["_l", "_s", "_i"], "left")
    best = F.when(F.col("_n") == 1, F.col("_any")).otherwise(F.coalesce("_by_first", "_by_initial"))
    return r.select(row_id, *[c for c in rows.columns if c != row_id], best["id"].alias(id_col))


def resolve_by_name(rows: DataFrame, people: DataFrame, key: str, first: str, last: str, state: str, id_col: str, position: str) -> DataFrame:
    """rows with the id that their key names; without a key, that of the person with their name and state (case apart), the last listed of several."""
    name = lambda: F.struct(F.lower(F.trim(first)).alias("f"), F.lower(F.trim(last)).alias("l"), F.upper(F.trim(state)).alias("s"))
    named = people.groupBy(name().alias("_name")).agg(F.max_by(id_col, position).alias("_by_name"))
    keyed = people.where(F.col(key).isNotNull()).groupBy(F.col(key)).agg(F.max_by(id_col, position).alias("_by_key"))
    out = rows.withColumn("_name", name()).join(named, "_name", "left").join(keyed, key, "left")
    return out.select(*rows.columns, F.when(F.col(key).isNotNull(), F.col("_by_key")).otherwise(F.col("_by_name")).alias(id_col))


def link_unique(left: DataFrame, right: DataFrame, keys: list[str], right_id: str) -> DataFrame:
    """Pairs of left and right with equal keys, of which the right row meets one left row only.

    Left rows are counted by key first and right rows meet the counts, so that no pairs are made of a key that many rows share: one row goes on for each right row at most. Rows of one right_id
    count together."""
    mine, theirs = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    counted = left.groupBy(*keys).agg(F.count("*").alias("_n"), F.any_value(F.struct(*[F.col(c).alias(f"_{k}") for k, c in enumerate(mine)], F.lit(0).alias("_"))).alias("_left"))
    met = right.join(counted, keys).groupBy(F.col(right_id).alias("_id")).agg(F.sum("_n").alias("_n"), F.any_value(F.struct("_left", F.struct(*keys, *theirs).alias("_right"))).alias("_pair"))
    row = [F.col(f"_pair._right.{c}") for c in keys] + [F.col(f"_pair._left._{k}").alias(c) for k, c in enumerate(mine)] + [F.col(f"_pair._right.{c}") for c in theirs]
    return met.where("_n = 1").select(*row)


def parent_chain(rows: DataFrame, key: str, parent: str, value: str, most: int = 10, salts: int = 64) -> DataFrame:
    """(key, depth, root, value, failed): the steps from each row up to the row without a parent, and the first value that is not null on the way. A parent that isn't stored ends the chain at its key.

    A chain that is longer than `most`, or runs in a circle, has failed; it has no depth, root or value. Each turn joins a table of ancestors with itself and doubles the steps that it covers, so
    most = 10 takes four joins. Rows that have arrived meet nothing, and are dealt over `salts` parts so that they make no large task."""
    is_root = F.col(parent).isNull()
    at = rows.select(F.col(key).alias("_k"), F.coalesce(parent, key).alias("_at"), F.when(is_root, 0).otherwise(1).alias("_n"), is_root.alias("_done"), F.col(value).alias("_v"))
    for _ in range((most + 1).bit_length()):
        at = written(at)
        up = at.select(F.col("_k").alias("_up"), F.col("_at").alias("_to"), F.col("_n").alias("_more"), F.col("_done").alias("_end"), F.col("_v").alias("_w"), F.lit(0).alias("_s"))
        open_ = at.select("*", F.when(~F.col("_done"), F.col("_at")).alias("_on"), F.when(F.col("_done"), F.pmod(F.xxhash64("_k"), F.lit(salts)).cast("int")).otherwise(F.lit(0)).alias("_salt"))
        step = open_.join(up, (F.col("_on") == F.col("_up")) & (F.col("_salt") == F.col("_s")), "left")
        found = F.col("_up").isNotNull()
        at = step.select("_k", F.when(found, F.col("_to")).otherwise(F.col("_at")).alias("_at"), (F.col("_n") + F.coalesce("_more", F.lit(0))).alias("_n"), F.coalesce("_end", F.lit(True)).alias("_done"), F.coalesce("_v", "_w").alias("_v"))
    failed = ~F.col("_done") | (F.col("_n") > most)
    return at.select(F.col("_k").alias(key), F.when(~failed, F.col("_n")).alias("depth"), F.when(~failed, F.col("_at")).alias("root"), F.when(~failed, F.col("_v")).alias(value), failed.alias("failed"))
