"""Queries: keyed writes and histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge as m
from ..operators.merge import MergeSpec
from .tables import Tables, incoming_orders, lines, query, shown, stored_orders

_MERGED = """SELECT coalesce(s.o_orderkey, i.o_orderkey) AS o_orderkey, {status} AS o_orderstatus, CAST({price} AS DOUBLE) AS price, CAST({d} AS VARCHAR) AS d
FROM s_orders s FULL OUTER JOIN i_orders i ON s.o_orderkey = i.o_orderkey"""
_I = "CASE WHEN i.o_orderkey IS NOT NULL THEN i.{0} ELSE s.{0} END"
_OUT = ("o_orderkey", "o_orderstatus", "price", "d")


@query(_MERGED.format(status=_I.format("o_orderstatus"), price=_I.format("price"), d=_I.format("d")))
def upsert_lww(t: Tables):
    return shown(m.merge(stored_orders(t), incoming_orders(t), MergeSpec(("o_orderkey",))).select(*_OUT))


@query(_MERGED.format(status="CASE WHEN s.o_orderkey IS NULL THEN i.o_orderstatus ELSE s.o_orderstatus END", price=_I.format("price"), d=_I.format("d")))
def upsert_owned_cols(t: Tables):
    return shown(m.merge(stored_orders(t), incoming_orders(t), MergeSpec(("o_orderkey",), update=("price", "d"))).select(*_OUT))


_NEWER = "CASE WHEN s.o_orderkey IS NULL OR i.d > s.d THEN i.{0} ELSE s.{0} END"


@query(_MERGED.format(status=_NEWER.format("o_orderstatus"), price=_NEWER.format("price"), d=_NEWER.format("d")))
def upsert_newest_wins(t: Tables):
    spec = MergeSpec(("o_orderkey",), guard=lambda s, i: i("d") > s("d"))
    return shown(m.merge(stored_orders(t), incoming_orders(t), spec).select(*_OUT))


@query(_MERGED.format(status="coalesce(i.o_orderstatus, s.o_orderstatus)", price=_I.format("price"), d=_I.format("d")))
def upsert_coalesce_parent(t: Tables):
    return shown(m.merge(stored_orders(t), incoming_orders(t), MergeSpec(("o_orderkey",), keep_if_null=("o_orderstatus",))).select(*_OUT))


@query("SELECT coalesce(s.o_orderkey, i.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN 'Inserted' WHEN i.o_orderkey IS NULL THEN 'Kept' ELSE 'Updated' END AS status FROM s_orders s FULL OUTER JOIN i_orders i ON s.o_orderkey = i.o_orderkey")
def upsert_with_status(t: Tables):
    return m.merge(stored_orders(t), incoming_orders(t), MergeSpec(("o_orderkey",)), status="status").select("o_orderkey", "status")


@query("""SELECT coalesce(s.o_orderkey, i.o_orderkey) AS o_orderkey, coalesce(s.o_orderstatus, i.o_orderstatus) AS o_orderstatus, CASE WHEN s.o_orderkey IS NULL THEN 'Inserted' WHEN i.o_orderkey IS NULL THEN 'Kept' ELSE 'Updated' END AS status
FROM s_orders s FULL OUTER JOIN i_orders i ON s.o_orderkey = i.o_orderkey AND s.o_orderstatus = i.o_orderstatus""")
def upsert_null_key(t: Tables):
    """A key with a null part meets nothing, so it is inserted beside the stored row."""
    return m.merge(stored_orders(t), incoming_orders(t), MergeSpec(("o_orderkey", "o_orderstatus")), status="status").select("o_orderkey", "o_orderstatus", "status")


@query("SELECT i.o_orderkey, c.c_name, CAST(i.price AS DOUBLE) AS price FROM i_orders i JOIN customer c ON c.c_custkey = i.o_custkey WHERE c.c_mktsegment <> 'BUILDING'")
def upsert_known_parents_only(t: Tables):
    """Rows whose parent isn't stored vanish before the write."""
    known = t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    rows = incoming_orders(t).join(known, "o_custkey").select("o_orderkey", "c_name", "price")
    return shown(m.merge(rows.limit(0), rows, MergeSpec(("o_orderkey",))))


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL
SELECT DISTINCT o_custkey, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def insert_placeholders(t: Tables):
    stored = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_mktsegment")
    return m.insert_absent(stored, t.orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""SELECT coalesce(s.c_custkey, i.k) AS c_custkey, s.c_name, CASE WHEN s.c_custkey IS NULL OR i.k IS NOT NULL THEN 'run' ELSE 'old' END AS touched
FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') s FULL OUTER JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01') i ON s.c_custkey = i.k""")
def touch_placeholders(t: Tables):
    """A key that is stored is only touched, others are inserted."""
    stored = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", F.lit("old").alias("touched"))
    keys = t.orders.where("o_orderdate >= TIMESTAMP '2001-06-01'").select(F.col("o_custkey").alias("c_custkey"), F.lit("run").alias("touched")).distinct()
    return m.merge(stored, keys, MergeSpec(("c_custkey",), update=("touched",)))


@query("SELECT l_orderkey, l_linenumber, qty FROM s_lines WHERE l_orderkey NOT IN (SELECT l_orderkey FROM i_lines) UNION ALL SELECT l_orderkey, l_linenumber, qty FROM i_lines")
def replace_children(t: Tables):
    return m.replace_children(lines(t, "R"), lines(t, "A"), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "qty")


@query("""SELECT l_orderkey, l_linenumber, qty, 'stored' AS side FROM s_lines WHERE l_orderkey NOT IN (SELECT l_orderkey FROM i_lines GROUP BY 1 HAVING bool_and(qty <= 60)) UNION ALL
SELECT l_orderkey, l_linenumber, qty, CASE WHEN l_orderkey IN (SELECT l_orderkey FROM i_lines WHERE qty > 60) THEN 'rejected' ELSE 'stored' END FROM i_lines""")
def replace_valid_children(t: Tables):
    """One bad child rejects all of its parent's; that parent keeps what is stored."""
    after, bad = m.replace_valid_children(lines(t, "R"), lines(t, "A"), ["l_orderkey"], F.col("qty") <= 60)
    cols = ("l_orderkey", "l_linenumber", "qty")
    return after.select(*cols, F.lit("stored").alias("side")).unionByName(bad.select(*cols, F.lit("rejected").alias("side")))


@query("SELECT s.l_orderkey, s.l_linenumber, s.qty FROM s_lines s LEFT JOIN (SELECT l_orderkey, COUNT(*) AS c FROM i_lines GROUP BY 1) i USING (l_orderkey) WHERE c IS NULL OR s.l_linenumber <= c")
def trim_tail(t: Tables):
    counts = lines(t, "A").groupBy("l_orderkey").agg((F.count("*") + 1).alias("c"))
    return m.trim_tail(lines(t, "R"), counts, "l_orderkey", "l_linenumber", "c").select("l_orderkey", "l_linenumber", "qty")


@query("SELECT s.o_orderkey, CAST(coalesce(i.d, s.d) AS VARCHAR) AS fetched, CASE WHEN i.o_orderkey IS NOT NULL THEN length(i.o_orderpriority) END AS text_length FROM s_orders s LEFT JOIN i_orders i USING (o_orderkey)")
def mark_complete(t: Tables):
    done = incoming_orders(t).select("o_orderkey", F.col("d").alias("fetched"), F.length("o_orderpriority").cast("long").alias("text_length"))
    rows = stored_orders(t).select("o_orderkey", F.col("d").alias("fetched"), F.lit(None).cast("long").alias("text_length"))
    return shown(m.set_where(rows, done, ["o_orderkey"], {"fetched": lambda s, i: i, "text_length": lambda s, i: i}))


@query("SELECT c_custkey, c_mktsegment, k IS NOT NULL AS has_orders, CAST(last AS VARCHAR) AS orders_updated FROM customer LEFT JOIN (SELECT o_custkey AS k, max(d) AS last FROM i_orders GROUP BY 1) ON k = c_custkey")
def flag_upsert(t: Tables):
    flags = t.customer.select("c_custkey", "c_mktsegment", F.lit(False).alias("has_orders"), F.lit(None).cast("date").alias("orders_updated"))
    came = incoming_orders(t).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("d").alias("orders_updated")).withColumn("has_orders", F.lit(True))
    return shown(m.merge(flags, came, MergeSpec(("c_custkey",), update=("has_orders", "orders_updated"))))


@query("SELECT s.o_orderkey, coalesce(s.o_orderstatus, x.o_orderstatus) AS o_orderstatus FROM i_orders s LEFT JOIN s_orders x USING (o_orderkey)")
def set_parent_where_null(t: Tables):
    return m.set_where(incoming_orders(t), stored_orders(t), ["o_orderkey"], {"o_orderstatus": lambda s, i: F.coalesce(s, i)}).select("o_orderkey", "o_orderstatus")


@query("SELECT s.o_orderkey, CASE WHEN i.o_orderkey IS NOT NULL THEN '2024-01-01 00:00:00' ELSE CAST(s.d AS VARCHAR) || ' 00:00:00' END AS last_check FROM s_orders s LEFT JOIN i_orders i USING (o_orderkey)")
def touch_checked(t: Tables):
    rows = stored_orders(t).select("o_orderkey", F.col("d").cast("timestamp").alias("last_check"))
    out = m.set_where(rows, incoming_orders(t).select("o_orderkey", F.lit("2024-01-01").cast("timestamp").alias("last_check")), ["o_orderkey"], {"last_check": lambda s, i: i})
    return out.select("o_orderkey", F.date_format("last_check", "yyyy-MM-dd HH:mm:ss").alias("last_check"))


@query("SELECT c_custkey, k AS latest FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderkey, (d, o_orderkey)) AS k FROM i_orders GROUP BY 1) ON o_custkey = c_custkey")
def link_latest(t: Tables):
    last = incoming_orders(t).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey", F.struct("d", "o_orderkey")).alias("latest"))
    return m.set_where(t.customer.select("c_custkey", F.lit(None).cast("long").alias("latest")), last, ["c_custkey"], {"latest": lambda s, i: i})


@query("""SELECT c.o_custkey, CASE WHEN c.d IS NULL OR n.d >= c.d THEN n.k ELSE c.k END AS latest FROM (SELECT o_custkey, arg_max(o_orderkey, (d, o_orderkey)) AS k, max(d) AS d FROM s_orders GROUP BY 1) c
JOIN (SELECT o_custkey, arg_max(o_orderkey, (d, o_orderkey)) AS k, max(d) AS d FROM i_orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) n USING (o_custkey)""")
def link_latest_guarded(t: Tables):
    """The link moves only to a version that is no older."""
    latest = lambda df: df.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "d"), F.struct("d", "o_orderkey")).alias("v"))
    new = latest(incoming_orders(t).where("o_orderpriority = '1-URGENT'"))
    rows = latest(stored_orders(t)).join(new.select("o_custkey"), "o_custkey", "left_semi")
    out = m.set_where(rows, new, ["o_custkey"], {"v": lambda s, i: F.when(s.isNull() | (i["d"] >= s["d"]), i).otherwise(s)})
    return out.select("o_custkey", F.col("v.o_orderkey").alias("latest"))


_STAGE = "CASE o_orderstatus WHEN 'O' THEN 10 WHEN 'P' THEN 30 WHEN 'F' THEN 60 END"


@query(f"""SELECT o_custkey, arg_max(o_orderstatus, (ord, s, o_orderstatus)) AS stage, max(ord) AS ord FROM (
SELECT o_custkey, arg_min(o_orderstatus, (d, o_orderkey)) AS o_orderstatus, CAST(arg_min({_STAGE}, (d, o_orderkey)) AS INTEGER) AS ord, 1 AS s FROM s_orders GROUP BY 1 UNION ALL
SELECT o_custkey, o_orderstatus, {_STAGE}, 0 FROM i_orders) WHERE ord IS NOT NULL GROUP BY 1""")
def monotone_advance(t: Tables):
    """A stage is taken over only if it is further on than the stored one."""
    order = F.expr(_STAGE).cast("int")
    stored = stored_orders(t).withColumn("ord", order).groupBy("o_custkey").agg(F.min_by(F.struct(F.col("o_orderstatus").alias("stage"), "ord"), F.struct("d", "o_orderkey")).alias("x")).select("o_custkey", "x.*")
    came = incoming_orders(t).select("o_custkey", F.col("o_orderstatus").alias("stage"), order.alias("ord"))
    return m.advance(stored, came, "o_custkey", "stage", "ord")


@query("SELECT s.o_orderkey, CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus, i.o_orderkey IS NOT NULL AND i.o_orderstatus IS DISTINCT FROM s.o_orderstatus AS changed FROM s_orders s LEFT JOIN i_orders i USING (o_orderkey)")
def reconcile(t: Tables):
    return m.reconcile(stored_orders(t).select("o_orderkey", "o_orderstatus"), incoming_orders(t), ["o_orderkey"], "o_orderstatus")


@query("""SELECT 'order' AS kind, o_orderkey, CAST(NULL AS INTEGER) AS l_linenumber, CAST(price AS DOUBLE) AS value FROM s_orders WHERE o_orderkey IN (SELECT o_orderkey FROM i_orders) UNION ALL
SELECT 'line', l_orderkey, l_linenumber, CAST(qty AS DOUBLE) FROM s_lines WHERE l_orderkey IN (SELECT o_orderkey FROM s_orders) AND l_orderkey IN (SELECT o_orderkey FROM i_orders)""")
def archive_before_overwrite(t: Tables):
    """Parents and children of changed keys, each with its parent's history id."""
    old = m.archive(stored_orders(t), incoming_orders(t), ["o_orderkey"], {"lines": lines(t, "R").withColumnRenamed("l_orderkey", "o_orderkey")}, run="r1")
    a = old[""].select("history_id", F.lit("order").alias("kind"), "o_orderkey", F.lit(None).cast("int").alias("l_linenumber"), F.col("price").cast("double").alias("value"))
    b = old["lines"].select("history_id", F.lit("line").alias("kind"), "o_orderkey", "l_linenumber", F.col("qty").cast("double").alias("value"))
    return a.unionByName(b).where("history_id IS NOT NULL").drop("history_id")
