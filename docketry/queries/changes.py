"""Queries: change detection, filters, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import change as ch
from ..operators import filters as fl
from ..operators import resolve as rs
from ..operators import summary as sm
from .tables import Tables, incoming_orders, lines, query, shown, stored_orders

#: Incoming dates of half-open records are missing, and so are stored ones of others.
_DATES = "CASE WHEN i.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE i.d END AS di, CASE WHEN s.o_orderstatus = 'P' THEN NULL ELSE s.d END AS ds"
_BASE = f"(SELECT i.o_orderkey, i.price AS pi, s.price AS ps, s.o_orderkey IS NOT NULL AS was, s.o_orderpriority AS pr, {_DATES} FROM i_orders i LEFT JOIN s_orders s USING (o_orderkey))"
_REASON = ", CASE WHEN change = 'Unchanged' THEN CASE WHEN di IS NULL OR ds IS NULL THEN 'missing date' WHEN di < ds THEN 'regression' WHEN di = ds THEN 'equal' END END AS reason"


def _sides(t: Tables):
    inc = incoming_orders(t).withColumn("d", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("d")))
    return inc, stored_orders(t).withColumn("d", F.when(F.col("o_orderstatus") != "P", F.col("d")))


@query(f"SELECT o_orderkey, change{_REASON} FROM (SELECT *, CASE WHEN NOT was THEN 'New' WHEN di IS NULL OR ds IS NULL THEN 'Unchanged' WHEN di > ds THEN 'Updated' ELSE 'Unchanged' END AS change FROM {_BASE})")
def change_vote(t: Tables):
    inc, sto = _sides(t)
    return ch.classify(inc, sto, ["o_orderkey"], "d", "vote").select("o_orderkey", "change", "reason")


@query(f"SELECT o_orderkey, change{_REASON} FROM (SELECT *, CASE WHEN NOT was THEN 'New' WHEN ds IS NULL THEN 'Backfill' WHEN di IS NULL THEN 'Unchanged' WHEN di > ds THEN 'Updated' ELSE 'Unchanged' END AS change FROM {_BASE})")
def change_bill(t: Tables):
    inc, sto = _sides(t)
    return ch.classify(inc, sto, ["o_orderkey"], "d", "bill", placeholder=["d"]).select("o_orderkey", "change", "reason")


@query(f"SELECT o_orderkey, change{_REASON} FROM (SELECT *, CASE WHEN NOT was THEN 'New' WHEN di IS NULL THEN 'Unchanged' WHEN (ds IS NULL OR di > ds) AND pi IS DISTINCT FROM ps THEN 'Updated' ELSE 'Unchanged' END AS change FROM {_BASE})")
def change_member(t: Tables):
    inc, sto = _sides(t)
    return ch.classify(inc, sto, ["o_orderkey"], "d", "member", values=["price"]).select("o_orderkey", "change", "reason")


@query(f"SELECT o_orderkey, change{_REASON} FROM (SELECT *, CASE WHEN NOT was THEN 'New' WHEN di IS NULL OR ds IS NULL THEN 'Updated' WHEN di > ds THEN 'Updated' ELSE 'Unchanged' END AS change FROM {_BASE})")
def change_amendment(t: Tables):
    inc, sto = _sides(t)
    return ch.classify(inc, sto, ["o_orderkey"], "d", "amendment").select("o_orderkey", "change", "reason")


@query("""SELECT i.o_orderkey, i.o_orderstatus, CASE WHEN i.o_orderpriority = '1-URGENT' THEN 'Skipped' WHEN i.o_orderstatus IS NULL THEN 'Failed' WHEN s.o_orderstatus IS NULL THEN 'New' WHEN s.o_orderstatus <> i.o_orderstatus THEN 'Changed' ELSE 'Unchanged' END AS change
FROM i_orders i LEFT JOIN s_orders s USING (o_orderkey)""")
def change_text(t: Tables):
    best = incoming_orders(t).select("o_orderkey", "o_orderstatus", (F.col("o_orderpriority") != "1-URGENT").alias("has_selection"))
    return ch.classify_text(best, stored_orders(t), "o_orderkey", "o_orderstatus").drop("has_selection")


@query("SELECT coalesce(s.l_orderkey, i.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, i.l_linenumber) AS l_linenumber, CASE WHEN s.l_orderkey IS NULL THEN 'Added' WHEN i.l_orderkey IS NULL THEN 'Removed' WHEN s.qty = i.qty AND s.n = i.n THEN 'Same' ELSE 'Changed' END AS diff FROM s_lines s FULL OUTER JOIN i_lines i ON s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber")
def keyed_diff(t: Tables):
    return ch.keyed_diff(lines(t, "R"), lines(t, "A"), ["l_orderkey", "l_linenumber"])


_DIFF = "(SELECT coalesce(s.l_orderkey, i.l_orderkey) AS k, bool_or(s.qty IS DISTINCT FROM i.qty OR s.n IS DISTINCT FROM i.n) AS moved FROM s_lines s FULL OUTER JOIN i_lines i ON s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber GROUP BY 1)"


@query(f"SELECT o_orderkey, change, change = 'New' OR (change = 'Updated' AND coalesce(moved, false)) AS emit_event FROM (SELECT *, CASE WHEN NOT was THEN 'New' WHEN di IS NULL OR ds IS NULL THEN 'Unchanged' WHEN di > ds THEN 'Updated' ELSE 'Unchanged' END AS change FROM {_BASE}) LEFT JOIN {_DIFF} ON k = o_orderkey")
def route_events(t: Tables):
    """The date gate comes first: positions are compared for updated records only."""
    inc, sto = _sides(t)
    votes = ch.classify(inc, sto, ["o_orderkey"], "d", "vote").select("o_orderkey", "change")
    updated = votes.where("change = 'Updated'").select(F.col("o_orderkey").alias("l_orderkey"))
    diff = ch.keyed_diff(lines(t, "R").join(updated, "l_orderkey", "left_semi"), lines(t, "A").join(updated, "l_orderkey", "left_semi"), ["l_orderkey", "l_linenumber"])
    moved = diff.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or(F.col("diff") != "Same").alias("moved"))
    return votes.join(moved, "o_orderkey", "left").select("o_orderkey", "change", ch.routed(F.col("change"), F.col("moved")).alias("emit_event"))


@query("""SELECT p_partkey, l_orderkey FROM (SELECT p_partkey, l.l_orderkey, count(*) OVER (PARTITION BY l.l_orderkey) AS n FROM (SELECT p_partkey, p_size, 'Roll no. ' || CAST(p_size AS VARCHAR) AS txt, p_brand FROM part) p
JOIN (SELECT l_orderkey, CAST(max(l_quantity) AS INTEGER) AS q, 'Brand#' || CAST(max(l_linenumber) AS VARCHAR) AS b FROM lineitem GROUP BY 1) l ON l.b = p.p_brand AND l.q = CAST(nullif(regexp_extract(p.txt, '[Rr]oll *(?:no|call)\\.? *([0-9]+)', 1), '') AS INTEGER)) WHERE n = 1""")
def link_unique(t: Tables):
    """Actions that cite a roll are linked to it where they are the only ones."""
    acts = t.part.select("p_partkey", F.col("p_brand").alias("b"), keys.roll_number(F.concat(F.lit("Roll no. "), F.col("p_size").cast("string")), F.lit("House")).alias("q"))
    rolls = t.lineitem.groupBy("l_orderkey").agg(F.max("l_quantity").cast("int").alias("q"), F.concat(F.lit("Brand#"), F.max("l_linenumber").cast("string")).alias("b"))
    return rs.link_unique(acts, rolls, ["b", "q"], "l_orderkey").select("p_partkey", "l_orderkey")


@query("SELECT o_orderkey, c_custkey, c_custkey IS NULL AS unresolved FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON c_custkey = o_custkey")
def resolve_ids(t: Tables):
    ids = t.customer.where("c_mktsegment <> 'BUILDING'")
    return rs.resolve(t.orders, ids, "o_custkey", "c_custkey", "c_custkey", missing="flag").select("o_orderkey", "c_custkey", "unresolved")


@query("""SELECT event_id, member_id, lis_id FROM (SELECT event_id, c_custkey AS member_id, CAST(NULL AS BIGINT) AS lis_id FROM events JOIN customer ON c_custkey = user_id WHERE event_type IN ('view', 'click') UNION ALL
SELECT event_id, NULL, s_suppkey FROM events JOIN supplier ON s_suppkey = user_id WHERE event_type NOT IN ('view', 'click'))""")
def resolve_two_arms(t: Tables):
    a = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_custkey").alias("id"))
    b = t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_suppkey").alias("id"))
    out = rs.resolve_two_arms(t.events, a, b, F.col("event_type").isin("view", "click"), "user_id", "member_id", "lis_id")
    return out.where(rs.exactly_one(F.col("member_id"), F.col("lis_id"))).select("event_id", "member_id", "lis_id")


_PEOPLE = "(SELECT c_custkey, n_name AS last, c_mktsegment AS first, CAST(CAST(c_acctbal AS BIGINT) // 500 AS VARCHAR) AS state FROM customer JOIN nation ON n_nationkey = c_nationkey)"
_SEATS = "(SELECT s_suppkey, ' ' || lower(n_name) AS last, CASE WHEN CAST(s_acctbal AS BIGINT) // 1000 < 3 THEN 'building' WHEN CAST(s_acctbal AS BIGINT) // 1000 < 6 THEN 'Fritz' ELSE 'X' END AS first, CAST(CAST(s_acctbal AS BIGINT) // 500 AS VARCHAR) AS state FROM supplier JOIN nation ON n_nationkey = s_nationkey)"


@query(f"""SELECT s_suppkey, any_value(c_custkey) AS c_custkey FROM (SELECT s.s_suppkey, arg_min(p.c_custkey, (CASE WHEN n = 1 THEN 1 WHEN lower(p.first) = lower(s.first) THEN 2 ELSE 3 END, p.c_custkey)) AS c_custkey FROM {_SEATS} s
JOIN (SELECT *, count(*) OVER (PARTITION BY last, state) AS n FROM {_PEOPLE}) p ON lower(trim(p.last)) = lower(trim(s.last)) AND p.state = s.state AND (n = 1 OR lower(p.first) = lower(s.first) OR starts_with(lower(p.first), left(lower(s.first), 1))) GROUP BY 1
UNION ALL SELECT s_suppkey, NULL FROM supplier) GROUP BY 1""")
def resolve_fuzzy_tiered(t: Tables):
    n = t.nation.select("n_nationkey", "n_name")
    people = t.customer.join(n, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("n_name").alias("last"), F.col("c_mktsegment").alias("first"), F.expr("cast(cast(c_acctbal as decimal(18,0)) as long) div 500").cast("string").alias("state"))
    bal = F.expr("cast(cast(s_acctbal as decimal(18,0)) as long)")
    seats = t.supplier.join(n, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", F.concat(F.lit(" "), F.lower("n_name")).alias("last"), bal.alias("bal"))
    seats = seats.select("s_suppkey", "last", F.when(F.expr("bal div 1000") < 3, "building").when(F.expr("bal div 1000") < 6, "Fritz").otherwise("X").alias("first"), F.expr("bal div 500").cast("string").alias("state"))
    return rs.resolve_fuzzy(seats, people, "last", "first", "state", "c_custkey", "c_custkey", "s_suppkey").select("s_suppkey", "c_custkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN a.id ELSE b.id END AS id FROM orders LEFT JOIN (SELECT c_custkey AS k, c_custkey AS id FROM customer) a ON a.k = o_custkey
LEFT JOIN (SELECT lower(c_mktsegment) AS f, arg_max(c_custkey, c_custkey) AS id FROM customer GROUP BY 1) b ON f = lower(CASE o_orderpriority WHEN '1-URGENT' THEN 'Building' WHEN '2-HIGH' THEN 'Machinery' ELSE 'nobody' END)""")
def resolve_name_key(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("key"), F.lit("x").alias("first"), F.col("c_mktsegment").alias("last"), F.lit("us").alias("state"), F.col("c_custkey").alias("id"))
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("key"), F.lit(" X").alias("first"), F.when(F.col("o_orderpriority") == "1-URGENT", "Building").when(F.col("o_orderpriority") == "2-HIGH", "Machinery").otherwise("nobody").alias("last"), F.lit("US").alias("state"))
    return rs.resolve_by_name(rows, people, "key", "first", "last", "state", "id", "id").select("o_orderkey", "id")


@query("SELECT o_custkey, o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_returnflag = 'R'")
def member_positions(t: Tables):
    return t.orders.where("o_orderstatus = 'F'").join(t.lineitem.where("l_returnflag = 'R'"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "o_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 2")
def terms_for_period(t: Tables):
    return t.customer.join(t.nation.where("n_regionkey = 2"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", "n_name")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS has_mapping FROM customer")
def exists_flag(t: Tables):
    some = t.orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("has_mapping")).distinct()
    return t.customer.select("c_custkey").join(some, "c_custkey", "left").select("c_custkey", F.coalesce("has_mapping", F.lit(False)).alias("has_mapping"))


@query("SELECT l_orderkey, l_linenumber FROM i_lines EXCEPT SELECT l_orderkey, l_linenumber FROM s_lines")
def anti_tuples(t: Tables):
    return lines(t, "A").join(lines(t, "R"), ["l_orderkey", "l_linenumber"], "left_anti").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, (SELECT o_orderstatus FROM orders WHERE o_orderkey = k) AS stored_code FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS k FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def scalar_latest(t: Tables):
    last = t.orders.groupBy("o_custkey").agg(F.max_by("o_orderstatus", "o_orderkey").alias("stored_code"))
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "stored_code")


@query("""WITH RECURSIVE up AS (SELECT n_nationkey AS k, n_nationkey AS root, CASE WHEN n_nationkey > 0 THEN (n_nationkey - 1) // 3 END AS p, CASE WHEN n_regionkey = 4 THEN n_name END AS v, 0 AS depth FROM nation
UNION ALL SELECT up.k, n.n_nationkey, CASE WHEN n.n_nationkey > 0 THEN (n.n_nationkey - 1) // 3 END, coalesce(up.v, CASE WHEN n.n_regionkey = 4 THEN n.n_name END), up.depth + 1 FROM up JOIN nation n ON n.n_nationkey = up.p)
SELECT k AS n_nationkey, depth, root, v AS name, false AS failed FROM up WHERE p IS NULL""")
def parent_chain(t: Tables):
    rows = t.nation.select("n_nationkey", F.when(F.col("n_nationkey") > 0, F.expr("cast((n_nationkey - 1) div 3 as int)")).alias("p"), F.when(F.col("n_regionkey") == 4, F.col("n_name")).alias("name"))
    return rs.parent_chain(rows, "n_nationkey", "p", "name")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY event_type = 'signup' DESC, user_id DESC, event_id")
def candidates_ordered(t: Tables):
    return t.events.orderBy(*fl.pending_first(F.col("event_type") == "signup", F.col("user_id"), F.col("event_id"))).select("event_id", "user_id", "event_type")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW' AND (o_orderstatus = 'P' OR o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 86400000 SECOND)")
def stale_candidates(t: Tables):
    checked = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return t.orders.where((F.col("o_orderpriority") != "5-LOW") & fl.stale(checked, F.lit("2001-08-01").cast("timestamp"), 86_400_000)).select("o_orderkey")


@query("SELECT o_orderkey, o_orderstatus FROM s_orders WHERE o_orderstatus IS NOT NULL AND CASE WHEN o_orderpriority <> '3-MEDIUM' THEN substr(o_orderpriority, 3, 1) END IS DISTINCT FROM o_orderstatus AND o_custkey IN (1, 2, 3, 5, 8, 13, 21)")
def text_candidates(t: Tables):
    have = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.substring("o_orderpriority", 3, 1))
    return stored_orders(t).where(fl.needs_text(F.col("o_orderstatus"), have, F.col("o_custkey"), (1, 2, 3, 5, 8, 13, 21))).select("o_orderkey", "o_orderstatus")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 7 DAY")
def lookback_inclusive(t: Tables):
    return t.events.where(fl.within_lookback(F.col("ts"), F.lit("2024-01-20 12:00:00").cast("timestamp"), 7)).select("event_id")


@query("SELECT event_id, (CASE WHEN event_type <> 'view' THEN user_id END IS NULL) <> (CASE WHEN value < 50 THEN event_id END IS NULL) AS valid FROM events")
def xor_identity(t: Tables):
    a, b = F.when(F.col("event_type") != "view", F.col("user_id")), F.when(F.col("value") < 50, F.col("event_id"))
    return t.events.select("event_id", rs.exactly_one(a, b).alias("valid"))


@query("SELECT o_orderkey, o_orderstatus IS NULL OR o_orderpriority = '2-HIGH' AS placeholder FROM i_orders")
def placeholder_predicate(t: Tables):
    return incoming_orders(t).select("o_orderkey", ch.is_placeholder(F.col("o_orderstatus"), F.when(F.col("o_orderpriority") != "2-HIGH", F.col("d"))).alias("placeholder"))


@query("SELECT l_orderkey, bool_or(l_linenumber > 4 AND l_linenumber <= 6) AS recent FROM lineitem GROUP BY 1")
def window_any(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(fl.any_in_window(F.collect_list("l_linenumber"), 6, 2).alias("recent"))


@query("SELECT o_orderkey, CASE WHEN o_custkey BETWEEN 100 AND 900 THEN 'in' ELSE 'out' END AS side FROM orders")
def congress_split(t: Tables):
    a, b = fl.split(t.orders, fl.congress_range(F.col("o_custkey"), 100, 900))
    return a.select("o_orderkey", F.lit("in").alias("side")).unionByName(b.select("o_orderkey", F.lit("out").alias("side")))


@query("SELECT c AS congress, s.session FROM (SELECT unnest(range(greatest(1, m - 4), m + 1)) AS c FROM (SELECT max(CAST(floor((year(o_orderdate) - 1789) / 2.0) AS INTEGER) + 1) AS m FROM orders)), (VALUES (1), (2)) s(session)")
def congress_sessions(t: Tables):
    """The latest five congresses that have records, with both of their sessions."""
    from ..functions.dates import congress_of_year, recent_congresses
    from ..sources.feeds import congress_sessions as sessions

    last = t.orders.agg(F.max(congress_of_year(F.year("o_orderdate"))).alias("m"))
    return sessions(last.select(F.explode(recent_congresses(F.col("m").cast("long"), 5)).alias("congress")))


def flagship(spark, sf_dir: str):
    """Outcomes of one run: which orders are new, changed or the same, and why."""
    t = Tables(spark, sf_dir)
    inc, sto = _sides(t)
    found = ch.classify(inc, sto, ["o_orderkey"], "d", "vote")
    return sm.outcomes(found, "change", "reason").orderBy("change")


@query(f"SELECT change AS outcome, count(*) AS n FROM (SELECT CASE WHEN NOT was THEN 'New' WHEN di IS NULL OR ds IS NULL THEN 'Unchanged' WHEN di > ds THEN 'Updated' ELSE 'Unchanged' END AS change FROM {_BASE}) GROUP BY 1")
def outcome_summary(t: Tables):
    inc, sto = _sides(t)
    return sm.outcomes(ch.classify(inc, sto, ["o_orderkey"], "d", "vote").withColumnRenamed("change", "outcome"), "outcome")





@query("SELECT count(*) AS kept, (SELECT count(*) FROM orders WHERE o_custkey < 100) AS low, (SELECT count(*) FROM orders WHERE o_custkey > 900) AS high FROM orders WHERE o_custkey BETWEEN 100 AND 900")
def observed_range(t: Tables):
    """Rows out of range are counted while the kept ones are read."""
    rows, seen = sm.observed(t.orders, "range", low=F.col("o_custkey") < 100, high=F.col("o_custkey") > 900)
    kept = rows.where(fl.congress_range(F.col("o_custkey"), 100, 900)).agg(F.count("*").alias("kept")).first()["kept"]
    return t.spark.createDataFrame([(kept, seen.get["low"], seen.get["high"])], "kept long, low long, high long")
