"""Queries: ranking, de-duplication, aggregation, vectors and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import rank as rk
from ..operators import summary as sm
from ..operators.merge import MergeSpec
from ..sources.landing import shared
from .tables import Tables, query

_PRIO = {"A": 0, "N": 1}


@query("SELECT l_partkey, l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS d, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END, pos DESC) AS rn FROM (SELECT *, CAST(l_orderkey AS HUGEINT) * 1000000000 + l_linenumber * 100000000 + CAST(l_extendedprice * 100 AS BIGINT) AS pos FROM lineitem) WHERE l_returnflag IN ('A', 'N')) WHERE rn = 1")
def best_version(t: Tables):
    """The latest date, then the better format, then the last listed; formats without a priority are out."""
    pos = F.expr("cast(l_orderkey as decimal(38,0)) * 1000000000 + l_linenumber * 100000000 + cast(round(l_extendedprice * 100) as long)")
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", F.to_date("l_shipdate").cast("string").alias("d"), "l_returnflag", pos.alias("pos"))
    return rk.best_version(rows, "l_partkey", "d", "l_returnflag", "pos", _PRIO).drop("pos")


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END, l_partkey) AS rn FROM lineitem WHERE l_returnflag IN ('A', 'N')) WHERE rn = 1")
def best_format(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    return rk.best_format(rows, ["l_orderkey", "l_linenumber"], "l_returnflag", "l_partkey", _PRIO).drop("l_partkey")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type <> 'view' THEN ts END DESC NULLS LAST, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_per_key(t: Tables):
    rows = t.events.withColumn("at", F.when(F.col("event_type") != "view", F.col("ts")))
    return rk.latest_per_key(rows, ["user_id"], "at", [F.col("event_id").desc()]).select("user_id", "event_id")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) END DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def current_term(t: Tables):
    rows = t.orders.withColumn("congress", F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate")))
    return rk.current_term(rows, "o_custkey", "congress", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT user_id, event_type, arg_min(event_id, event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2")
def first_wins(t: Tables):
    return rk.first_wins(t.events.select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("SELECT user_id, event_type, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def last_wins(t: Tables):
    return rk.last_wins(t.events.select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("SELECT DISTINCT p_brand FROM part ORDER BY 1")
def distinct_sorted(t: Tables):
    return t.part.select("p_brand").distinct().orderBy("p_brand")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 1, 2")
def duplicate_keys(t: Tables):
    return rk.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 END DESC, o_orderkey) AS rn FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderpriority < '4' GROUP BY 1, 2)) WHERE rn = 1")
def max_by_rank(t: Tables):
    orders = t.spark.createDataFrame([("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3)], "o_orderpriority string, order int")
    rows = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("o_orderkey"))
    return rk.best_summary(rows, "o_custkey", "o_orderpriority", orders).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE value > 50) AS large, count(*) FILTER (WHERE event_type = 'error' AND value > 50) AS bad FROM events")
def counts(t: Tables):
    return sm.tally(t.events, views=F.col("event_type") == "view", large=F.col("value") > 50, bad=(F.col("event_type") == "error") & (F.col("value") > 50))


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def distinct_count(t: Tables):
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("SELECT source, CAST(least(coalesce(sum(length(text)), 0), 2147483647) AS INTEGER) AS text_length FROM documents GROUP BY 1")
def len_sum(t: Tables):
    return sm.text_length(t.documents, "source", "text")


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS completed_at FROM events WHERE event_type = 'purchase' AND value > 30")
def run_watermark(t: Tables):
    """The last success of a step, from a log of runs."""
    runs = t.events.select(F.col("event_type").alias("step_name"), F.when(F.col("value") > 30, "Succeeded").otherwise("Failed").alias("status"), F.col("ts").alias("completed_at"))
    return sm.last_success(runs, "purchase").select(F.date_format("completed_at", "yyyy-MM-dd HH:mm:ss").alias("completed_at"))


@query("SELECT o_custkey, list_sort(list(o_orderkey)) AS keys FROM orders GROUP BY 1")
def grouped_candidates(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys"))


@query("SELECT l_orderkey, count(*) AS expected, count(*) FILTER (WHERE l_linestatus = 'F') AS done FROM lineitem GROUP BY 1 HAVING count(*) = count(*) FILTER (WHERE l_linestatus = 'F')")
def complete_documents(t: Tables):
    from ..streaming.incremental import complete_documents as complete

    expected = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("expected"))
    done = complete(t.lineitem.where("l_linestatus = 'F'"), expected, "l_orderkey")
    return expected.join(done, "l_orderkey").select("l_orderkey", "expected", F.col("expected").alias("done"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 13)")
def without_failed(t: Tables):
    from ..streaming.incremental import without_failed as keep

    return keep(t.lineitem, t.lineitem.where("l_quantity = 13"), "l_orderkey").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey AS id, 'customer' AS side FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def bag_union(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("side")).unionByName(t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("side")))


@query("SELECT vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 4) AS similarity FROM embeddings ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) DESC, vec_id LIMIT 20")
def cosine_topk(t: Tables):
    q = t.embeddings.where("vec_id = 0").first()["embedding"]
    return rk.cosine_topk(t.embeddings, q, 20).select("vec_id", "label", F.round("similarity", 4).alias("similarity"))


@query("SELECT vec_id, true AS same, len(embedding) AS dims FROM embeddings")
def vector_codec(t: Tables):
    """Vectors to text and back."""
    back = arrays.vector_from_text(arrays.vector_to_text(F.col("embedding")))
    return t.embeddings.select("vec_id", (back == F.col("embedding")).alias("same"), F.size(back).cast("long").alias("dims"))


@query("SELECT vec_id, len(embedding) = 64 AS fits FROM embeddings")
def vector_dims(t: Tables):
    return t.embeddings.select("vec_id", arrays.has_dims(F.col("embedding"), 64).alias("fits"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_event_roundtrip(t: Tables):
    """Events wrapped in an envelope, decoded again; undecodable ones would be apart."""
    from ..sources.feeds import events
    from ..streaming.incremental import outbox

    rows = t.events.select("event_id", F.from_json("props", "k long").alias("p")).select("event_id", "p.k")
    good, _ = events(outbox(rows, "seen", "events", "r1", ["event_id", "k"]).select("payload"), "payload", "event_id long, k long")
    return good.select("event_id", "k")


def _landed(t: Tables, name: str) -> str:

    path = f"{shared(t.spark)}/{name}"
    t.events.select("event_id", "user_id", "event_type", "value", "ts").repartition(4).write.parquet(f"{path}/in")
    return path


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_upsert(t: Tables):
    """Events drained from files in batches, each merged into a versioned table; the last one of a user stays."""
    from ..sources.snapshots import Catalog
    from ..streaming.incremental import drain, upsert_sink

    path = _landed(t, "upsert")
    catalog = Catalog(t.spark, f"{path}/tables")
    schema = t.spark.read.parquet(f"{path}/in").schema
    drain(t.spark, f"{path}/in", schema, upsert_sink(catalog, "last", MergeSpec(("user_id",)), "event_id"), f"{path}/checkpoint", files_a_batch=2)
    return catalog.read("last").select("user_id", "event_id", "value")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_drain(t: Tables):
    """A file stream drained to its end; what a second drain would find is nothing."""
    from ..streaming.incremental import drain

    path = _landed(t, "drain")
    schema = t.spark.read.parquet(f"{path}/in").schema
    sink = lambda batch, k: batch.write.mode("overwrite").parquet(f"{path}/out/batch={k}")
    for _ in range(2):
        drain(t.spark, f"{path}/in", schema, sink, f"{path}/checkpoint", files_a_batch=2)
    return t.spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_id, event_type, value FROM events")
def stream_once(t: Tables):
    """Events of two jobs, sent twice each, as a lost run would; each is delivered once."""
    from ..sources.snapshots import Catalog
    from ..streaming.incremental import deliver, drain_once

    path = shared(t.spark)
    catalog = Catalog(t.spark, f"{path}/tables")
    send = lambda rows: rows.select("event_id", "event_type", "value").write.mode("append").parquet(f"{path}/in")
    for half in (0, 1):
        rows = t.events.where(F.col("event_id") % 2 == half)
        catalog.commit({}, {"events": rows})
        send(rows)
        deliver(catalog, send)
        drain_once(t.spark, f"{path}/in", t.spark.read.parquet(f"{path}/in").schema, lambda b, k, half=half: b.write.mode("overwrite").parquet(f"{path}/out/call={half}/batch={k}"), f"{path}/checkpoint", "event_id", files_a_batch=4)
    return t.spark.read.parquet(f"{path}/out").select("event_id", "event_type", "value")


@query("""WITH n AS (SELECT l_orderkey AS k, count(*) AS n, bool_or(l_returnflag = 'R' AND l_linenumber = 1) AS bad, bool_or(l_linenumber = 7) AS short FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_returnflag DESC) GROUP BY 1)
SELECT k AS document, CASE WHEN bad THEN 'Failed' ELSE 'Complete' END AS outcome, CASE WHEN bad THEN 'model: slow' END AS reason, CASE WHEN bad THEN 1 ELSE n END AS n FROM n WHERE bad OR NOT short""")
def complete_in_stream(t: Tables):
    """Lines as chunks of their orders, which come in several batches and twice: orders all of whose chunks came are given out, one failure drops an order, and orders that miss their seventh chunk stay held back."""
    from ..sources.snapshots import Catalog
    from ..streaming.incremental import complete_sink, drain

    path = shared(t.spark)
    catalog = Catalog(t.spark, f"{path}/tables")
    rows = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))
    n = rows.groupBy("l_orderkey").agg(F.count("*").alias("expected"))
    bad = (F.col("flag") == "R") & (F.col("l_linenumber") == 1)
    chunks = rows.join(n, "l_orderkey").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").cast("long").alias("chunk_index"), "expected", F.when(bad, "model: slow").alias("failed"), F.lit("2024-01-01").cast("timestamp").alias("at"))
    chunks = chunks.where("chunk_index <> 7").unionByName(chunks.where("chunk_index = 2"))
    chunks.repartition(max(4, int(t.spark.conf.get("spark.sql.shuffle.partitions")))).write.parquet(f"{path}/in")
    half = -(-len(t.spark.read.parquet(f"{path}/in").inputFiles()) // 2)
    drain(t.spark, f"{path}/in", chunks.schema, complete_sink(catalog, "done", "document"), f"{path}/checkpoint", files_a_batch=max(1, half))
    return catalog.read("done").groupBy("document", "outcome").agg(F.max("failed").alias("reason"), F.count("*").alias("n"))
