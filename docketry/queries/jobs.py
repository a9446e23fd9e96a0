"""Queries: whole runs of ingestion jobs against a catalog in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import change as ch
from ..operators import merge as m
from ..operators import texts
from ..plans import ingest as job
from ..plans import reference as ref
from ..sources import chunks
from ..sources.landing import shared
from ..sources.snapshots import Catalog
from .tables import Tables, incoming_orders, lines, query, shown, stored_orders


@query("""SELECT coalesce(s.c, i.c) AS member, coalesce(s.y, i.y) AS start_year, coalesce(s.p, i.p) AS party_name, coalesce(i.a, s.a) AS party_abbreviation FROM
(SELECT o_custkey AS c, CAST(year(d) AS INTEGER) AS y, o_orderpriority AS p, min(o_orderstatus) AS a FROM s_orders GROUP BY 1, 2, 3) s FULL OUTER JOIN
(SELECT o_custkey AS c, CAST(year(d) AS INTEGER) AS y, o_orderpriority AS p, max(coalesce(o_orderstatus, 'N')) AS a FROM i_orders GROUP BY 1, 2, 3) i ON s.c = i.c AND s.y = i.y AND s.p = i.p""")
def append_party_history(t: Tables):
    """Entries by member, year and party: new ones are appended, stored ones take over the abbreviation."""
    entry = lambda df, a: df.select(F.col("o_custkey").alias("member"), F.year("d").alias("start_year"), F.col("o_orderpriority").alias("party_name"), a.alias("party_abbreviation"))
    stored = entry(stored_orders(t), F.col("o_orderstatus")).groupBy("member", "start_year", "party_name").agg(F.min("party_abbreviation").alias("party_abbreviation"))
    return m.append_or_touch(stored, entry(incoming_orders(t), F.coalesce("o_orderstatus", F.lit("N"))), ["member", "start_year", "party_name"], ["party_abbreviation"])


@query("SELECT i.history_id IS NOT NULL AS kept, l_linenumber, qty FROM (SELECT o_orderkey AS history_id FROM s_orders WHERE o_orderkey IN (SELECT o_orderkey FROM i_orders)) i JOIN s_lines ON l_orderkey = history_id")
def archive_votes(t: Tables):
    """A vote's history keeps some columns of its positions; one that isn't stored is an error."""
    rows = stored_orders(t).select("o_orderkey", "o_orderstatus")
    changed = incoming_orders(t).join(rows, "o_orderkey", "left_semi")
    positions = lines(t, "R").withColumnRenamed("l_orderkey", "o_orderkey")
    old = m.archive(rows, changed, ["o_orderkey"], {"positions": positions}, "r1", {"positions": ("l_linenumber", "qty")}, strict=True)["positions"]
    assert old.columns == ["history_id", "l_linenumber", "qty"]
    return old.select(F.col("history_id").isNotNull().alias("kept"), "l_linenumber", "qty")


@query("""SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey, arg_max(CASE WHEN o_orderstatus = 'F' THEN 'Senate' ELSE 'House' END, (year(o_orderdate), -o_orderkey)) AS chamber FROM orders GROUP BY 1) ON o_custkey = c_custkey
WHERE coalesce(chamber, '') <> 'Senate' OR c_mktsegment = 'BUILDING'""")
def member_event_gate(t: Tables):
    """Senators wait for their mapping; others, also those without a term, don't."""
    terms = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("congress"), F.when(F.col("o_orderstatus") == "F", "Senate").otherwise("House").alias("chamber"), "o_orderkey")
    return ch.member_events(t.customer.select("c_custkey"), terms, t.customer.where("c_mktsegment = 'BUILDING'"), "c_custkey", "congress", "o_orderkey")


def _votes(df):
    return df.select(F.col("o_orderkey").alias("vote_key"), F.col("d").alias("update_date"), F.coalesce("o_orderstatus", F.lit("none")).alias("result"))


def _positions(t, without, votes):
    return lines(t, without, votes.select(F.col("vote_key").alias("l_orderkey"))).select(F.col("l_orderkey").alias("vote_key"), F.lit("House").alias("chamber"), F.col("l_linenumber").cast("string").alias("member_key"), F.col("qty").cast("string").alias("position"))


_RUN = "(SELECT i.o_orderkey AS k, i.d, coalesce(i.o_orderstatus, 'none') AS r, s.o_orderkey IS NULL AS new FROM i_orders i LEFT JOIN s_orders s USING (o_orderkey) WHERE s.o_orderkey IS NULL OR i.d > s.d)"


@query(f"""SELECT 'vote' AS kind, k AS vote_key, r AS value, CAST(1 AS BIGINT) AS n FROM {_RUN} UNION ALL SELECT 'vote', o_orderkey, coalesce(o_orderstatus, 'none'), 1 FROM s_orders WHERE o_orderkey NOT IN (SELECT k FROM {_RUN})
UNION ALL SELECT 'positions', l_orderkey, CAST(sum(qty) AS VARCHAR), count(*) FROM (SELECT l_orderkey, qty FROM i_lines WHERE l_orderkey IN (SELECT k FROM {_RUN}) UNION ALL SELECT l_orderkey, qty FROM s_lines WHERE l_orderkey IN (SELECT o_orderkey FROM s_orders) AND l_orderkey NOT IN (SELECT k FROM {_RUN})) GROUP BY 2
UNION ALL SELECT 'history', k, s.o_orderstatus, 1 FROM {_RUN} JOIN s_orders s ON s.o_orderkey = k""")
def ingest_votes(t: Tables):
    """Two runs of a feed, the second one repeated: votes, their positions and what was archived."""
    c = Catalog(t.spark, shared(t.spark))
    for run, df, side in (("r1", stored_orders(t), "R"), ("r2", incoming_orders(t), "A"), ("r2", incoming_orders(t), "A")):
        votes = _votes(df)
        job.ingest(c, job.VOTES, votes, {"vote_positions": _positions(t, side, votes)}, run, event="vote.recorded")
    one = F.lit(1).cast("long").alias("n")
    out = c.read("votes").select(F.lit("vote").alias("kind"), "vote_key", F.col("result").alias("value"), one)
    out = out.unionByName(c.read("vote_positions").groupBy("vote_key").agg(F.sum(F.col("position").cast("long")).cast("string").alias("value"), F.count("*").alias("n")).withColumn("kind", F.lit("positions")))
    return out.unionByName(c.read("votes_history").select(F.lit("history").alias("kind"), "vote_key", F.col("result").alias("value"), one))


@query("""SELECT coalesce(i.o_orderkey, s.o_orderkey) AS bill_key, CASE WHEN s.o_orderkey IS NOT NULL THEN CASE WHEN s.o_orderpriority = '2-HIGH' THEN 'IS' ELSE 'IH' END ELSE CASE WHEN i.o_orderpriority = '2-HIGH' THEN 'IS' ELSE 'IH' END END AS code
FROM s_orders s FULL OUTER JOIN i_orders i ON i.o_orderkey = s.o_orderkey WHERE coalesce(s.o_orderpriority, i.o_orderpriority) <> '5-LOW'""")
def ingest_bills(t: Tables):
    """A bill's stage is at least that of its chamber's first print; bills of no known chamber have none."""
    c = Catalog(t.spark, shared(t.spark))
    stages = t.spark.createDataFrame([("IH", 10), ("IS", 10)], "code string, order int")
    chamber = F.when(F.col("o_orderpriority") == "2-HIGH", "Senate").when(F.col("o_orderpriority") != "5-LOW", "House")
    for run, df in (("r1", stored_orders(t)), ("r2", incoming_orders(t))):
        bills = df.select(F.col("o_orderkey").alias("bill_key"), F.col("d").alias("update_date"), F.lit("k").alias("sponsor_key"), F.col("d").alias("introduced_date"), F.col("d").alias("latest_action_date"), chamber.alias("origin_chamber"))
        subjects = bills.select("bill_key", F.lit("Budget").alias("subject_name"))
        job.ingest(c, job.BILLS, bills, {"bill_subjects": subjects}, run, stages=stages)
    return c.read("bills_stages").select("bill_key", "code")


@query("""WITH p AS (SELECT o_custkey AS c, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS p, max(o_orderstatus) AS a FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2, 3),
q AS (SELECT o_custkey AS c, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS p, 'x' AS a FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1, 2, 3)
SELECT CAST(coalesce(p.c, q.c) AS VARCHAR) AS bioguide, coalesce(p.y, q.y) AS start_year, coalesce(p.p, q.p) AS party_name, coalesce(q.a, p.a) AS party_abbreviation FROM p FULL OUTER JOIN q ON p.c = q.c AND p.y = q.y AND p.p = q.p""")
def ingest_members(t: Tables):
    """A member's run replaces terms and appends party history."""
    c = Catalog(t.spark, shared(t.spark))
    for k, (low, high, abbreviation) in enumerate((("1900-01-01", "2000-01-01", F.col("o_orderstatus")), ("1999-01-01", "2100-01-01", F.lit("x")))):
        rows = t.orders.where(f"o_orderdate >= TIMESTAMP '{low}' AND o_orderdate < TIMESTAMP '{high}'").withColumn("bioguide", F.col("o_custkey").cast("string"))
        none = F.lit(None).cast("string")
        members = rows.groupBy("bioguide").agg(F.lit(f"run {k}").alias("first_name")).select("bioguide", F.lit(f"202{k}-01-01").alias("update_date"), "first_name", none.alias("last_name"), none.alias("current_party"), none.alias("state"), none.alias("district"))
        party = rows.select("bioguide", F.year("o_orderdate").alias("start_year"), F.col("o_orderpriority").alias("party_name"), abbreviation.alias("party_abbreviation"))
        terms = rows.select("bioguide", F.year("o_orderdate").alias("congress"), F.lit("House").alias("chamber")).distinct()
        job.ingest(c, job.MEMBERS, members, {"member_terms": terms, "member_party_history": party}, f"r{k}", event="member.updated")
    return c.read("member_party_history")


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Failed' WHEN n > 0 THEN 'Succeeded' ELSE 'Skipped' END AS result, CASE WHEN o_orderpriority = '1-URGENT' THEN 'timeout' WHEN coalesce(n, 0) = 0 THEN 'no-new-versions' END AS reason,
CASE WHEN o_orderpriority = '1-URGENT' THEN 'old' ELSE 'now' END AS stamp, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE CAST(coalesce(n, 0) AS BIGINT) END AS events
FROM s_orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM i_lines ANTI JOIN s_lines USING (l_orderkey, l_linenumber, qty) GROUP BY 1) ON l_orderkey = o_orderkey""")
def check_availability(t: Tables):
    """One run of a checker over the stored orders: what is offered of each, what of it is new, and who is stamped."""
    c = Catalog(t.spark, shared(t.spark))
    rows = stored_orders(t).select("o_orderkey", "o_orderpriority", F.lit("2020-01-01").cast("timestamp").alias("last_check"))
    c.commit({"bills": rows})
    version = lambda df: df.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("number"), "qty")
    none = F.lit(None).cast("string")
    offered = version(lines(t, "A")).withColumn("error", none).unionByName(rows.where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit(None).cast("int").alias("number"), F.lit(None).cast("long").alias("qty"), F.lit("timeout").alias("error")))
    results = job.check_texts(c, "bills", "o_orderkey", rows, offered, version(lines(t, "R")), ["number", "qty"], "r1", "2024-06-01", "text.available")
    sent = c.read("events").groupBy(F.get_json_object("payload", "$.o_orderkey").cast("long").alias("o_orderkey")).agg(F.count("*").alias("events"))
    stamp = F.when(F.year("last_check") == 2024, "now").otherwise("old").alias("stamp")
    out = results.join(c.read("bills").select("o_orderkey", stamp), "o_orderkey").join(sent, "o_orderkey", "left")
    return shown(out.select("o_orderkey", "result", "reason", "stamp", F.coalesce("events", F.lit(0)).cast("long").alias("events")))


@query("SELECT CAST(doc_id AS VARCHAR) AS version_key, CAST(unnest(range(len(cs))) AS INTEGER) AS chunk_index, unnest(cs) AS content FROM (SELECT doc_id, list_filter(list_transform(range(1, greatest(1, length(t)) + 1, 500), lambda i: trim(substr(t, i, 500), ' ')), lambda c: c <> '') AS cs FROM (SELECT doc_id, regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS t FROM documents))")
def ingest_texts(t: Tables):
    """Texts of new versions into chunks; a second run leaves what is complete alone."""
    c = Catalog(t.spark, shared(t.spark))
    docs = t.documents.select(F.col("doc_id").cast("string").alias("version_key"), F.col("source").alias("document_key"), F.lit("2024").alias("version_date"), F.lit("Text").alias("format"), F.col("text").alias("content"))
    job.store_texts(c, docs, "r1", chunk_size=500)
    job.store_texts(c, docs.withColumn("content", F.lit("changed")), "r2", chunk_size=500)
    return chunks.live(c).select("version_key", "chunk_index", "content")


def _model(some: list[str]) -> list[list[float]]:
    """Stands in for a model: how long a text is, and whether it says flag."""
    return [[float(len(s)), float("flag" in s)] for s in some]


@query("""WITH v AS (SELECT o_orderkey AS k, o_custkey AS c, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderpriority AS p FROM orders),
ends AS (SELECT k, c, CASE WHEN p = '2-HIGH' THEN '9999' ELSE d END AS d, p, CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'r2' ELSE 'r1' END AS run FROM v)
SELECT CAST(k AS VARCHAR) AS version_key, d AS version_date, run AS fetched_in, 'text of ' || k || CASE WHEN p = '2-HIGH' THEN ' anew' ELSE '' END AS content,
CASE WHEN p = '1-URGENT' THEN 1 ELSE 2 END AS events, d = max(d) OVER (PARTITION BY c) AS latest_date FROM ends""")
def store_amendment_texts(t: Tables):
    """Two runs over versions of the orders: those that have no text in the first run come again in the second, those of a later date replace their chunks, and the others are skipped and announced again."""
    c = Catalog(t.spark, shared(t.spark))
    p = F.col("o_orderpriority")
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("version_key"), F.col("o_custkey").cast("string").alias("document_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("version_date"), p, F.concat(F.lit("text of "), F.col("o_orderkey").cast("string")).alias("content"))
    kind = ["version_key", "document_key", "version_date", F.when(p == "1-URGENT", "PDF").otherwise("Text").alias("format"), "content"]
    job.store_texts(c, rows.select(*kind), "r1", model=_model, dims=2, newest_wins=True)
    later = rows.withColumn("version_date", F.when(p == "2-HIGH", "9999").otherwise(F.col("version_date"))).withColumn("content", F.when(p == "2-HIGH", F.concat("content", F.lit(" anew"))).when(p == "1-URGENT", F.col("content")).otherwise("changed"))
    job.store_texts(c, later.select(*kind[:3], F.lit("Text").alias("format"), "content"), "r2", model=_model, dims=2, newest_wins=True)
    sent = c.read("events").groupBy(F.get_json_object("payload", "$.version_key").alias("version_key")).agg(F.countDistinct("event_id").cast("int").alias("events"))
    stored = c.read("text_versions").join(chunks.live(c).where("embedding[0] = length(content)").select("version_key", "content"), "version_key")
    latest = c.read("text_latest").select("document_key", F.col("version_date").alias("_last"))
    out = stored.join(sent, "version_key").join(latest, "document_key")
    return out.select("version_key", "version_date", "fetched_in", "content", "events", (F.col("version_date") == F.col("_last")).alias("latest_date"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS version_key, CASE WHEN text IS NULL THEN 'no text' END AS reason, CASE WHEN text IS NOT NULL THEN 'r2' END AS fetched_in, CASE WHEN text IS NULL THEN 0 ELSE len(list_filter(list_transform(range(1, greatest(1, length(t)) + 1, 700), lambda i: trim(substr(t, i, 700), ' ')), lambda c: c <> '')) END AS n
FROM (SELECT doc_id, text, regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS t FROM documents)""")
def failed_vectors_stay_open(t: Tables):
    """A model that fails leaves versions open, with nothing stored; the run after it completes them."""
    c = Catalog(t.spark, shared(t.spark))
    docs = t.documents.select(F.col("doc_id").cast("string").alias("version_key"), F.lit("d").alias("document_key"), F.lit("2024").alias("version_date"), F.lit("Text").alias("format"), F.col("text").alias("content"))
    said = docs.where(F.col("content").isNull() | F.col("content").rlike(r"[^\s\x00]"))  # a blank text asks nothing of a model, is complete at once, and so comes with the second run
    first = job.store_texts(c, said, "r1", chunk_size=700, model=lambda some: 1 / 0, dims=1)
    if not first.where("outcome = 'Stored'").isEmpty() or not chunks.live(c).isEmpty():
        raise ValueError("a model that fails stored something")
    second = job.store_texts(c, docs, "r2", chunk_size=700, model=lambda some: [[1.0] for _ in some], dims=1)
    n = chunks.live(c).groupBy("version_key").agg(F.count("*").cast("int").alias("n"))
    out = second.join(c.read("text_versions").select("version_key", "fetched_in"), "version_key").join(n, "version_key", "left")
    return out.select("version_key", "reason", "fetched_in", F.coalesce("n", F.lit(0)).cast("int").alias("n"))


@query("""SELECT s_name AS bioguide, 'L' || s_suppkey AS lis_id, s_nationkey % 2 = 0 AS in_first, CAST(1 AS BIGINT) AS events, '2024-02-01' AS verified FROM supplier WHERE s_suppkey % 3 = 0 OR 100 + s_suppkey % 20 BETWEEN 117 AND 118""")
def refresh_senator_ids(t: Tables):
    """Two runs over a register: senators in the window are mapped once their member is stored, and only a new mapping sends an event."""
    c = Catalog(t.spark, shared(t.spark))
    known = t.supplier.select("s_name", F.col("s_suppkey").alias("n"), "s_nationkey")
    senators = known.select(F.concat(F.lit("L"), "n").alias("lis_id"), F.col("s_name").alias("bioguide"), F.lit("Ann").alias("first_name"), F.col("s_name").alias("last_name"), F.lit("").alias("party"), F.lit("OH").alias("state"), F.array((100 + F.col("n") % 20).cast("int")).alias("congresses"), (F.col("n") % 3 == 0).alias("is_current"))
    members = known.select(F.col("s_name").alias("bioguide"), "s_nationkey")
    ref.refresh_mappings(c, senators, members.where("s_nationkey % 2 = 0"), 118, 2, "r1", "2024-01-01")
    first = c.read("member_lis_mapping").select("bioguide", F.lit(True).alias("in_first"))
    ref.refresh_mappings(c, senators, members, 118, 2, "r2", "2024-02-01")
    sent = c.read("events").groupBy(F.get_json_object("payload", "$.bioguide").alias("bioguide")).agg(F.count("*").alias("events"))
    out = c.read("member_lis_mapping").join(first, "bioguide", "left").join(sent, "bioguide")
    return out.select("bioguide", "lis_id", F.coalesce("in_first", F.lit(False)).alias("in_first"), "events", F.date_format("last_verified", "yyyy-MM-dd").alias("verified"))


@query("""SELECT 'C' || s_nationkey AS committee, s_suppkey AS member_id, CAST(110 + s_suppkey % 2 AS INTEGER) AS congress, CASE WHEN s_suppkey % 3 = 0 THEN 'Chairman' WHEN s_suppkey % 3 = 1 THEN 'Vice Chairman' END AS role FROM supplier WHERE s_suppkey % 5 <> 0 AND s_nationkey <> 4""")
def load_committee_history(t: Tables):
    """Printed rosters of two congresses: people who didn't serve in the roster's congress are left out, and so are those of a committee that isn't stored."""
    c = Catalog(t.spark, shared(t.spark))
    rows = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).withColumns({"last": F.regexp_replace("s_name", "#", ""), "congress": (110 + F.col("s_suppkey") % 2).cast("int")})
    role = F.when(F.col("s_suppkey") % 3 == 0, ", Chair").when(F.col("s_suppkey") % 3 == 1, ", Vice Chairman").otherwise("")
    pages = rows.select("s_suppkey", "congress", F.concat(F.lit("COMMITTEES\nCommittee on "), "n_name", F.lit("\n      Ann Q. "), "last", F.lit(", of West Virginia"), role).alias("text"))
    names = [r["n_name"] for r in t.nation.select("n_name").collect()]  # a printed directory names a few hundred committees
    found = texts.parse_rosters(pages, [f"Committee on {n}" for n in names], ["Virginia", "West Virginia"], key="s_suppkey").join(pages.select("s_suppkey", "congress"), "s_suppkey")
    served = rows.select(F.col("s_suppkey").alias("member_id"), (F.col("congress") + F.when(F.col("s_suppkey") % 5 == 0, 7).otherwise(0)).alias("congress"), F.lit("ann").alias("first_name"), F.upper("last").alias("last_name"), F.lit(" west virginia ").alias("state"), F.col("s_suppkey").alias("position"))
    committees = t.nation.where("n_nationkey <> 4").select(F.concat(F.lit("C"), "n_nationkey").alias("code"), F.concat(F.lit("COMMITTEE, ON "), "n_name").alias("name"))
    for _ in range(2):
        ref.load_history(c, found, served, committees)
    return c.read("committee_members").select("committee", "member_id", "congress", "role")


@query("""WITH house AS (SELECT s_suppkey AS m, CASE WHEN s_suppkey % 10 = 0 THEN 'NEW' || s_nationkey ELSE 'C' || s_nationkey END AS code, s_suppkey % 9 AS rank FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey % 7 <> 0),
senate AS (SELECT s_suppkey AS m, 'C' || s_nationkey AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'Chairman' END AS role FROM supplier WHERE s_suppkey % 2 = 1 AND s_suppkey % 7 <> 0),
seats AS (SELECT code, m AS member_id, CAST(NULL AS VARCHAR) AS role, CAST(rank AS INTEGER) AS rank FROM house UNION ALL SELECT code, m, role, NULL FROM senate)
SELECT code AS committee, coalesce(n_name || ' anew', code) AS name, CASE WHEN n_nationkey > 0 THEN 'C0' END AS parent_code, member_id, role, rank FROM seats LEFT JOIN nation ON code = 'C' || n_nationkey""")
def refresh_committee_seats(t: Tables):
    """Two runs: committees keep the parent that they have when none comes, House seats go by id, Senate seats by name, and unknown committees get placeholders."""
    c = Catalog(t.spark, shared(t.spark))
    code = lambda prefix, n: F.concat(F.lit(prefix), n)
    committees = t.nation.select(code("C", "n_nationkey").alias("code"), F.col("n_name").alias("name"), F.lit("House").alias("chamber"), F.when(F.col("n_nationkey") > 0, "C0").alias("parent_code"))
    s, odd = F.col("s_suppkey"), F.col("s_suppkey") % 2 == 1
    house = t.supplier.where(~odd).select(F.col("s_name").alias("bioguide"), F.when(s % 10 == 0, code("NEW", "s_nationkey")).otherwise(code("C", "s_nationkey")).alias("code"), (s % 9).cast("int").alias("rank"), F.lit("majority").alias("side"))
    people = t.supplier.where(odd).select(F.col("s_name").alias("bioguide"), F.lit("Ann").alias("first_name"), F.col("s_name").alias("last_name"), F.lit("OH").alias("state"))
    rosters = t.supplier.where(odd).select(code("C", "s_nationkey").alias("code"), F.lit(" ANN ").alias("first_name"), F.lower("s_name").alias("last_name"), F.lit("oh").alias("state"), F.when(s % 3 == 0, " Chairman ").otherwise("Clerk").alias("position"))
    members = t.supplier.where("s_suppkey % 7 <> 0").select(F.col("s_name").alias("bioguide"), s.alias("member_id"))
    for k in range(2):
        now = committees if k == 0 else committees.withColumns({"parent_code": F.lit(None).cast("string"), "name": F.concat("name", F.lit(" anew"))})
        ref.refresh_committees(c, now, house, people, rosters, members, 118, f"2024-0{k + 1}-01")
    out = c.read("committee_members").join(c.read("committees").select(F.col("code").alias("committee"), "name", "parent_code"), "committee", "left")
    return out.select("committee", "name", "parent_code", "member_id", "role", "rank")


@query("""WITH st(p, code, ord) AS (VALUES ('1-URGENT', 'IH', 10), ('2-HIGH', 'RH', 20), ('3-MEDIUM', 'EH', 30), ('4-NOT SPECIFIED', 'ENR', 40)),
r AS (SELECT o_custkey AS k, code, ord, o_orderdate AS d, CASE WHEN o_orderstatus <> 'P' THEN 'order ' || o_orderkey END AS t, o_orderdate < TIMESTAMP '1998-01-01' AS first FROM orders JOIN st ON p = o_orderpriority),
one AS (SELECT * FROM r WHERE first QUALIFY row_number() OVER (PARTITION BY k ORDER BY ord DESC, d DESC, t DESC NULLS LAST) = 1),
two AS (SELECT * FROM r WHERE NOT first QUALIFY row_number() OVER (PARTITION BY k ORDER BY ord DESC, d DESC, t DESC NULLS LAST) = 1),
texts AS (SELECT k, code, t FROM two WHERE t IS NOT NULL UNION ALL SELECT k, code, t FROM one WHERE t IS NOT NULL AND NOT EXISTS (SELECT 1 FROM two WHERE two.k = one.k AND two.code = one.code AND two.t IS NOT NULL))
SELECT coalesce(one.k, two.k) AS bill_key, CASE WHEN two.ord > coalesce(one.ord, 0) THEN two.code ELSE one.code END AS stage, (SELECT count(*) FROM texts WHERE texts.k = coalesce(one.k, two.k)) AS summaries, (SELECT max(t) FROM texts WHERE texts.k = coalesce(one.k, two.k)) AS last_text
FROM one FULL OUTER JOIN two ON one.k = two.k""")
def ingest_summaries(t: Tables):
    """Two runs of a feed of summaries: the furthest of each bill counts, stages only rise, and bills that aren't stored get placeholders."""
    c = Catalog(t.spark, shared(t.spark))
    stages = t.spark.createDataFrame([("IH", 10), ("RH", 20), ("EH", 30), ("ENR", 40)], "code string, order int")
    code = F.create_map(*[F.lit(x) for kv in (("1-URGENT", "IH"), ("2-HIGH", "RH"), ("3-MEDIUM", "EH"), ("4-NOT SPECIFIED", "ENR"), ("5-LOW", "??")) for x in kv])[F.col("o_orderpriority")]
    said = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("<p><b>order</b>\n&nbsp; "), "o_orderkey", F.lit("</p> "))).otherwise("<p> </p>")
    rows = t.orders.select(F.col("o_custkey").alias("bill_key"), code.alias("version_code"), F.col("o_orderdate").alias("action_date"), F.lit("d").alias("action_desc"), said.alias("text"), (F.col("o_orderdate") < "1998-01-01").alias("first"))
    for first in (True, False):
        ref.store_summaries(c, rows.where(F.col("first") == first).drop("first"), stages)
    n = c.read("bill_summaries").groupBy("bill_key").agg(F.count("*").alias("summaries"), F.max("text").alias("last_text"))
    out = c.read("bills").join(c.read("bills_stages").select("bill_key", F.col("code").alias("stage")), "bill_key").join(n, "bill_key", "left")
    return out.select("bill_key", "stage", F.coalesce("summaries", F.lit(0)).cast("long").alias("summaries"), "last_text")
