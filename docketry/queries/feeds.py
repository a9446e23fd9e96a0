"""Queries: feeds that are landed from the given tables as a fetcher would put them down, and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import texts
from ..sources import feeds, schemas
from ..sources.landing import shared
from .tables import Tables, query


def _land(rows: DataFrame, page: Column, body: Column) -> str:
    """One file for each page, holding the body (an aggregate over the page's rows)."""
    path = shared(rows.sparkSession)
    rows.groupBy(page.alias("page")).agg(body.alias("value")).repartition("page").write.partitionBy("page").text(path)
    return path


def _page(number: Column) -> Column:
    """Pages are of bounded size, so that there are more of them with more rows."""
    return F.floor(number / 2000)


def _xml(rows: DataFrame, number: Column, element: Column) -> str:
    """Documents of one root, with the elements of a page."""
    return _land(rows, _page(number), _element("all", F.array_join(F.collect_list(element), "")))


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _element(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"<{name}>"), F.lit(value) if isinstance(value, str) else value, F.lit(f"</{name}>"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS number, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS updateDate FROM orders WHERE (o_orderkey // 2000) % 8 <> 3")
def feed_list(t: Tables):
    """Pages of a list; one page has no list."""
    item = F.struct(F.lit(118).alias("congress"), F.col("o_orderkey").cast("string").alias("number"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updateDate"))
    body = F.when(F.first(_page(F.col("o_orderkey"))) % 8 == 3, F.lit('{"pagination": {"count": 1}}')).otherwise(_json(bills=F.collect_list(item)))
    return feeds.pages(t.spark, _land(t.orders, _page(F.col("o_orderkey")), body), schemas.BILL_ITEMS, "bills").select("number", "updateDate")


@query("SELECT c_name AS bioguideId, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS lastName FROM customer WHERE c_custkey % 5 <> 0")
def feed_details(t: Tables):
    """Records in their envelope; some are errors instead."""
    record = _json(member=F.struct(F.col("c_name").alias("bioguideId"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("lastName")))
    body = F.concat(F.lit("["), F.array_join(F.collect_list(F.when(F.col("c_custkey") % 5 == 0, F.lit('{"error": 404}')).otherwise(record)), ","), F.lit("]"))
    return feeds.details(t.spark, _land(t.customer, _page(F.col("c_custkey")), body), schemas.MEMBER, "member").select("bioguideId", "lastName")


@query("SELECT p_name AS name, '2024-01-' || lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0') AS updateDate FROM part")
def feed_subjects(t: Tables):
    item = F.struct(F.col("p_name").alias("name"), F.concat(F.lit("2024-01-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0")).alias("updateDate"))
    return feeds.subjects(t.spark, _land(t.part, _page(F.col("p_partkey")), _json(subjects=F.struct(F.collect_list(item).alias("legislativeSubjects")))))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS identifier, CAST(o_orderkey AS INTEGER) AS rollCallNumber, o_orderpriority AS sourceDataURL, 'House' AS chamber FROM orders")
def feed_house_votes(t: Tables):
    """Ids as numbers on some pages and as texts on others, and the data address in either spelling."""
    n = F.col("o_orderkey")
    number = F.concat(F.lit('{"identifier": '), n.cast("string"), F.lit(', "rollCallNumber": '), n.cast("string"), F.lit(', "sourceDataUrl": "'), F.col("o_orderpriority"), F.lit('"}'))
    text = F.concat(F.lit('{"identifier": "'), n.cast("string"), F.lit('", "rollCallNumber": '), n.cast("string"), F.lit(', "sourceDataURL": "'), F.col("o_orderpriority"), F.lit('"}'))
    items = F.array_join(F.collect_list(F.when(n % 8 > 3, number).otherwise(text)), ",")
    path = _land(t.orders, _page(n), F.concat(F.lit('{"houseRollCallVotes": ['), items, F.lit("]}")))
    return feeds.house_votes(t.spark, path).select("identifier", "rollCallNumber", "sourceDataURL", "chamber")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS identifier, s_name AS member, CASE WHEN s_suppkey % 2 = 0 THEN 'Yea' ELSE 'Nay' END AS cast_ FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey <> 2")
def feed_member_votes(t: Tables):
    """A page a vote; an empty list stands for a vote without members."""
    one = F.struct(F.col("s_name").alias("bioguideID"), F.when(F.col("s_suppkey") % 2 == 0, "Yea").otherwise("Nay").alias("voteCast"))
    vote = _json(houseRollCallVoteMemberVotes=F.struct(F.first("n_nationkey").cast("string").alias("identifier"), F.collect_list(one).alias("results")))
    body = F.when(F.first("n_regionkey") == 2, F.lit('{"houseRollCallVoteMemberVotes": []}')).otherwise(vote)
    path = _land(t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")), F.col("n_nationkey"), body)
    return feeds.house_vote_members(t.spark, path).select("identifier", F.explode("results").alias("r")).select("identifier", F.col("r.bioguideID").alias("member"), F.col("r.voteCast").alias("cast_"))


@query("SELECT n_nationkey, CAST(coalesce(n, 0) AS BIGINT) AS n FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey % 3 <> 1 GROUP BY 1) ON c_nationkey = n_nationkey")
def feed_text_versions(t: Tables):
    """Versions by key; a key without a file has none."""
    item = F.struct(F.col("c_name").alias("date"), F.col("c_mktsegment").alias("type"))
    path = _land(t.customer.where("c_nationkey % 3 <> 1"), F.col("c_nationkey"), _json(textVersions=F.collect_list(item)))
    key = F.regexp_extract(F.col("_metadata.file_path"), r"page=(\d+)/", 1).cast(t.nation.schema["n_nationkey"].dataType)
    return feeds.text_versions(t.spark, path, t.nation, "n_nationkey", key).select("n_nationkey", F.size("textVersions").cast("long").alias("n"))


@query("SELECT CAST(o_orderkey AS INTEGER) AS vote_number, CASE WHEN o_orderstatus = 'O' THEN 'Agreed & done' ELSE 'Rejected' END AS vote_result, o_orderpriority <> '1-URGENT' AS valid FROM orders")
def feed_senate_votes(t: Tables):
    """The result stands in one of two elements; votes without a date aren't valid."""
    result = F.when(F.col("o_orderstatus") == "O", _element("vote_result", " Agreed  &amp; done ")).otherwise(_element("result", "Rejected"))
    date = F.when(F.col("o_orderpriority") != "1-URGENT", _element("vote_date", F.date_format("o_orderdate", "MMMM d, yyyy"))).otherwise(F.lit(""))
    body = F.concat(_element("congress", "118"), _element("session", "1"), _element("vote_number", F.col("o_orderkey").cast("string")), date, result)
    return feeds.senate_votes(t.spark, _xml(t.orders, F.col("o_orderkey"), _element("roll_call_vote", body))).select("vote_number", "vote_result", "valid")


@query("SELECT CAST(p_partkey AS INTEGER) AS vote_number, CASE WHEN p_type = 'SMALL' THEN 'En Bloc' ELSE p_name END AS question, CASE WHEN p_type = 'SMALL' THEN 'En Bloc' ELSE 'Passed' END AS result FROM part WHERE p_size > 10 AND p_type <> 'LARGE'")
def feed_senate_menu(t: Tables):
    """Entries without a number or a question are dropped, but for those en bloc."""
    number = F.when(F.col("p_size") > 10, F.col("p_partkey").cast("string")).otherwise(F.lit("none"))
    known = F.when(F.col("p_type") == "SMALL", _element("en_bloc", "x")).when(F.col("p_type") == "LARGE", _element("result", "Passed")).otherwise(F.concat(_element("question", F.col("p_name")), _element("result", "Passed")))
    return feeds.senate_vote_list(t.spark, _xml(t.part, F.col("p_partkey"), _element("vote", F.concat(_element("vote_number", number), _element("vote_date", "01-Jan"), known)))).select("vote_number", "question", "result")


@query("SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS lis_id, s_name AS last_name, [CAST(s_nationkey AS INTEGER), 118] AS congresses, s_suppkey % 3 = 0 AS is_current FROM supplier WHERE s_suppkey % 4 <> 0")
def feed_senators(t: Tables):
    """Senators without their id are dropped; one who serves has a service without an end."""
    key = F.col("s_suppkey")
    end = F.when(key % 3 == 0, F.lit("<end_date/>")).otherwise(F.lit('<end_date year="2001"/>'))
    body = F.concat(_element("lisid", F.when(key % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("S"), key.cast("string")))), _element("bioguide", F.concat(F.lit("B"), key.cast("string"))), _element("full_name", _element("last_name", F.col("s_name"))),
                    _element("congresses", F.concat(_element("congress", F.col("s_nationkey").cast("string")), _element("congress", " 118 "), _element("congress", "x"))), F.lit('<service_dates><service_date class="1"><begin_date year="1999"/>'), end, F.lit("</service_date></service_dates>"))
    return feeds.senators(t.spark, _xml(t.supplier, F.col("s_suppkey"), _element("senator", body))).select("lis_id", "last_name", "congresses", "is_current")


@query("SELECT s_name AS bioguide, 'AG' || CAST(s_nationkey AS VARCHAR) AS code, CAST(s_suppkey % 9 AS INTEGER) AS rank FROM supplier UNION ALL SELECT s_name, 'AG15', NULL FROM supplier WHERE s_suppkey % 2 = 0")
def feed_house_members(t: Tables):
    """Seats in committees and subcommittees, their codes in either attribute."""
    seat = F.concat(F.lit('<committee comcode="AG'), F.col("s_nationkey").cast("string"), F.lit('" rank="'), (F.col("s_suppkey") % 9).cast("string"), F.lit('"/>'))
    sub = F.when(F.col("s_suppkey") % 2 == 0, F.lit('<subcommittee code="AG15"/>')).otherwise(F.lit(""))
    body = F.concat(_element("member-info", _element("bioguideID", F.col("s_name"))), _element("committee-assignments", F.concat(seat, sub)))
    return feeds.house_members(t.spark, _xml(t.supplier, F.col("s_suppkey"), _element("member", body))).select("bioguide", "code", "rank")


@query("SELECT s_name AS bioguide, 'L' || CAST(s_suppkey AS VARCHAR) AS lis_id, CASE WHEN s_suppkey % 2 = 0 THEN ['SSAG', 'SSBU'] ELSE ['SSBU'] END AS codes FROM supplier")
def feed_senate_identities(t: Tables):
    """Ids as elements or as attributes; codes are sorted and each stands once."""
    even, lis = F.col("s_suppkey") % 2 == 0, F.concat(F.lit("L"), F.col("s_suppkey").cast("string"))
    committees = F.when(even, F.lit('<committees><committee code="SSBU"/><committee>SSAG</committee><committee code="SSBU"/></committees>')).otherwise(F.lit('<committees><committee code="SSBU"/></committees>'))
    elements = F.concat(F.lit("<senator>"), _element("bioguide_id", F.col("s_name")), _element("lis_member_id", lis))
    attributes = F.concat(F.lit('<senator bioguide_id="'), F.col("s_name"), F.lit('" lis_member_id="'), lis, F.lit('">'))
    return feeds.senate_identities(t.spark, _xml(t.supplier, F.col("s_suppkey"), F.concat(F.when(even, elements).otherwise(attributes), committees, F.lit("</senator>")))).select("bioguide", "lis_id", "codes")


@query("SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'SSAG' ELSE 'SSAG1' END || CAST(s_nationkey AS VARCHAR) AS code, s_suppkey % 2 = 1 AS is_subcommittee, s_name AS last_name FROM supplier WHERE s_nationkey % 5 <> 0")
def feed_senate_rosters(t: Tables):
    """Members of committees and of their subcommittees; a body that is an HTML page means not found."""
    member = lambda odd: F.array_join(F.collect_list(F.when(F.col("s_suppkey") % 2 == odd, _element("member", _element("name", _element("last", F.col("s_name")))))), "")
    code = F.first("s_nationkey").cast("string")
    found = _element("committee_membership", _element("committees", F.concat(_element("committee_code", F.concat(F.lit("SSAG"), code)), _element("members", member(0)), _element("subcommittee", F.concat(_element("committee_code", F.concat(F.lit("SSAG1"), code)), _element("members", member(1)))))))
    body = F.when(F.first("s_nationkey") % 5 == 0, F.lit("<!DOCTYPE html><html>Not found</html>")).otherwise(found)
    return feeds.senate_rosters(t.spark, _land(t.supplier, F.col("s_nationkey"), body)).select("code", "is_subcommittee", "last_name")


@query("SELECT p_partkey // 2000 AS page, CAST(count(*) AS BIGINT) AS n FROM part WHERE p_partkey % 2 = 0 GROUP BY 1")
def feed_directory(t: Tables):
    """Listings of committees among other granules; tags and entities are gone from their text."""
    n = _page(F.col("p_partkey"))
    path = shared(t.spark)
    for name, odd in (("CDIR-2024-HOUSECOMMITTEES", 0), ("CDIR-2024-BIOGRAPHIES", 1)):
        rows = t.part.where(F.col("p_partkey") % 2 == odd).groupBy(n.alias("page")).agg(F.array_join(F.collect_list(F.lit("<b>x</b>&amp;")), "").alias("value"))
        rows.repartition("page").write.partitionBy("page").text(f"{path}/{name}")
    rows = t.spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"/(CDIR[^/]*)/page=(\d+)", 1).alias("id"), F.regexp_extract("_metadata.file_path", r"page=(\d+)", 1).cast("long").alias("page"), "value")
    kept = feeds.listing_text(rows, "page")
    return kept.select("page", F.length(F.regexp_replace("text", r"\s+", "")).cast("long").alias("n"))


@query(r"""SELECT doc_id, CASE WHEN doc_id % 4 = 1 THEN 'unsupported format: DOC' END AS error, CASE WHEN doc_id % 4 > 1 AND text IS NOT NULL THEN trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(160), ' '),
'\[[\s\v]*Time:[^\]]+\]', '', 'g'), '\[\[[\s\v]*Page[\s\v]+[-0-9A-Za-z]+[\s\v]*\]\]', '', 'g'), '\b(Page|Pg)[\s\v]+[A-Za-z]?[0-9]+(-[0-9]+)?\b', '', 'g'), '[\s\v]+', ' ', 'g')) END AS text FROM documents""")
def feed_record_documents(t: Tables):
    """All documents as pages of the record, with time and page marks among their text: HTML gives text, a PDF waits for its parser, other formats are errors of their row."""
    page = F.col("text")
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        page = F.replace(page, F.lit(raw), F.lit(name))
    page = F.concat(F.lit("<html><body><pre>[Time: 10:30 a.m.] "), page, F.lit(" [[Page S52-55]]\n\nPg S5255 </pre></body></html>"))
    kind = F.when(F.col("doc_id") % 4 == 0, "PDF").when(F.col("doc_id") % 4 == 1, "DOC").otherwise("HTML")
    found = texts.extract_record(texts.decoded(F.encode(page, "UTF-8")), kind)
    return t.documents.select("doc_id", found.alias("x")).select("doc_id", "x.error", "x.text")


def _parse(raw: bytes) -> str:
    """Stands in for a parser that fails on some documents."""
    if len(raw) % 7 == 0:
        raise TimeoutError("slow")
    if len(raw) % 5 == 0:
        raise ValueError("broken")
    return raw.decode()


@query("SELECT doc_id, CASE WHEN strlen(text) % 7 = 0 THEN 'Transient' ELSE 'Systemic' END AS class, CASE WHEN strlen(text) % 7 = 0 THEN 'timeout: TimeoutError slow' ELSE 'parse: ValueError broken' END AS reason FROM documents WHERE strlen(text) % 7 = 0 OR strlen(text) % 5 = 0")
def failed_documents(t: Tables):
    """Documents that a parser fails on, why, and whether to try again; the others go on."""
    rows = texts.extract_with(t.documents.select("doc_id", F.encode("text", "UTF-8").alias("raw")), "raw", _parse)
    return texts.failed_rows(rows, "doc_id", "text_error")
