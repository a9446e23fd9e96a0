import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docketry.operators.merge import MergeSpec
from docketry.sources import feeds, schemas
from docketry.sources.snapshots import Catalog
from docketry.streaming import incremental


def put(path, name, content):
    path.mkdir(exist_ok=True)
    (path / name).write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


def test_pages_and_details(spark, tmp_path):
    p = put(tmp_path / "bills", "1.json", {"bills": [{"congress": 118, "number": "1", "type": "HR"}], "pagination": {"count": 3, "next": "x"}})
    put(tmp_path / "bills", "2.json", {"pagination": {"count": 3}})
    put(tmp_path / "bills", "3.json", {"bills": [{"congress": 118, "number": "2", "type": "S"}, {"congress": 119, "number": "3"}]})
    assert feeds.pages(spark, p, schemas.BILL_ITEMS, "bills").count() == 3
    d = put(tmp_path / "detail", "1.json", {"bill": {"congress": 118, "number": "1", "sponsors": [{"bioguideId": "A1"}]}})
    put(tmp_path / "detail", "2.json", {"error": 1})
    assert feeds.details(spark, d, schemas.BILL, "bill").select("sponsors.bioguideId").collect()[0][0] == ["A1"]


def test_house_votes(spark, tmp_path):
    p = put(tmp_path / "v", "1.json", {"houseRollCallVotes": [{"congress": 119, "identifier": 11912025001, "rollCallNumber": 1, "sourceDataUrl": "u"}, {"congress": 119, "identifier": "2", "rollCallNumber": 2, "sourceDataURL": "w"}]})
    rows = feeds.house_votes(spark, p).orderBy("rollCallNumber").collect()
    assert [(r["identifier"], r["sourceDataURL"], r["chamber"]) for r in rows] == [("11912025001", "u", "House"), ("2", "w", "House")]
    m = put(tmp_path / "m", "1.json", {"houseRollCallVoteMemberVotes": []})
    put(tmp_path / "m", "2.json", {"houseRollCallVoteMemberVotes": {"congress": 119, "rollCallNumber": 2, "results": [{"bioguideID": "A1", "voteCast": "Yea"}]}})
    got = feeds.house_vote_members(spark, m).collect()
    assert len(got) == 1 and got[0]["results"][0]["voteCast"] == "Yea"


VOTE = "<roll_call_vote><congress>117</congress><session>1</session><vote_number>1</vote_number><vote_date>January 3, 2021, 02:15 PM</vote_date><vote_result>Agreed</vote_result><document><document_type>S.Amdt.</document_type></document><members><member><lis_member_id>S1</lis_member_id><vote_cast>Yea</vote_cast></member><member><lis_member_id>S2</lis_member_id></member></members></roll_call_vote>"


def test_senate_xml(spark, tmp_path):
    p = put(tmp_path / "s", "1.xml", VOTE)
    put(tmp_path / "s", "2.xml", VOTE.replace("<vote_result>Agreed</vote_result>", "<result> </result>"))
    rows = feeds.senate_votes(spark, p).collect()
    assert sorted(r["valid"] for r in rows) == [False, True]
    assert len(next(r for r in rows if r["valid"])["members"]["member"]) == 2
    menu = put(tmp_path / "menu", "1.xml", "<vote_summary><votes><vote><vote_number>00012</vote_number><vote_date>x</vote_date><en_bloc>1</en_bloc></vote><vote><vote_date>x</vote_date></vote></votes></vote_summary>")
    assert [(r["vote_number"], r["question"]) for r in feeds.senate_vote_list(spark, menu).collect()] == [(12, "En Bloc")]
    look = put(tmp_path / "look", "1.xml", '<senators><senator><lisid>S428</lisid><bioguide>B1</bioguide><full_name><first_name>A</first_name><last_name>B</last_name></full_name><congresses><congress>118</congress><congress>x</congress></congresses><service_dates><service_date class="1"><end_date year="2020"/></service_date><service_date class="2"><end_date year=""/></service_date></service_dates></senator></senators>')
    r = feeds.senators(spark, look).first()
    assert (r["lis_id"], r["service_class"], r["congresses"], r["is_current"]) == ("S428", "2", [118], True)


def test_member_and_roster_xml(spark, tmp_path):
    p = put(tmp_path / "h", "1.xml", '<MemberData><members><member><member-info><bioguideID>A1</bioguideID><state><state-fullname>Ohio</state-fullname></state></member-info><committee-assignments><committee comcode="AG00" rank="3"/><subcommittee subcomcode="AG14"/></committee-assignments></member></members></MemberData>')
    assert sorted(r["code"] for r in feeds.house_members(spark, p).collect()) == ["AG00", "AG14"]
    i = put(tmp_path / "i", "1.xml", '<senators><senator lis_member_id="S1"><bioguide_id>B1</bioguide_id><committees><committee code="SSAG00">x</committee></committees></senator></senators>')
    r = feeds.senate_identities(spark, i).first()
    assert (r["bioguide"], r["lis_id"], r["codes"]) == ("B1", "S1", ["SSAG00"])
    s = put(tmp_path / "r", "1.xml", "<committee_membership><committees><committee_code>SSAG00</committee_code><members><member><name><first>A</first><last>B</last></name><position>Chairman</position></member></members><subcommittee><committee_code>SSAG13</committee_code><members><member><name><first>C</first><last>D</last></name></member></members></subcommittee></committees></committee_membership>")
    put(tmp_path / "r", "2.xml", "<html><body>Not found</body></html>")
    assert sorted((r["code"], r["is_subcommittee"]) for r in feeds.senate_rosters(spark, s).collect()) == [("SSAG00", False), ("SSAG13", True)]
    d = put(tmp_path / "d", "CDIR-2022-HOUSECOMMITTEES.htm", "<p>Budget</p>&nbsp;x")
    put(tmp_path / "d", "CDIR-2022-OTHER.htm", "y")
    assert [r["id"] for r in feeds.directory_listings(spark, d).collect()] == ["CDIR-2022-HOUSECOMMITTEES"]


def test_text_versions(spark, tmp_path):
    p = put(tmp_path / "t", "k1.json", {"textVersions": [{"type": "Public Law", "formats": [{"type": "PDF", "url": "u"}]}]})
    keys = spark.createDataFrame([("k1",), ("k2",)], "key string")
    got = {r["key"]: len(r["textVersions"]) for r in feeds.text_versions(spark, p, keys, "key", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)).collect()}
    assert got == {"k1": 1, "k2": 0}


def test_events_apart(spark):
    good, bad = feeds.events(spark.createDataFrame([('{"a": 1}',), ("nope",), (None,)], "payload string"), "payload", "a int")
    assert good.count() == 1 and bad.count() == 2


def test_catalog(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "c"))
    assert c.read("t") is None
    c.commit({"t": spark.range(2), "u": spark.range(1)})
    c.commit({"t": spark.range(5)})
    assert (c.read("t").count(), c.read("u").count(), c.read("t", 1).count(), c.version()) == (5, 1, 2, 2)


def test_stream_is_repeatable(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, at int, v string").write.parquet(src)
    c = Catalog(spark, str(tmp_path / "tables"))
    sink = incremental.upsert_sink(c, "t", MergeSpec(("k",)), "at")
    for run in range(2):  # a lost checkpoint: all comes again
        incremental.drain(spark, src, "k int, at int, v string", sink, str(tmp_path / f"cp{run}"))
    assert sorted(tuple(r) for r in c.read("t").collect()) == [(1, 2, "b"), (2, 1, "c")]
    late = str(tmp_path / "late")
    spark.createDataFrame([(1, 0, "late")], "k int, at int, v string").write.parquet(late)
    incremental.drain(spark, late, "k int, at int, v string", sink, str(tmp_path / "cp9"))
    assert c.read("t").where("k = 1").first()["v"] == "b"


def test_redelivered_rows_come_once_and_state_is_bounded(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    got = lambda: Counter(r["id"] for r in spark.read.parquet(f"{out}/*").collect())
    n = 0

    def put(rows):
        nonlocal n
        spark.createDataFrame(rows, "id string, at string").selectExpr("id", "timestamp(at) AS at").coalesce(1).write.mode("append").parquet(src)
        n += 1
        incremental.drain_once(spark, src, "id string, at timestamp", lambda b, k: b.write.mode("overwrite").parquet(f"{out}/{n}-{k}"), str(tmp_path / "cp"), "id", "at", "2 days")

    put([("a", day(1)), ("a", day(1)), ("b", day(1))])
    put([("a", day(2)), ("c", day(2))])
    assert got() == {"a": 1, "b": 1, "c": 1}
    put([("d", day(20))])
    put([("e", day(21)), ("d", day(21))])
    assert got() == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 1}
    # the keys of the first days are no longer held
    state = spark.read.format("statestore").load(str(tmp_path / "cp"))
    assert {r["key"][0] for r in state.collect()} <= {"d", "e"}


def test_events_are_sent_from_where_it_stopped(spark, tmp_path):
    c, sent = Catalog(spark, str(tmp_path)), []
    send = lambda rows: sent.append(sorted(r["id"] for r in rows.collect()))
    incremental.deliver(c, send)
    c.commit({}, {"events": spark.range(2)})
    c.commit({"t": spark.range(1)}, {"events": spark.range(2, 3)})
    incremental.deliver(c, send)
    incremental.deliver(c, send)

    def lost(rows):
        raise OSError

    c.commit({}, {"events": spark.range(3, 4)})
    with pytest.raises(OSError):
        incremental.deliver(c, lost)
    incremental.deliver(c, send)
    assert sent == [[0, 1, 2], [3]]


def test_documents_are_given_out_whole(spark, tmp_path):
    """A failure in the second batch removes what the first one held back; what comes twice or after the end is left out; what is never whole is forgotten."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    kind = "doc string, chunk_index int, expected int, failed string, at timestamp, vector array<float>"
    n = 0

    def put(*rows, day=1):
        nonlocal n
        spark.createDataFrame([(d, k, m, f, datetime(2024, 1, day), [float(k)]) for d, k, m, f in rows], kind).coalesce(1).write.mode("append").parquet(src)
        stream = incremental.until_complete(spark.readStream.schema(kind).parquet(src), "doc", horizon="2 days")
        n += 1
        stream.writeStream.foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{out}/{n}-{k}")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["doc"], r["chunk_index"], r["outcome"], r["failed"], r["vector"]) for r in spark.read.parquet(f"{out}/{n}-*").collect())

    assert put(("a", 1, 2, None), ("b", 0, 2, None), ("c", 0, 1, None), ("d", 0, 3, None)) == [("c", 0, "Complete", None, [0.0])]
    assert put(("a", 1, 2, None), ("a", 0, 2, None), ("b", 1, 2, "timeout: slow"), ("c", 0, 1, None)) == [("a", 0, "Complete", None, [0.0]), ("a", 1, "Complete", None, [1.0]), ("b", None, "Failed", "timeout: slow", None)]
    assert put(("b", 0, 2, None), ("b", 1, 2, None), ("a", 0, 2, None)) == []
    put(("e", 0, 1, None), day=20)
    put(("f", 0, 1, None), day=21)
    held = {r["key"][0] for r in spark.read.format("statestore").load(str(tmp_path / "cp")).collect()}
    assert held <= {"e", "f"}
