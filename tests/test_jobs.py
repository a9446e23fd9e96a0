import os
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from docketry.operators import merge, texts
from docketry.plans import ingest as job
from docketry.plans import reference as ref
from docketry.sources import chunks
from docketry.sources.snapshots import Catalog, Conflict, address

VOTE = "vote_key string, update_date date, result string"
POSITION = "vote_key string, chamber string, member_key string, position string"


def run(c, spark, votes, positions, name):
    v = spark.createDataFrame(votes, VOTE)
    p = spark.createDataFrame(positions, POSITION)
    return {r["change"]: r["n"] for r in job.ingest(c, job.VOTES, v, {"vote_positions": p}, name, event="vote.recorded").collect()}


def test_votes_from_first_run_to_update(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    d1, d2 = date(2025, 1, 1), date(2025, 2, 1)
    votes = [("v1", d1, "Passed"), ("v2", d1, "Failed"), ("v3", d1, "Passed")]
    pos = [(v, "House", m, "Yea") for v in ("v1", "v2", "v3") for m in ("a", "b")]
    assert run(c, spark, votes, pos, "r1") == {"New": 3}
    assert c.read("events").count() == 3
    assert run(c, spark, votes, pos, "r1") == {"Unchanged": 3}
    assert (c.read("votes").count(), c.read("vote_positions").count(), c.read("events").count(), c.read("votes_history").count()) == (3, 6, 3, 0)
    # v1: positions change; v2: metadata alone; v3: an older date changes nothing
    votes = [("v1", d2, "Passed"), ("v2", d2, "Agreed"), ("v3", date(2024, 1, 1), "Lost")]
    pos = [("v1", "House", "a", "Nay"), ("v2", "House", "a", "Yea"), ("v2", "House", "b", "Yea"), ("v3", "House", "a", "Nay")]
    assert run(c, spark, votes, pos, "r2") == {"Updated": 2, "Unchanged": 1}
    assert {(r["vote_key"], r["result"]) for r in c.read("votes").collect()} == {("v1", "Passed"), ("v2", "Agreed"), ("v3", "Passed")}
    assert sorted((r["vote_key"], r["member_key"], r["position"]) for r in c.read("vote_positions").collect()) == [("v1", "a", "Nay"), ("v2", "a", "Yea"), ("v2", "b", "Yea"), ("v3", "a", "Yea"), ("v3", "b", "Yea")]
    assert c.read("votes_history").count() == 2 and c.read("vote_positions_history").count() == 4
    assert c.read("events").count() == 4


def test_votes_link_to_single_amendments(spark):
    votes = spark.createDataFrame([("h1", 117, "House", 5, None, "BILL", None, "1", "HR", "b"), ("s1", 117, "Senate", 9, None, "BILL", None, "2", "S", "b"), ("s2", 117, "Senate", 8, None, None, None, None, None, None)], "vote_key string, congress int, chamber string, roll_number int, amendment_key string, legislation_type string, amendment_type string, legislation_number string, bill_type string, bill_key string")
    acts = spark.createDataFrame([("a1", 117, "hamdt", "11", "On agreeing (Roll no. 5)."), ("a2", 117, "samdt", "12", "Agreed. Record Vote Number: 9."), ("a3", 117, "suamdt", "13", "Record Vote No. 9"), ("a4", 117, "samdt", "14", "nothing")], "amendment_key string, congress int, amendment_type string, number string, latest_action_text string")
    once = job.link_votes(votes, acts)
    got = {r["vote_key"]: (r["amendment_key"], r["bill_key"], r["legislation_type"]) for r in once.collect()}
    assert got == {"h1": ("a1", None, "AMENDMENT"), "s1": (None, "b", "BILL"), "s2": (None, None, None)}
    assert sorted(map(str, job.link_votes(once, acts).collect())) == sorted(map(str, once.collect()))


KIND = "version_key string, document_key string, version_date string, format string, content string"


def test_texts_are_stored_once(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    first = job.store_texts(c, spark.createDataFrame([("k1", "d1", "2025", "Formatted Text", "<body><p>one two</p> three</body>"), ("k2", "d2", "2025", "PDF", None)], KIND), "r1", chunk_size=6)
    assert {tuple(r) for r in first.collect()} == {("k1", "Stored", None), ("k2", "Failed", "no text")}
    assert [r["content"] for r in chunks.live(c).orderBy("chunk_index").collect()] == ["one tw", "o thre", "e"]
    assert {(r["version_key"], r["fetched_in"]) for r in c.read("text_versions").collect()} == {("k1", "r1"), ("k2", None)}
    again = job.store_texts(c, spark.createDataFrame([("k1", "d1", "2025", "Formatted Text", "<body>changed</body>")], KIND), "r2", chunk_size=6)
    assert [tuple(r) for r in again.collect()] == [("k1", "Skipped", "already-processed")]
    assert chunks.live(c).count() == 3 and c.read("events").select("event_id").distinct().count() == 2  # stored, and announced again


def test_newest_text_wins_and_old_chunks_die(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    def put(run, rows, **kw):
        df = spark.createDataFrame([(*r[:3], "Text", r[3]) for r in rows], KIND)
        return {r["version_key"]: r["outcome"] for r in job.store_texts(c, df, run, chunk_size=4, newest_wins=True, **kw).collect()}

    assert put("r1", [("k1", "d1", "2025-01-01", "aaaabbbbcc"), ("k2", "d1", "2025-03-01", "dddd"), ("k3", "d2", "2025-01-01", "eeee")]) == {"k1": "Stored", "k2": "Stored", "k3": "Stored"}
    files = c.state(chunks.CHUNKS)["added"]
    # an older date changes nothing; a later one replaces the chunks, and those past the new end go
    assert put("r2", [("k1", "d1", "2025-02-01", "ffff"), ("k2", "d1", "2025-02-01", "gggg")]) == {"k1": "Stored", "k2": "Skipped"}
    assert {(r["version_key"], r["chunk_index"], r["content"]) for r in chunks.live(c).collect()} == {("k1", 0, "ffff"), ("k2", 0, "dddd"), ("k3", 0, "eeee")}
    assert {r["document_key"]: r["version_key"] for r in c.read("text_latest").collect()} == {"d1": "k2", "d2": "k3"}
    after = c.state(chunks.CHUNKS)["added"]
    assert after[: len(files)] == files and c.read(chunks.CHUNKS).count() == 6  # appended; nothing is rewritten
    assert c.read(chunks.DEAD).agg(F.sum("n")).first()[0] == 3
    # a third set kills the second; then dead rows are dropped, and numbers stay
    assert put("r3", [("k1", "d1", "2025-04-01", "hhhhiiii")])["k1"] == "Stored"
    want = {("k1", 0, "hhhh"), ("k1", 1, "iiii"), ("k2", 0, "dddd"), ("k3", 0, "eeee")}
    for _ in range(2):
        assert {(r["version_key"], r["chunk_index"], r["content"]) for r in chunks.live(c).collect()} == want
        chunks.compact(c)
    assert c.read(chunks.CHUNKS).count() == 4 and not chunks.compact(c)
    assert put("r4", [("k3", "d2", "2026-01-01", "jjjj")])["k3"] == "Stored"
    assert {r["document_key"]: r["version_key"] for r in c.read("text_latest").collect()} == {"d1": "k1", "d2": "k3"} and chunks.live(c).count() == 4
    # a model that fails leaves the version open and its old chunks alive
    assert put("r5", [("k3", "d2", "2027-01-01", "kkkk")], model=lambda some: 1 / 0, dims=1)["k3"] == "Failed"
    assert c.read("text_versions").where("version_key = 'k3'").first()["fetched_in"] is None and chunks.live(c).where("content = 'jjjj'").count() == 1
    assert put("r6", [("k3", "d2", "2027-01-01", "kkkk")], model=lambda some: [[1.0]] * len(some), dims=1)["k3"] == "Stored"
    assert chunks.live(c).where("version_key = 'k3'").select("content", "embedding").first() == ("kkkk", [1.0])


def test_vectors_of_dead_rows(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    rows = spark.range(1, 100_001).selectExpr("'b1' AS batch", "id AS row")
    gone = [1, 2, 8, 9, 32767, 32768, 32769, 65536, 99_999, 100_000]
    dead = [chunks.dead_rows(spark.createDataFrame([("b1", g) for g in some], "batch string, row long")) for some in (gone[:5], gone[5:], gone[2:4])]
    c.commit({}, {chunks.CHUNKS: rows.unionByName(spark.createDataFrame([("b2", 1)], "batch string, row long")), chunks.DEAD: dead[0]})
    c.commit({}, {chunks.DEAD: dead[1]})
    c.commit({}, {chunks.DEAD: dead[2]})
    left = chunks.live(c)
    assert left.count() == 100_001 - len(gone) and left.where(F.col("row").isin(gone) & (F.col("batch") == "b1")).isEmpty()


def test_model_is_called_with_full_batches(spark, tmp_path):
    """However rows are dealt, ceil(texts / n) calls; each call leaves a file that names its size."""
    rows = spark.createDataFrame([(k, None if k % 10 == 3 else " " if k % 10 == 4 else f"text {k}") for k in range(103)], "id long, content string").repartition(7)
    folder = str(tmp_path)

    def model(some):
        with open(f"{folder}/{uuid.uuid4().hex}-{len(some)}", "w"):
            return [[float(len(t))] for t in some]

    got = {r["id"]: r["embedding"] for r in texts.embed_in_full_batches(rows, "content", model, 1, batch=10).collect()}
    assert got == {k: None if k % 10 in (3, 4) else [float(len(f"text {k}"))] for k in range(103)}
    sizes = sorted(int(n.split("-")[1]) for n in os.listdir(folder))
    n = sum(k % 10 not in (3, 4) for k in range(103))
    assert sizes == sorted([10] * (n // 10) + [n % 10])


def test_only_stored_votes_are_archived(spark):
    votes = spark.createDataFrame([("v1", "Passed")], "vote_key string, result string")
    changed = spark.createDataFrame([("v1",), ("v9",)], "vote_key string")
    assert merge.archive(votes, changed, ["vote_key"])[""].count() == 1
    with pytest.raises(merge.NothingToArchive, match="v9"):
        merge.archive(votes, changed, ["vote_key"], strict=True)


def test_a_version_is_made_once_and_parts_are_kept(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    rows = spark.range(200).selectExpr("id", "'a' AS v")
    merged = lambda s, n: n if s is None else merge.merge(s, n, merge.MergeSpec(("id",)))
    c.commit({"t": rows})
    c.commit({}, upserts={"t": (spark.createDataFrame([(3, "b"), (500, "b")], "id long, v string"), ["id"], merged)})
    before = c.state("t")["files"]
    c.commit({}, {"log": rows.limit(2)}, {"t": (spark.createDataFrame([(3, "c")], "id long, v string"), ["id"], merged)})
    c.commit({}, {"log": rows.limit(3)})
    after = c.state("t")["files"]
    assert sum(before[k] != after[k] for k in after) == 1 and c.read("log").count() == 5 and c.version() == 4
    assert c.read("t").count() == 201 and {r["v"] for r in c.read("t").where("id in (3, 500)").collect()} == {"b", "c"} and c.read("t", 1).where("v <> 'a'").isEmpty()
    assert not c.log.files.create(f"{tmp_path}/log/0000000000/000000000004.json", "x")


def _counted(s, n):
    both = n if s is None else s.unionByName(n)
    return both.groupBy("id").agg(F.sum("n").alias("n"))


@pytest.mark.parametrize("part_rows", [1000, 4])
def test_concurrent_writers(spark, tmp_path, part_rows):
    """Eight writers at once: every version is made once, and no row is lost, in parts that they share and in those that split under them."""
    c = Catalog(spark, str(tmp_path), part_rows, snapshot_every=3)

    def write(w):
        rows = spark.createDataFrame([(k % 6, 1) for k in range(w, w + 3)], "id long, n long")
        return [c.commit({}, {"log": spark.createDataFrame([(w,)], "w long")}, {"t": (rows.groupBy("id").agg(F.sum("n").alias("n")), ["id"], _counted)}) for _ in range(2)]

    with ThreadPoolExecutor(8) as pool:
        versions = sorted(v for vs in pool.map(write, range(8)) for v in vs)
    assert versions == list(range(1, 17)) and c.version() == 16
    assert Counter(r["w"] for r in c.read("log").collect()) == {w: 2 for w in range(8)}
    want = Counter(k % 6 for w in range(8) for k in range(w, w + 3) for _ in range(2))
    assert {r["id"]: r["n"] for r in c.read("t").collect()} == want
    assert c.compact("log") == 17 and c.read("log").count() == 16 and len(c.state("log")["added"]) == 1


def test_only_rows_that_changed_conflict(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    merged = lambda s, n: n if s is None else merge.merge(s, n, merge.MergeSpec(("id",)))
    one = lambda k, v: {"t": (spark.createDataFrame([(k, v)], "id long, v string"), ["id"], merged)}
    c.commit({}, upserts={"t": (spark.createDataFrame([(1, "a"), (2, "a")], "id long, v string"), ["id"], merged)})
    c.commit({}, upserts=one(1, "b"))
    c.commit({}, upserts=one(2, "b"), base=1, judged=("t",))  # another row of the same part
    assert {(r["id"], r["v"]) for r in c.read("t").collect()} == {(1, "b"), (2, "b")}
    with pytest.raises(Conflict):
        c.commit({}, upserts=one(1, "c"), base=1, judged=("t",))
    with pytest.raises(Conflict):
        c.commit({"t": spark.range(1)}, base=2)
    tries = []

    def job_of(spark=spark):
        tries.append(c.version())
        if len(tries) == 1:
            c.commit({}, upserts=one(1, "d"))
        return c.commit({}, upserts=one(1, "e"), base=tries[-1], judged=("t",))

    assert job.again(job_of) == tries[1] + 1 and len(tries) == 2 and c.read("t").where("id = 1").first()["v"] == "e"


def test_parts_grow_and_batches_stay_cheap(spark, tmp_path):
    """With ten parts or a hundred, a batch writes the parts of its rows and those that the table grows by."""
    c = Catalog(spark, str(tmp_path), part_rows=50, snapshot_every=4)
    merged = lambda s, n: n if s is None else merge.merge(s, n, merge.MergeSpec(("id",)))
    sizes = []
    for first, last in ((0, 500), (500, 505), (505, 5000), (5000, 5003), (7, 8), (0, 5003)):
        before = c.state("t")
        c.commit({}, upserts={"t": (spark.range(first, last).selectExpr("id", f"'{last}' AS v"), ["id"], merged)})
        after = c.state("t")
        wrote = [k for k, f in after["files"].items() if before["files"].get(k) != f]
        sizes.append((after["parts"], len(wrote)))
        assert sum(n for _, n in after["files"].values()) == c.read("t").count()
    assert [p for p, _ in sizes[:5]] == [10, 11, 100, 101, 101] and sizes[1][1] <= 5 + 2 and sizes[3][1] <= 3 + 2 and sizes[4][1] == 1
    assert c.read("t").count() == 5003 and c.read("t").select("id").distinct().count() == 5003 and c.read("t").where("v <> '5003'").isEmpty()
    parts = c.state("t")["parts"]
    for k, (path, _) in list(c.state("t")["files"].items())[::40]:
        assert {r["p"] for r in spark.read.parquet(path).select(address(["id"], parts).alias("p")).collect()} == {int(k)}
    # readers of any version need one snapshot and fewer than four entries
    assert [c.read("t", v).count() for v in range(1, 7)] == [500, 505, 5000, 5003, 5003, 5003]
    assert c.read("none") is None and c.added_since("t", 0) is None


def test_reference_jobs_count_and_repeat(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    register = spark.createDataFrame([("L1", "b1", "Ann", "Lee", "D", "OH", [118], False), ("L2", "b2", "Bob", "Poe", "", "IA", [], True), ("L3", "b3", "Cy", "Fox", "R", "UT", [100], None), ("L4", "b4", "Di", "Zee", "R", "UT", [117], False)], "lis_id string, bioguide string, first_name string, last_name string, party string, state string, congresses array<int>, is_current boolean")
    members = spark.createDataFrame([("b1", 1), ("b2", 2), ("b3", 3)], "bioguide string, member_id long")
    run = lambda r, m: ref.refresh_mappings(c, register, m, 118, 2, r, "2024-01-01").first().asDict()
    assert run("r1", members.where("member_id = 1")) == {"parsed": 3, "inserted": 1, "updated": 0, "unknown": 2}
    assert run("r2", members) == {"parsed": 3, "inserted": 1, "updated": 1, "unknown": 1} and c.read("events").count() == 2
    assert c.read("lis_members").where("lis_id = 'L2'").first()["party"] is None and c.read("lis_members").count() == 3

    seats = spark.createDataFrame([(117, "Budget", "Ann", "Lee", "Ohio", "Chairman"), (117, "Budget", "A.", "Roe", "Ohio", None), (117, "Budget", "Zed", "Roe", "Ohio", None), (118, "Budget", "Ann", "Lee", "Ohio", None), (117, "Nowhere", "Ann", "Lee", "Ohio", None)], "congress int, committee string, first_name string, last_name string, state string, role string")
    served = spark.createDataFrame([(1, 117, "Ann", "Lee", "Ohio", 1), (2, 117, "Abe", "Roe", "ohio", 2), (3, 117, "Al", "Roe", "ohio", 3)], "member_id long, congress int, first_name string, last_name string, state string, position int")
    for _ in range(2):
        assert ref.load_history(c, seats, served, spark.createDataFrame([("HSBU", "Committee on the Budget"), ("X", "the budget"), ("Y", "Budget")], "code string, name string")).first().asDict() == {"seen": 5, "upserted": 2, "no_committee": 1, "no_member": 2}
    assert {tuple(r)[:4] for r in c.read("committee_members").collect()} == {("Y", 1, 117, "Chairman"), ("Y", 2, 117, None)}

    stages = spark.createDataFrame([("IH", 10), ("ENR", 40)], "code string, order int")
    said = lambda *rows: spark.createDataFrame(list(rows), "bill_key string, version_code string, action_date string, action_desc string, text string")
    assert ref.store_summaries(c, said(("b", "IH", "1", "d", "<p>one</p>"), ("b", "ENR", "2", "d", " "), (None, "IH", "1", "d", "x"), ("c", "??", "1", "d", "x")), stages).first().asDict() == {"bills": 1, "advanced": 1, "at_stage": 0, "written": 0}
    assert ref.store_summaries(c, said(("b", "IH", "3", "d", "late")), stages).first().asDict() == {"bills": 1, "advanced": 0, "at_stage": 1, "written": 1}
    assert c.read("bills_stages").first()["code"] == "ENR" and c.read("bills").count() == 1


def test_committees_and_their_members(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    committees = spark.createDataFrame([("BU", "Budget", "House", None), ("BU1", "Taxes", "House", "BU")], "code string, name string, chamber string, parent_code string")
    house = spark.createDataFrame([("b1", "BU", 1, "majority"), ("b9", "BU", 2, "majority"), ("b1", "NEW", 3, "minority")], "bioguide string, code string, rank int, side string")
    people = spark.createDataFrame([("b2", "Ann", "Lee", "OH"), ("b3", "ann", "LEE", "oh")], "bioguide string, first_name string, last_name string, state string")
    rosters = spark.createDataFrame([("SSBU", "Ann", "Lee", "OH", "Chairman"), ("SSBU", "No", "Body", "OH", "Member")], "code string, first_name string, last_name string, state string, position string")
    members = spark.createDataFrame([("b1", 1), ("b2", 2), ("b3", 3)], "bioguide string, member_id long")
    for k in range(2):
        got = ref.refresh_committees(c, committees if k == 0 else committees.withColumn("parent_code", F.lit(None).cast("string")), house, people, rosters, members, 118, "2024-01-01").first().asDict()
        assert got == {"seats": 3, "unknown": 2, "committees": 2, "placeholders": 2 - 2 * k}
    assert {(r["code"], r["name"], r["parent_code"], r["chamber"]) for r in c.read("committees").collect()} == {("BU", "Budget", None, "House"), ("BU1", "Taxes", "BU", "House"), ("NEW", "NEW", None, "House"), ("SSBU", "SSBU", None, "Senate")}
    assert {tuple(r) for r in c.read("committee_members").collect()} == {("BU", 1, 118, None, "majority", 1), ("NEW", 1, 118, None, "minority", 3), ("SSBU", 3, 118, "Chairman", None, None)}
