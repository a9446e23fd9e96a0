"""Rows that joins make of keys that many rows share, and queries on tables with odd values."""

import os
import random
import weakref
from datetime import datetime

import duckdb
from pyspark.sql import functions as F

from docketry.functions import markup
from docketry.operators import merge, resolve, texts
from docketry.plans import ingest as job
from docketry.queries import registry
from docketry.sources import chunks
from docketry.sources.snapshots import Catalog
from docketry.streaming import incremental


def nodes(plan):
    """The nodes of a plan that has run."""
    yield plan
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        kids = [plan.executedPlan()]
    elif "QueryStage" in name:
        kids = [plan.plan()]
    else:
        kids = [plan.children().apply(i) for i in range(plan.children().size())]
    for k in kids:
        yield from nodes(k)


def rows_of_joins(df):
    """(rows of df, the most rows that one of its joins made)."""
    rows = df.collect()
    made = [n.metrics().apply("numOutputRows").value() for n in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName()]
    return rows, max(made)


def test_unique_links_make_no_pairs_of_a_shared_key(spark):
    left = spark.range(2_000).select(F.col("id").alias("a"), F.when(F.col("id") > 0, "hot").otherwise("one").alias("k"))
    right = spark.range(3_000).select(F.col("id").alias("r"), F.when(F.col("id") % 1000 > 0, "hot").otherwise("one").alias("k"))
    more = spark.createDataFrame([(0, "one"), (1, "one"), (1, "hot"), (4_000, "none"), (5_000, None)], "r long, k string")
    links, made = rows_of_joins(resolve.link_unique(left, right.unionByName(more), ["k"], "r"))
    assert sorted(tuple(r) for r in links) == [("one", 0, 1000), ("one", 0, 2000)]  # row 0 comes twice, row 1 has a shared key too
    assert made <= 3_005


def test_references_without_a_semicolon(spark, tmp_path):
    pages = [(1, "<body><p>a&amp b &amp;&am c</p>&quot</body>"), (2, "x&ampy &notit; &#167 &#167; &nope;"), (3, None)]
    spark.createDataFrame(pages[:1], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {tuple(r) for r in registry.QUERIES["html_to_text"](spark, str(tmp_path)).select("page_id", "text").collect()}
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert got == set(con.execute(registry.ORACLES["html_to_text"]).fetchall()) == {(1, "a&amp b &&am c &quot")}
    assert [markup.html_text(h, bare=False) for _, h in pages[1:]] == ["x&ampy &notit; &#167 § &nope;", None]
    assert markup.html_text(pages[0][1]) == 'a& b &&am c "'


def test_documents_come_whole_from_a_sink(spark, tmp_path):
    """As from until_complete: a failure drops what is held back, what comes twice or after the end is left out, what is never whole is forgotten, and a batch that comes again changes nothing."""
    kind = "doc string, chunk_index int, expected int, failed string, at timestamp, vector array<float>"
    c = Catalog(spark, str(tmp_path))
    sink = incremental.complete_sink(c, "done", "doc", horizon="2 days")
    seen = 0

    def put(number, *rows, day=1):
        nonlocal seen
        sink(spark.createDataFrame([(d, k, m, f, datetime(2024, 1, day), [float(k)]) for d, k, m, f in rows], kind), number)
        new = c.added_since("done", seen)
        seen = c.version()
        return sorted((r["doc"], r["chunk_index"], r["outcome"], r["failed"], r["vector"]) for r in new.collect()) if new is not None else None

    assert put(0, ("a", 1, 2, None), ("b", 0, 2, None), ("c", 0, 1, None), ("d", 0, 3, None), ("d", 0, 3, None), (None, 0, 1, None)) == [("c", 0, "Complete", None, [0.0])]
    second = [("a", 1, 2, None), ("a", 0, 2, None), ("b", 1, 2, "timeout: slow"), ("c", 0, 1, None)]
    assert put(1, *second) == [("a", 0, "Complete", None, [0.0]), ("a", 1, "Complete", None, [1.0]), ("b", None, "Failed", "timeout: slow", None)]
    assert put(1, *second) is None
    assert put(2, ("b", 0, 2, None), ("b", 1, 2, None), ("a", 0, 2, None)) == []
    assert {(r["doc"], r["chunk_index"]) for r in c.read("done_held").collect()} == {("a", None), ("b", None), ("c", None), ("d", 0)}
    put(3, ("e", 0, 1, None), day=20)
    assert put(4, ("f", 0, 2, None), ("a", 0, 1, None), day=21)[0][:3] == ("a", 0, "Complete")
    assert put(5, ("g", 0, 1, None), day=1) == []
    assert {r["doc"] for r in c.read("done_held").collect()} == {"a", "e", "f"}


def test_fuzzy_names_make_no_pairs_of_a_shared_name(spark):
    people = spark.range(2_000).selectExpr("id", "'Lee' AS last", "'OH' AS state", "CASE WHEN id % 3 = 0 THEN 'Ann' WHEN id % 3 = 1 THEN 'Bo' END AS first", "2000 - id AS pos")
    people = people.unionByName(spark.createDataFrame([(5_000, "Roe", "TX", "Zoe", 1)], "id long, last string, state string, first string, pos long"))
    given = [(1, " lee", "oh ", "ANN"), (2, "Lee", "OH", "Abe"), (3, "Lee", "OH", None), (4, "Lee", "OH", "Cy"), (5, "roe", "tx", "other"), (6, None, "OH", "Ann")]
    few = spark.createDataFrame(given, "r long, last string, state string, first string")
    many = spark.range(100, 3_100).selectExpr("id AS r", "'Lee' AS last", "'OH' AS state", "'b' AS first")
    found, made = rows_of_joins(resolve.resolve_fuzzy(few.unionByName(many), people, "last", "first", "state", "id", "pos", "r").select("r", "id"))
    ids = {r["r"]: r["id"] for r in found}
    assert {k: ids[k] for k in range(1, 7)} == {1: 1998, 2: 1998, 3: 1997, 4: None, 5: 5_000, 6: None}
    assert {v for k, v in ids.items() if k >= 100} == {1999} and made <= 3_006


def test_archive_builds_no_tables_of_keys(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    rows = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (3, 30), (None, 40)], "k long, x int")
    old = merge.archive(parents, spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long"), ["k"], {"rows": rows}, "r")
    got = old["rows"].select("k", "x")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 10), (2, 20), (2, 21)]
    assert not [n.nodeName() for n in nodes(got._jdf.queryExecution().executedPlan()) if "Aggregate" in n.nodeName()]
    assert old[""].count() == 3 and old[""].select("history_id").distinct().count() == 2


def test_texts_are_not_put_in_order_to_be_numbered(spark):
    rows = spark.range(50).selectExpr("id", "CASE WHEN id % 5 > 0 THEN concat('t', id) ELSE ' ' END AS content").repartition(3)
    got = texts.embed_in_full_batches(rows, "content", lambda some: [[float(len(some))] for _ in some], 1, batch=15)
    assert "row_number" not in got._jdf.queryExecution().optimizedPlan().toString()
    sizes = sorted(r["embedding"][0] for r in got.where("embedding IS NOT NULL").collect())
    assert sizes == [10.0] * 10 + [15.0] * 30 and got.count() == 50


def test_children_of_a_feed_are_worked_out_once(spark, tmp_path):
    """However many steps of a run read them; and not at all where no parent changed."""
    c, seen = Catalog(spark, str(tmp_path)), spark.sparkContext.accumulator(0)

    def positions(rows):
        def work(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        df = spark.createDataFrame(rows, "vote_key long, chamber string, member_key string, position string").coalesce(1)
        return df.mapInArrow(work, df.schema)

    def run(votes, rows, name):
        before = seen.value
        counts = job.ingest(c, job.VOTES, spark.createDataFrame(votes, "vote_key long, update_date string, result string"), {"vote_positions": positions(rows)}, name, event="vote.recorded")
        return dict(map(tuple, counts.collect())), seen.value - before

    first = [(1, "House", "a", "Yea"), (1, "House", "b", None), (2, "House", "a", "Yea"), (3, "House", "a", "Yea"), (9, "House", "a", "Yea")]
    assert run([(1, "2024", "Passed"), (2, "2024", "Passed"), (3, "2024", "Passed")], first, "r1") == ({"New": 3}, 5)
    second = [(1, "House", "a", "Yea"), (1, "House", "b", None), (3, "House", "a", "Nay"), (4, "House", "a", "Yea")]  # 1: the same; 2: none left; 3: changed; 5: has none
    votes = [(k, "2025", "Failed") for k in range(1, 6)]
    assert run(votes, second, "r2") == ({"Updated": 3, "New": 2}, 4)
    assert run(votes, second, "r2") == ({"Unchanged": 5}, 0)
    assert sorted((r["vote_key"], r["member_key"], r["position"]) for r in c.read("vote_positions").collect()) == [(1, "a", "Yea"), (1, "b", None), (3, "a", "Nay"), (4, "a", "Yea")]
    assert sorted(r["member_key"] for r in c.read("vote_positions_history").collect()) == ["a", "a", "a", "b"]
    assert c.read("votes_history").count() == 3 and c.read("events").count() == 3 + 4


def test_parsed_documents_are_given_back_in_pieces(spark):
    """No batch is held with the texts of all its documents, however long they are."""
    made = []

    def parse(raw):
        made[:] = [m for m in made if m() is not None]
        if len(made) > 10:
            raise ValueError("too many texts are held")
        if raw == b"5":
            raise TimeoutError("slow")
        text = type("Text", (str,), {})(raw.decode() * 200_000)
        made.append(weakref.ref(text))
        return text

    rows = spark.range(0, 60, 1, 1).selectExpr("id", "CASE WHEN id % 10 <> 9 THEN encode(cast(id % 10 AS string), 'UTF-8') END AS raw")
    got = texts.extract_with(rows, "raw", parse).selectExpr("id", "cast(raw AS string) AS raw", "length(text) AS n", "left(text, 1) AS text", "text_error").collect()
    want = {9: (None, None, None, None), 5: ("5", None, None, "timeout: TimeoutError slow")}
    assert [tuple(r) for r in sorted(got)] == [(k, *want.get(k % 10, (str(k % 10), 200_000, str(k % 10), None))) for k in range(60)]
    assert texts.extract_with(rows.limit(0), "raw", parse).collect() == []


TEXTS = "version_key string, document_key string, version_date string, format string, content string"


def test_contents_of_texts_are_written_once(spark, tmp_path):
    """As the files of the chunks; of a batch that failed they are not written at all."""
    shared, c = spark.sparkContext.getConf().get("spark.checkpoint.dir"), Catalog(spark, str(tmp_path))
    draw = random.Random(1)
    rows = spark.createDataFrame([(f"k{k}", "d", "2024", "Text", draw.randbytes(10_000).hex()) for k in range(40)], TEXTS)
    stored = lambda: sum(os.path.getsize(os.path.join(d, n)) for top in (shared, str(tmp_path)) for d, _, names in os.walk(top) for n in names if n.endswith(".parquet"))
    before = stored()
    assert {r["outcome"] for r in job.store_texts(c, rows, "r1", chunk_size=700, model=lambda some: 1 / 0, dims=1).collect()} == {"Failed"}
    failed = stored()
    assert {r["outcome"] for r in job.store_texts(c, rows, "r2", chunk_size=700, model=lambda some: [[1.0]] * len(some), dims=1).collect()} == {"Stored"}
    assert failed - before < 400_000 and stored() - failed < 1_300_000
    assert chunks.live(c).agg(F.sum(F.length("content"))).first()[0] == 800_000


def test_a_batch_that_fails_takes_whole_versions_along(spark, tmp_path):
    """And no others: what was made of them is dead, and the next run stores them whole."""
    c = Catalog(spark, str(tmp_path))
    rows = spark.createDataFrame([(k, "d", "2024", "Text", "".join(f"{k}{i:03d}" for i in range(90 if k < "x" else 3))) for k in "abcdefx"] + [("y", "d", "2024", "Text", " "), ("z", "d", "2024", "PDF", "p")], TEXTS)

    def model(some):
        if "c045" in some:
            raise TimeoutError("slow")
        return [[float(t[1:])] for t in some]

    first = {r["version_key"]: (r["outcome"], r["reason"]) for r in job.store_texts(c, rows, "r1", chunk_size=4, model=model, dims=1).collect()}
    lost = {k for k, v in first.items() if v == ("Failed", "timeout: TimeoutError slow")}
    assert "c" in lost and len(lost) <= 3 and first["y"] == ("Stored", None) and first["z"] == ("Failed", "no text") and {v[0] for k, v in first.items() if k not in {*lost, "z"}} == {"Stored"}
    live = lambda: {(r["version_key"], r["chunk_index"], r["content"], r["embedding"][0]) for r in chunks.live(c).collect()}
    whole = {(k, i, f"{k}{i:03d}", float(i)) for k in "abcdefx" for i in range(90 if k < "x" else 3)}
    assert live() == {r for r in whole if r[0] not in lost}
    assert {r["version_key"]: r["text_length"] for r in c.read("text_versions").where("fetched_in = 'r1'").collect()} == {k: 360 if k < "x" else 12 if k == "x" else 1 for k in {*"abcdefxy"} - lost}
    second = {r["version_key"]: r["outcome"] for r in job.store_texts(c, rows, "r2", chunk_size=4, model=lambda some: [[float(t[1:])] for t in some], dims=1).collect()}
    assert second == {k: "Stored" if k in lost else "Failed" if k == "z" else "Skipped" for k in "abcdefxyz"}
    assert live() == whole and chunks.live(c).count() == len(whole)


def test_blank_texts_need_no_model(spark, tmp_path):
    """They are complete at once, and a run whose model fails is no error for them."""
    docs = [(1, "one"), (2, ""), (3, " \n\t "), (4, None), (5, "a " * 800)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in registry.QUERIES["failed_vectors_stay_open"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == set(con.execute(registry.ORACLES["failed_vectors_stay_open"]).fetchall()) and len(got) == 5
