import re
from datetime import date
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketry.functions import dates, keys, markup, text, urls
from docketry.operators import change, merge, rank, resolve, texts
from docketry.operators.merge import MergeSpec


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_merge_is_idempotent(spark):
    s = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, keep int")
    i = spark.createDataFrame([(2, "c"), (3, None)], "k int, v string")
    once = merge.merge(s, i, MergeSpec(("k",)))
    assert rows(once) == [(1, "a", 5), (2, "c", 6), (3, None, None)]
    assert rows(merge.merge(once, i, MergeSpec(("k",)))) == rows(once)


def test_merge_empty_sides(spark):
    s = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(merge.merge(s, s.limit(0), MergeSpec(("k",)))) == [(1, "a")]
    assert rows(merge.merge(s.limit(0), s, MergeSpec(("k",)))) == [(1, "a")]


def test_guard_and_null_key(spark):
    s = spark.createDataFrame([(1, date(2024, 1, 2), "x")], "k int, d date, u string")
    i = spark.createDataFrame([(1, date(2024, 1, 1), "old")], "k int, d date, u string")
    spec = MergeSpec(("k",), guard=lambda a, b: b("d") > a("d"))
    assert rows(merge.merge(s, i, spec, status="st")) == [(1, date(2024, 1, 2), "x", "Kept")]
    n = spark.createDataFrame([(1, None, "n")], "k int, d date, u string")
    twice = merge.merge(merge.merge(s, n, MergeSpec(("k", "d"))), n, MergeSpec(("k", "d")))
    assert twice.count() == 3


def test_replace_and_trim(spark):
    s = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "p int, i int")
    assert rows(merge.replace_children(s, spark.createDataFrame([(1, 7)], "p int, i int"), ["p"])) == [(1, 7), (2, 0)]
    touched = spark.createDataFrame([(1,)], "p int")
    assert rows(merge.replace_children(s, s.limit(0), ["p"], touched)) == [(2, 0)]
    assert rows(merge.trim_tail(s, spark.createDataFrame([(1, 1)], "p int, n int"), "p", "i", "n")) == [(1, 0), (2, 0)]


def test_advance_keeps_equal_stage(spark):
    s = spark.createDataFrame([(1, "IH", 10), (2, "RH", 30)], "b int, code string, o int")
    p = spark.createDataFrame([(1, "IS", 10), (2, "EAH", 60), (3, "IH", 10), (2, "IH", 10)], "b int, code string, o int")
    assert rows(merge.advance(s, p, "b", "code", "o")) == [(1, "IH", 10), (2, "EAH", 60), (3, "IH", 10)]


@pytest.mark.parametrize("policy, expected", [("vote", "NUUN"), ("bill", "NUDN")])
def test_null_date_policies(spark, policy, expected):
    inc = spark.createDataFrame([(0, date(2024, 1, 1)), (1, None), (2, date(2024, 1, 1)), (3, date(2024, 1, 1))], "k int, d date")
    sto = spark.createDataFrame([(1, date(2023, 1, 1)), (2, None), (3, date(2023, 1, 1))], "k int, d date")
    got = [r["change"] for r in change.classify(inc, sto, ["k"], "d", policy).orderBy("k").collect()]
    full = {"vote": ["New", "Unchanged", "Unchanged", "Updated"], "bill": ["New", "Unchanged", "Updated", "Updated"]}
    assert got == full[policy]


positions = st.dictionaries(st.integers(0, 14), st.sampled_from(["Yea", "Nay", None]), max_size=15)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(positions, positions)
def test_keyed_diff_property(spark, a, b):
    make = lambda d: spark.createDataFrame(list(d.items()) or [], "k int, v string")
    got = {r["k"]: r["diff"] for r in change.keyed_diff(make(a), make(b), ["k"]).collect()}
    want = {k: "Added" if k not in a else "Removed" if k not in b else "Same" if a[k] == b[k] else "Changed" for k in a.keys() | b.keys()}
    assert got == want


def test_fuzzy_tiers(spark):
    people = spark.createDataFrame([(1, "Ann", "Lee", "Ohio", 0), (2, "Bob", "Lee", "Ohio", 1), (3, "Cy", "Poe", "Iowa", 2)], "id int, first string, last string, state string, pos int")
    seats = spark.createDataFrame([(1, "bob", " LEE", "ohio"), (2, "Andy", "Lee", "Ohio"), (3, "Zed", "Lee", "Ohio"), (4, "Zed", "Poe", "Iowa"), (5, "Q", "Nil", "Iowa")], "row int, first string, last string, state string")
    got = {r["row"]: r["id"] for r in resolve.resolve_fuzzy(seats, people, "last", "first", "state", "id", "pos", "row").collect()}
    assert got == {1: 2, 2: 1, 3: None, 4: 3, 5: None}


def test_parent_chain_limits(spark):
    t = spark.createDataFrame([("a", "b", None), ("b", "c", 7), ("c", None, 8), ("x", "y", None), ("y", "x", None), ("m", "gone", None)], "k string, p string, v int")
    got = {r["k"]: (r["depth"], r["root"], r["v"], r["failed"]) for r in resolve.parent_chain(t, "k", "p", "v", most=4).collect()}
    assert got["a"] == (2, "c", 7, False) and got["c"] == (0, "c", 8, False)
    assert got["x"][3] and got["y"][3] and got["m"] == (1, "gone", None, False)


def test_chains_of_all_lengths(spark):
    """Trees, chains up to and over the limit, circles, and chains that lead into circles, against a walk."""
    import random

    r = random.Random(4)
    up = {k: (None if k % 9 == 0 else k - r.randrange(1, 4) if k % 40 else k + 5) for k in range(300)} | {1000 + k: 1001 + k for k in range(14)}
    values = {k: k if k % 5 == 0 else None for k in up}
    for most in (1, 4, 10):
        want = {}
        for k in up:
            at, n, v = k, 0, values[k]
            while up.get(at) is not None and n <= most:
                at, n = up[at], n + 1
                v = values.get(at) if v is None else v
            want[k] = (n, at, v, False) if n <= most else (None, None, None, True)
        t = spark.createDataFrame([(k, p, values[k]) for k, p in up.items()], "k int, p int, v int")
        assert {x["k"]: tuple(x)[1:] for x in resolve.parent_chain(t, "k", "p", "v", most).collect()} == want


def test_best_version_ties(spark):
    v = spark.createDataFrame([(1, None, "PDF", 0), (1, "2024", "PDF", 1), (1, "2024", "Text", 2), (1, "2024", "Text", 3), (1, "2025", "Doc", 4)], "b int, d string, f string, pos int")
    assert rank.best_version(v, "b", "d", "f", "pos", {"Text": 0, "XML": 1, "PDF": 2}).first()["pos"] == 3
    assert rank.best_format(v, ["b", "d"], "f", "pos", {"Text": 0, "PDF": 2}).where("d = '2024'").first()["pos"] == 2


def test_cosine(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0])], "vec_id int, embedding array<float>")
    got = rank.cosine_topk(v, [1.0, 0.0], 2).collect()
    assert got[0]["similarity"] > 0.99 and got[1]["similarity"] < 0.01


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="ab \n", max_size=40), st.integers(1, 9))
def test_chunks_property(spark, s, n):
    got = spark.createDataFrame([(s,)], "t string").select(texts.chunks(F.col("t"), n).alias("c")).first()["c"]
    want = [c for c in (s[k : k + n].strip(" ") for k in range(0, len(s), n)) if c]
    assert got == want


def test_chunks_size():
    with pytest.raises(ValueError):
        texts.chunks(F.col("t"), 0)


def test_embed(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,), ("boom",)], "content string")

    def model(some):
        if "boom" in some:
            raise RuntimeError
        return [[float(len(s)), 1.0] for s in some]

    got = texts.embed(df, "content", model, 2, batch=1).collect()
    assert [r["embedding"] for r in got] == [[3.0, 1.0], None, None, None]
    assert texts.embed(df, "content", None, 2).first()["embedding"] is None


def test_roster(spark):
    page = "Budget\nRoom 5\nAnn Lee, of Ohio, Chair.     ``Bo'' Robert Poe, III, of Iowa.\nX. Y. Zee, of West Virginia.  Max Moe, of\n   (p)   Texas, Ranking Member."
    listings = spark.createDataFrame([(1, page), (2, None), (3, "no heading\nAnn Lee, of Ohio.")], "id long, text string")
    got = texts.parse_rosters(listings, ["Committee on the Budget", "Budget"], ["Ohio", "Iowa", "Virginia", "West Virginia", "Texas"]).collect()
    assert {(g["first_name"], g["last_name"], g["state"], g["role"]) for g in got} == {("Ann", "Lee", "Ohio", "Chairman"), ("X.", "Zee", "West Virginia", None), ("Robert", "Poe", "Iowa", None), ("Max", "Moe", "Texas", "Ranking Member")}
    assert len(got) == 4 and all(g["id"] == 1 and g["committee"] == "Budget" and not g["is_subcommittee"] for g in got)


PRINTED = """STANDING COMMITTEES OF THE HOUSE
[Democrats in roman; Republicans in italic]
Agriculture
1301 Longworth House Office Building, phone 225-2171
https://agriculture.house.gov
David Scott, of Georgia, Chair
Alma S. Adams, of North Carolina, Vice Chair
Jim Costa, of California.            Glenn Thompson, of Pennsylvania.
James P. McGovern, of                Austin Scott, of Georgia.
        Massachusetts.                Eric A. ``Rick'' Crawford, of
Abigail Davis Spanberger, of            Arkansas.
        Virginia.                     Scott DesJarlais, of Tennessee."""


def test_printed_page(spark):
    states = ["Georgia", "North Carolina", "California", "Pennsylvania", "Massachusetts", "Virginia", "Arkansas", "Tennessee"]
    pages = spark.createDataFrame([(1, PRINTED), (2, "\n".join(x.lstrip() for x in PRINTED.splitlines()))], "id long, text string")
    want = {("David", "Scott", "Georgia", "Chairman"), ("Alma", "Adams", "North Carolina", "Vice Chairman"), ("Jim", "Costa", "California", None), ("James", "McGovern", "Massachusetts", None), ("Abigail", "Spanberger", "Virginia", None), ("Glenn", "Thompson", "Pennsylvania", None), ("Austin", "Scott", "Georgia", None), ("Eric", "Crawford", "Arkansas", None), ("Scott", "DesJarlais", "Tennessee", None)}
    got = [tuple(r) for r in texts.parse_rosters(pages, ["Agriculture", "Appropriations"], states).collect()]
    assert sorted(map(str, got)) == sorted(str((k, "Agriculture", False, *p)) for k in (1, 2) for p in want)
    assert texts.parse_rosters(pages, ["Appropriations"], states).count() == 0


def test_rosters_without_stops(spark):
    states = ["Ohio", "Texas", "Utah", "Iowa", "Virginia", "West Virginia", "District of Columbia"]
    cases = {
        "John Smith, of Texas, Chair Bob Jones, of Ohio": [("John", "Smith", "Texas", "Chairman"), ("Bob", "Jones", "Ohio", None)],
        "Ohio\nCarl Ray, of Utah": [("Carl", "Ray", "Utah", None)],
        "Ann Lee, of West Virginia Bob Poe, Sr., of Virginia, Ranking Member Cy Fox, of Iowa": [("Ann", "Lee", "West Virginia", None), ("Bob", "Poe", "Virginia", "Ranking Member"), ("Cy", "Fox", "Iowa", None)],
        "Eleanor Holmes Norton, of District of Columbia. Henry de la Cruz, of Texas": [("Eleanor", "Norton", "District of Columbia", None), ("Henry", "Cruz", "Texas", None)],
        "Room 5, Longworth Building, Ann Lee, of Ohio": [("Ann", "Lee", "Ohio", None)],
        "Ann Lee, of Ohioana. Lee, of Ohio": [],
        "Ann Lee, of Ohio.   Bob Poe, of Iowa.\n                    Cy Fox, of Utah.": [("Ann", "Lee", "Ohio", None), ("Bob", "Poe", "Iowa", None), ("Cy", "Fox", "Utah", None)],
    }
    rows = spark.createDataFrame([(k, f"Budget\n{text}") for k, text in enumerate(cases)], "id long, text string")
    got = texts.parse_rosters(rows, ["Budget"], states).collect()
    for k, want in enumerate(cases.values()):
        assert [tuple(r)[3:] for r in got if r["id"] == k] == want, k


def test_dates(spark):
    for raw, want in [("2025-01-03T23:30:00-05:00", date(2025, 1, 3)), ("2025-01-03T10:00:00", date(2025, 1, 3)), ("Friday, January 3,  2025, 02:15 PM", date(2025, 1, 3)), ("January 13, 2025, 02:15 PM", date(2025, 1, 13)), ("soon", None), (None, None)]:
        assert one(spark, dates.vote_date(F.lit(raw).cast("string"))) == want, raw
    assert one(spark, dates.first_year(F.lit(119))) == 2025 and one(spark, dates.congress_of_year(F.lit(2026))) == 119


def test_keys(spark):
    assert one(spark, keys.amendment_number(F.lit("S.Amdt. 123"))) == "123"
    assert one(spark, keys.amendment_number(F.lit("S.Amdt. 12a"))) is None
    assert one(spark, keys.amended_bill_key(F.lit("H.J.Res.  5"), F.lit(118))) == "118-HJRES-5"
    assert one(spark, keys.parse_key(F.lit("118-HR-1-2")))["number"] == "1-2"
    assert not one(spark, keys.parse_key(F.lit("x-HR-1")))["valid"]
    assert one(spark, keys.roll_number(F.lit("Record Vote No.: 77"), F.lit("Senate"))) == 77
    assert one(spark, keys.roll_number(F.lit("nothing"), F.lit("House"))) is None
    assert one(spark, keys.version_code(F.lit("Public Print"))) == "PP" and one(spark, keys.version_code(F.lit("?"))) is None


class _Plain(HTMLParser):
    """The text of a body by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.off, self.body, self.seen = [], 0, False, False

    def handle_comment(self, data):
        self.parts.append(" ")

    handle_decl = unknown_decl = handle_pi = handle_comment

    def handle_starttag(self, tag, attrs):
        self.parts.append(" ")
        self.off += tag in ("script", "style", "title")
        if tag == "body":
            self.body, self.seen = True, True

    def handle_endtag(self, tag):
        self.parts.append(" ")
        self.off -= tag in ("script", "style", "title") and self.off > 0
        if tag == "body":
            self.body = False

    def handle_data(self, data):
        if self.body and not self.off:
            self.parts.append(data)


def plain(page):
    p = _Plain()
    p.feed(page if "<body" in page.lower() else f"<body>{page}")
    p.close()
    return re.sub(r"\s+", " ", "".join(p.parts).replace("\u00a0", " "), flags=re.ASCII).strip(" ")


def test_markup_against_a_plain_parser(spark):
    cases = [
        "if a < b and c > d end", "<p title='a>b'>x</p>", '<p title="a>b" data-x=1>y</p>', "<body>a<br/>b<!-- > </p> -->c</body>after", "<p>1 < 2 &amp;&amp; 3 > 2", "<script>if (a < b) '</p>';</script>t", "<style>p > a {}</style>t<script>x</script >u",
        "<p class=a/b>slash</p>", "a <3 b", "&lt;b&gt; &#167;&copy; &nope; AT&T", "<P\nCLASS='x'\n>upper</P><BR>", "<p =x>odd</p>", "x<!DOCTYPE html>y", "<a href='x'title=\"y>\">glued</a>", "<b>bo</b>ld<i></i>", "</p>end first<p>", "<script>never closed", "<p a='1' b>q</p>", "", "  \t ",
        "<head><title>t < u</title></head><body>in the body</body>",
    ]
    for page in cases:
        assert markup.html_text(page) == plain(page), page
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html", text.html_fragments(F.col("html")).alias("got"), text.html_fragments(F.substring("html", 1, 700)).alias("cut")).collect()
    for r in pages:
        assert r["got"] == plain(r["html"]), r["page_id"]
    assert markup.html_text("<textarea><b>raw</b> &lt;</textarea>z") == "<b>raw</b> < z"
    assert markup.html_text(None) is None and markup.html_text("<html><head>h<meta x></head><p>text") == "text"
    assert markup.html_text("<div>" * 50_000 + "deep") == "deep" and markup.html_text("<" * 100_000).count("<") == 100_000


def test_xml_markup():
    x = lambda d: markup.xml_text(d, "legis-body")
    assert x("<a:legis-body x='>'>one<b/>two <c t=\"<d>\">&lt;3</c></a:legis-body> out <legis-body/> <legis-body>x<legis-body>y</legis-body>z</legis-body>") == "one two <3 x y z"
    assert x("<?xml version='1.0'?><!DOCTYPE b SYSTEM 'f'><legis-body><![CDATA[a <b> &amp;]]> c<!-- no --></legis-body>") == "a <b> &amp; c"
    assert x("<legis-body>open <![CDATA[end") == "open end" and x(None) is None and x("none") == ""


def test_record_marks():
    cases = {
        "Section 1. [[Page S5256]] Some text.": "Section 1. Some text.", "[Time: 10:30 a.m.] Mr. SCHUMER. I rise": "Mr. SCHUMER. I rise", "a Pg S5255 b Page 12-3, c Page 5a d": "a b , c Page 5a d",
        "Mr. X.\n\n\tThe text.\n[Time: 10:30] On.": "Mr. X. The text. On.", "[Timely: x] [ Time:  now] y": "[Timely: x] y", "[[ Page H1-S2 ]] [[Pages 1]] [[Page S 5]]": "[[Pages 1]] [[Page S 5]]",
        "Page 7-x Homepage 5 Page": "-x Homepage 5 Page", "[Time: open": "[Time: open", "[Time: [[Page S1]] x": "] x", "Page\n9\tz": "z", "Pg 12-34-56": "-56", "[[Page é]]": "[[Page é]]",
    }
    for given, want in cases.items():
        assert markup.record_text(given) == want, given
        assert markup.record_text(want) == want
    assert markup.record_text(None) is None


def test_urls_and_text(spark):
    assert one(spark, urls.bill_text_url(F.lit("https://www.congress.gov/118/bills/hr1/BILLS-118hr1ih.htm?x=1"), "https://b/")) == "https://b/packages/BILLS-118hr1ih/htm"
    assert one(spark, urls.bill_text_url(F.lit("https://elsewhere/"), "https://b")) is None
    assert one(spark, text.strip_record_noise(F.lit("[Time: 10:30] a [[Page S1]]  b Pg S5255 c"))) == "a b c"
    assert one(spark, text.html_fragments(F.lit("<html><head>h</head><body><script>x</script><p>A &amp; b</p><p>c</body>"))) == "A & b c"
    assert one(spark, text.html_fragments(F.lit("<p>&#167; 5 &mdash; it&#8217;s &#x41;&amp;lt; &nope; &nbsp;x"))) == "\u00a7 5 \u2014 it\u2019s A&lt; &nope; x"
    assert one(spark, texts.bill_xml_text(F.lit("<b><legis-body>&lt;a&gt; <![CDATA[1 < 2 &amp;]]></legis-body><x>no</x><legis-body a='1'>two</legis-body></b>"))) == "<a> 1 < 2 &amp; two"
    assert one(spark, urls.record_text_url(F.lit("https://www.congress.gov/117/crec/2021/08/01/167/1/modified/CREC-2021-08-01-pt1-PgS52-3.htm"), "https://b")) == "https://b/packages/CREC-2021-08-01/granules/CREC-2021-08-01-pt1-PgS52-3/htm"
    assert one(spark, urls.record_text_url(F.lit("https://congress.gov/117/crec/2021/08/01/167/CREC-2021-08-01-pt1-PgS52.htm"), "https://b")) is None
    assert one(spark, keys.roll_number(F.lit("Passed: Roll call 45."), F.lit("House"))) == 45
    assert one(spark, texts.bill_xml_text(F.lit("<bill><title>t</title><legis-body><p>One</p> <p>two</p></legis-body></bill>"))) == "One two"
    assert one(spark, texts.extract_record(F.lit("x"), F.lit("DOC")))["error"] == "unsupported format: DOC"
