"""Methods of the training-data operators held against plain code: style trees, tilings, flows, posteriors, entities, recall; and SQL."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import decontamination, jaccard_join, language_id, mixing, pii, quality_rules, site_style_tree, suffix_dedup
from docketry.llm.registry import ORACLES, QUERIES

from test_llm import SF, extracted, frame, words


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    got = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == sorted(found.fetchall(), key=str)


# 1
def test_base_against_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op1_quality_rules"](spark, SF).collect()}
    for d in docs:
        text = d["text"] or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines, seen, dup = text.split("\n"), set(), 0
        for line in lines:
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        grams = Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
        repeat = {k + j for k in range(len(ws) - 2) if grams[tuple(ws[k : k + 3])] > 1 for j in range(3)}
        failed = len(ws) < 50 or 100 * len(repeat) > 50 * len(ws)
        r = got[d["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), failed)
        assert not (failed and r["kept"])


# 2
def test_order_of_windows_is_whole():
    r = random.Random(11)
    text = bytes(r.choice(b"abc") for _ in range(4000))
    text += text[500:2500] + bytes(80)
    starts = np.arange(5900)
    for window in (5, 12, 50):
        order, begins = suffix_dedup.sort_windows(np.frombuffer(text, np.uint8), starts, window)
        strings = [text[s : s + window] for s in order]
        assert strings == sorted(strings) and sorted(order) == starts.tolist()
        assert begins.tolist() == [True] + [strings[k] != strings[k - 1] for k in range(1, len(strings))]


# 3
def test_a_person_is_one_entity(spark):
    texts = ["Mrs Anna Weber met us. Anna Weber left; Dr Anna Weber and Ms Weber spoke, and Weber smiled. Weberin, Annas.", "Mr. Karl Weber and Mrs Anna Weber", "Anna Weber stays: no title here", "AA-BB-CC-DD-EE-FF and 2001:db8::1, std::list, 12:30:45, a::b"]
    got = [r["text"] for r in pii.replace_entities(frame(spark, texts), "k").orderBy("doc_id").collect()]
    full = re.match(r"Mrs (\w+ \w+) met", got[0])[1]
    last = full.split()[1]
    assert got[0] == f"Mrs {full} met us. {full} left; Dr {full} and Ms {last} spoke, and {last} smiled. Weberin, Annas." and "Weber " not in got[0]
    assert full.split()[0] in pii._GIVEN["latin", "f"]
    assert got[1].endswith(f"Mrs {full}") and re.match(rf"Mr\. (\w+) {last} and", got[1])[1] in pii._GIVEN["latin", "m"]
    assert got[2] == texts[2]
    assert re.fullmatch(r"(?:[0-9A-F]{2}-){5}[0-9A-F]{2} and [0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f], std::list, 12:30:45, a::b", got[3]) and "AA-BB" not in got[3]


def test_names_as_they_are_written(spark):
    """Names of all shapes leave whole; words that are no persons stay."""
    texts = {
        "Mr McDonald met Mrs MacLeod, Dr DeVito, Ms O'Neill, Dr. O’Brien. McDonald's car; O'Neill left.": ["McDonald", "Donald", "MacLeod", "Leod", "DeVito", "Vito", "O'Neill", "Neill", "Brien"],
        "Mr J. R. Smith sat. J. R. Smith and Smith came. Mr J.R.Smith too. Mr Smith. He went.": ["J. R.", "J.R.", "Smith"],
        "Frau Prof. Dr. Anna von der Weber und Herr Dr. med. Koch; Mr van Gogh, van Gogh, Gogh": ["Anna", "Weber", "Koch", "Gogh"],
        "Mr John F. Kennedy, John Kennedy and John F. Kennedy": ["John", "Kennedy", "F."],
        "г-жа Анна Иванова и Иванова, г-н А. Б. Петров": ["Анна", "Иванова", "Петров", "А. Б."],
    }
    stay = ["Ms Will said Will you come? Will the house stand?", "Mrs King lives in King County.", "Mr. Bush said: Bush fires burn the bush.", "Mr de facto. Dr. NASA. Frau Dr. med. then", "John Smith and Mary McDonald"]
    got = [r["text"] for r in pii.replace_entities(frame(spark, [*texts, *stay]), "k").orderBy("doc_id").collect()]
    for new, gone in zip(got, texts.values(), strict=False):
        assert not [g for g in gone if g in new], new
    assert re.fullmatch(r"Mr (\w\. \w\.) (\w+) sat\. \1 \2 and \2 came\. Mr \w\.\w\.\2 too\. Mr \2\. He went\.", got[1])
    assert re.fullmatch(r"Frau Prof\. Dr\. \w+ von der \w+ und Herr Dr\. med\. \w+; Mr (van (\w+)), \1, \2", got[2])
    assert re.fullmatch(r"Mr (\w+) (\w\.) (\w+), \1 \3 and \1 \2 \3", got[3])
    at = len(texts)
    assert re.fullmatch(r"Ms (?!Will)\w+ said Will you come\? Will the house stand\?", got[at])
    assert re.fullmatch(r"Mrs (?!King)\w+ lives in King County\.", got[at + 1])
    assert re.fullmatch(r"Mr\. (?!Bush)\w+ said: Bush fires burn the bush\.", got[at + 2])
    assert got[at + 3 :] == stay[3:]


def test_planted_persons_against_plain_replacement(spark):
    """Texts put together from persons and plain words: by the surrogates of each title, name and surname, plain replacement gives the operator's rows."""
    r = random.Random(31)
    surnames = ["Weber", "McDonald", "O'Neill", "DeVito", "Meyer-Lund", "Smith", "Quade", "Ó Briain".split()[1]]
    people = [(t, g, s) for s in surnames for t, g in (("Mrs", "Anna"), ("Mr.", "Karl"), ("Dr", ""), ("Mr", "Jean-Luc"))]
    texts, parts = [], []
    for k in range(60):
        chosen = r.sample(people, 4)
        seen = [f"{t} {g} {s}".replace("  ", " ") for t, g, s in chosen] + [s for _, _, s in chosen] + [f"{g} {s}" for _, g, s in chosen if g]
        row = [(words(4, k * 20 + i).lower(), x) for i, x in enumerate(seen)]
        parts.append(row)
        texts.append(" ".join(f"{plain} {person}," for plain, person in row))
    got = [x["text"] for x in pii.replace_entities(frame(spark, texts), "k").orderBy("doc_id").collect()]
    swap = {}
    for row, new in zip(parts, got, strict=True):
        for (plain, person), piece in zip(row, new.split(","), strict=False):
            assert piece.strip().startswith(plain + " ")
            swap.setdefault(person, set()).add(piece.strip()[len(plain) + 1 :])
    assert all(len(v) == 1 for v in swap.values()) and len({v for s in swap.values() for v in s}) == len(swap)
    assert [" ".join(f"{plain} {min(swap[person])}," for plain, person in row) for row in parts] == got
    for t, g, s in people:
        new = min(swap.get(f"{t} {g} {s}".replace("  ", " "), {""}))
        assert not new or new.startswith(t + " ") and new.endswith(" " + min(swap[s])) and s not in new


def test_ibans_keep_whether_they_hold(spark):
    def rest(x):
        x = x.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97

    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR1420041010050500013M02606", "DE88 3704 0044 0532 0130 00"]
    got = [x["text"][4:] for x in pii.replace_entities(frame(spark, ["Pay " + x for x in ibans]), "k").orderBy("doc_id").collect()]
    for old, new in zip(ibans, got, strict=True):
        assert new != old and new[:2] == old[:2] and rest(new) == rest(old)
        assert [c.isdigit() for c in new] == [c.isdigit() for c in old] and len(new) == len(old)


def test_many_surnames_of_a_script(spark):
    e = spark.range(20_000).select(F.lit("SURNAME").alias("kind"), F.concat(F.lit("ив"), F.translate(F.col("id").cast("string"), "0123456789", "абвгдежзик")).alias("canon"), F.lit(None).cast("string").alias("hint"))
    got = pii.assign(e, "k")
    assert got.agg(F.count_distinct("canon"), F.count_distinct("replacement"), F.count("*")).first()[:] == (20_000, 20_000, 20_000)


def test_planted_entities_leave_and_hold_together(spark):
    r = random.Random(12)
    mails = [f"user{k}@host{k % 7}.example.org" for k in range(60)]
    phones = [f"+1-555-{r.randrange(100, 1000)}-{r.randrange(1000, 10000)}" for k in range(60)]
    texts = [f"{words(5, k)} {mails[k % 60]} {words(3, k)} {phones[k * 7 % 60]} {words(4, k)}" for k in range(200)]
    got = [x["text"].split() for x in pii.replace_entities(frame(spark, texts), "k").orderBy("doc_id").collect()]
    swapped = defaultdict(set)
    for old, new in zip((t.split() for t in texts), got, strict=True):
        assert len(old) == len(new)
        for a, b in zip(old, new, strict=True):
            swapped[a].add(b)
    assert all(len(v) == 1 for v in swapped.values())
    real = set(mails) | set(phones)
    new = {a: v.pop() for a, v in swapped.items()}
    assert all((new[a] != a) == (a in real) for a in new) and len({new[a] for a in real if a in new}) == len([a for a in real if a in new])
    assert not set(new.values()) & real


# 5
def test_recall_end_to_end(spark):
    """Clusters of texts near the threshold, one of 300: all links that plain code finds."""
    r = random.Random(13)
    texts = []
    for c, n in enumerate([300] + [12] * 25):
        base = words(120, 500 + c).split()
        for _ in range(n):
            ws = list(base)
            for _ in range(r.randrange(0, 5)):
                ws[r.randrange(len(ws))] = f"x{r.randrange(10**6)}"
            texts.append(" ".join(ws))
    sets = [frozenset(jaccard_join.shingles(t).tolist()) for t in texts]
    rep: dict = {}
    first = [rep.setdefault(s, k) for k, s in enumerate(sets)]
    want = dict.fromkeys(set(first), 0)
    for a in want:
        for b in want:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                want[a] += 1
                want[b] += 1
    got = {x["doc_id"]: x["n_links"] for x in jaccard_join.jaccard_groups(frame(spark, texts)).collect()}
    assert sum(want.values()) > 5_000 and all(got[k] == n for k, n in want.items())


# 6
def plain_tiling(doc, item, least):
    """Greedy string tiling as it is defined: of all unmarked common runs the longest, first in the document, is marked, until none reaches least."""
    free_d, free_i, total = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_d[i + n] and free_i[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return total
        for k in range(n):
            free_d[i + k] = free_i[j + k] = False
        total += n


def test_tiles_against_plain_tiling(spark):
    r = random.Random(14)
    for _ in range(150):
        item = [r.randrange(1, 8) for _ in range(r.randrange(5, 30))]
        doc = [r.randrange(1, 8) for _ in range(r.randrange(0, 10))] + item[r.randrange(len(item)) :] + [r.randrange(1, 9) for _ in range(r.randrange(0, 20))] + item[: r.randrange(len(item))]
        assert sum(n for _, _, n in decontamination.tiles(np.array(doc), np.array(item), 3)) == plain_tiling(doc, item, 3)


def test_items_without_and_with_shared_ids(spark):
    a, b, c = words(30, 81), words(30, 82), words(30, 83)
    bench = spark.createDataFrame([(1, a), (1, b), (None, c), (2, None)], "item_id long, text string")
    docs = frame(spark, ["x " + a, "y " + b, "z " + c, words(40, 84)])
    for block in (2_000_000, 150):
        got = {r["doc_id"]: (r["leak_item"], r["leaked"]) for r in decontamination.contamination(docs, bench, block_chars=block).collect()}
        assert got == {0: (1, True), 1: (1, True), 2: (None, True), 3: (None, False)}


# 7
def test_posterior_against_plain_bayes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").withColumn("host", F.concat("source", F.lit(".site"), (F.col("doc_id") % 3).cast("string"), F.lit(".example")))
    docs = docs.withColumn("url", F.concat(F.lit("http://"), "host", F.lit("/"), "lang", F.lit("/1")))
    model = language_id.train(docs)
    rows = language_id.identify(docs, model, F.col("text"), F.col("lang"), F.col("host"), F.col("url")).collect()
    k, smooth = len(model.languages), 20.0
    score = {r["doc_id"]: model.scores(r["text"]) for r in rows}
    best = {i: int(np.argmax(s)) for i, (s, n) in score.items() if n}
    count = lambda by: {key: np.array([sum(1 for r in rows if by(r) == key and best.get(r["doc_id"]) == j) for j in range(k)], float) for key in {by(r) for r in rows}}
    all_ = np.array([sum(1 for b in best.values() if b == j) for j in range(k)], float)
    corpus = (all_ + 1) / (all_.sum() + k)
    up = lambda h: ".".join(h.split(".")[-2:])
    hosts, domains, said, hint = count(lambda r: r["host"]), count(lambda r: up(r["host"])), count(lambda r: r["lang"]), count(lambda r: r["lang"])
    for r in rows:
        d = domains[up(r["host"])] + smooth * corpus
        h = hosts[r["host"]] + smooth * d / d.sum()
        joint = np.array(score[r["doc_id"]][0]) + np.log(h / h.sum()) + np.log((said[r["lang"]] + 0.01) / (all_ + 1)) + np.log((hint[r["lang"]] + 0.01) / (all_ + 1))
        p = np.exp(joint - joint.max())
        assert r["language"] == model.languages[int(np.argmax(joint))] and r["posterior"] == pytest.approx(p.max() / p.sum(), abs=1e-6)


def test_other_languages_are_unknown(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    strange = spark.createDataFrame([(-1, "これは日本語の文章です。猫が好きです。" * 20, None, "src0"), (-2, "Ελληνικό κείμενο για δοκιμή και άλλα " * 10, None, "src0")], docs.schema)
    out = language_id.identify(docs.unionByName(strange), language_id.train(docs), F.col("text"), F.col("lang"), F.col("source"))
    assert {r["language"] for r in out.where("doc_id < 0").collect()} == {language_id.UNKNOWN}
    assert out.where("doc_id >= 0").where(language_id.accepted()).count() == docs.count()


def test_pages_speak_with_all_witnesses(spark):
    got = QUERIES["op7_page_languages"](spark, SF)
    assert got.agg(F.avg((F.col("declared") == F.col("language")).cast("double"))).first()[0] > 0.95


# 8
def plain_style_tree(pages):
    """(host, key) to (pages, entropy) by one dictionary of counters; equal pages of a host count once."""
    tree = defaultdict(lambda: (Counter(), Counter()))
    for host, page in {(re.match(r"\w+://([^/]*)", u)[1], h) for u, h in pages}:
        for key, _, style, content in site_style_tree.style_nodes(page):
            tree[host, key][0][style] += 1
            tree[host, key][1][content] += 1
    out = {}
    for at, counters in tree.items():
        m = sum(counters[0].values())
        out[at] = (m, max(-sum(n / m * math.log(n / m, m) for n in c.values()) for c in counters) if m > 1 else 1.0)
    return out


def test_tree_against_plain_tree(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").where("html is not null and url is not null")
    pages = pages.unionByName(pages.limit(5))
    want = plain_style_tree([(r["url"].lower(), r["html"]) for r in pages.collect()])
    got = {(r["host"], r["key"]): (r["pages"], r["entropy"]) for r in site_style_tree.style_tree(pages).collect()}
    assert set(got) == set(want) and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-9) for k in want)


def test_tree_decides_and_spares_main_text(spark):
    page = '<body><div class=intro>Welcome</div><article><div class="article-header"><h1>Title {0}</h1><p>Lead {0}</p></div><p>Body {0}</p><div class="x">Our app is out</div><div class="related-work"><p>Work {0}</p></div></article></body>'
    got = extracted(spark, [page.format(k) for k in range(30)])
    assert got == [f"Title {k}\nLead {k}\nBody {k}\nWork {k}" for k in range(30)]
    assert "Our app is out" in extracted(spark, [page.format(1)])[0]  # one page tells nothing about its site
    nested = '<main><div class="sidebar-layout"><article><p>Body</p></article></div></main>'
    assert extracted(spark, [nested] * 3) == ["Body"] * 3
    same = "<body><article><p>Always this</p></article><p>{0}</p></body>"
    assert all("Always this" in t for t in extracted(spark, [same.format(k) for k in range(30)]))
    deep = "<div>" * 60 + "<p>{0}</p><b>frame</b>" + "</div>" * 60
    assert extracted(spark, [deep.format(f"text {k}") for k in range(20)]) == [f"text {k}" for k in range(20)]
    assert extracted(spark, ["<div class=ad>Buy</div><div>Text {0}</div>".format(k) for k in range(4)], url=None) == [f"Text {k}" for k in range(4)]


def test_presentations_outvote_what_is_declared(spark):
    """Branches that are called frames, or lie beside a main part, and are built anew on each page stay; those that only change their words, their length or the entry of the present page go."""
    r = random.Random(4)
    tags = "p h2 ul blockquote table pre dl figure".split()

    def built(k):
        return "".join(f"<{t}>{t} {k}</{t}>" for t in r.sample(tags, r.randrange(2, 6)))

    def lines(k, html):
        return [line for line in re.findall(rf"\w+ {k}\b", html)]

    for open_, close in (('<div class="social">', "</div>"), ("<aside>", "</aside>"), ("<section>", "</section>")):
        bodies = [built(k) for k in range(60)]
        menu = ["".join(f"<li{' class=active' if j == k % 5 else ''}><a>to {r.random()}</a></li>" for j in range(r.randrange(6, 9))) for k in range(60)]
        pages = [f"<body><nav><ul>{m}</ul></nav><div class=ad>Buy {k * 7919}</div><main><p>Main {k}</p></main>{open_}{b}{close}<footer>Foot {k}</footer></body>" for k, (b, m) in enumerate(zip(bodies, menu, strict=True))]
        got = extracted(spark, pages)
        assert got == ["\n".join([f"Main {k}", *lines(k, b)]) for k, b in enumerate(bodies)]
        # few pages are little evidence against what is declared
        assert extracted(spark, pages[:4]) == [f"Main {k}" for k in range(4)]


def test_tree_is_what_removes_declared_branches(spark):
    """Priors and entropies apart: with the entropies of branches that always vary, the priors alone remove no branch that 8 and more pages have."""
    tree = site_style_tree.style_tree(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).where("pages >= 8").cache()
    declared = F.col("kind").isin(*site_style_tree.DECLARED)
    as_it_is = tree.where(declared & (F.col("importance") < 0.5)).count()
    blind = site_style_tree.importance(F.col("kind"), F.col("pages"), F.lit(1.0), F.lit(1.0))
    assert as_it_is > 0 and tree.where(declared & (blind < 0.5)).count() == 0


def test_pages_of_the_tables_come_through_the_tree(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    with_tree = {r["page_id"]: r["text"] for r in site_style_tree.extract_main_text(pages).collect()}
    without = {r["page_id"]: site_style_tree.main_text(r["html"]) for r in pages.collect()}
    assert sum(with_tree[k] != without[k] for k in with_tree) > 0.9 * len(with_tree)


# 10
def cheapest(patterns, quotas):
    """(flow, repeated words) by trying all integer routings of small patterns."""
    kinds, best = list(patterns), (-1, 0)

    def go(k, left, flow, again):
        nonlocal best
        if k == len(kinds):
            best = max(best, (flow, -again))
            return
        n, names = patterns[kinds[k]], kinds[k]

        def split(j, used, now):
            if j == len(names):
                go(k + 1, now, flow + used, again + max(0, used - n))
                return
            for x in range(min(2 * n - used, now[names[j]]) + 1):
                split(j + 1, used + x, {**now, names[j]: now[names[j]] - x})

        split(0, 0, left)

    go(0, dict(quotas), 0, 0)
    return best[0], -best[1]


def test_flow_of_overlapping_sources():
    r = random.Random(15)
    for _ in range(25):
        patterns = {p: r.randrange(0, 4) for p in [("a",), ("a", "b"), ("b", "c"), ("c",)]}
        quotas = {s: r.randrange(0, 6) for s in "abc"}
        got = mixing.route(patterns, quotas)
        used = {p: sum(x.values()) for p, x in got.items()}
        for s in quotas:
            assert sum(x.get(s, 0) for x in got.values()) <= quotas[s]
        assert (sum(used.values()), sum(max(0, used[p] - n) for p, n in patterns.items())) == cheapest(patterns, quotas)


def test_many_patterns():
    r = random.Random(16)
    names = [f"s{k}" for k in range(60)]
    patterns = {tuple(sorted(r.sample(names, 3))): r.randrange(1, 50) for _ in range(25_000)}
    total = sum(patterns.values())
    got = mixing.route(patterns, dict.fromkeys(names, round(1.5 * total / 60)))
    assert abs(sum(sum(x.values()) for x in got.values()) - 1.5 * total) < 60


def test_mix_of_overlapping_sources(spark):
    r = random.Random(17)
    docs = spark.createDataFrame([(k, r.sample(["a", "b", "c"], r.randrange(1, 3)), r.randrange(0, 90)) for k in range(900)], "doc_id long, sources array<string>, n long")
    rows = mixing.mix(docs, F.col("n"), F.col("sources")).collect()
    assert len(rows) == 900 and all(x["taken_"] in (0, x["size_"], 2 * x["size_"]) for x in rows)
    total = sum(x["size_"] for x in rows)
    assert abs(sum(x["taken_"] for x in rows) - 1.5 * total) < 0.01 * total


# stages
def test_a_repeated_row_stays_once(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, words(60, 1)), (1, words(60, 1)), (2, words(60, 2)), (3, words(60, 1))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.one_of_near_copies(spark, docs, SF).collect()) == [1, 2]


def test_rules_are_a_case_expression(spark):
    rule = quality_rules.Rule((("symbol_rate", True, 0.5), ("mean_word", False, 9.0)), 1.0, 3)
    rows = spark.createDataFrame([(10, 40, 9, 0, 0, 0, 0, 0, 1), (10, 200, 9, 0, 0, 0, 0, 0, 1), (0, 0, 0, 0, 0, 0, 0, 0, 0)], ", ".join(f"{s} long" for s in quality_rules.STATS))
    assert [r[0] for r in rows.select(quality_rules.verdict([rule])).collect()] == [False, True, True]


def test_stages_pass_columns_of_any_name(spark):
    """Columns that bear names of the stages' own come back with their own values."""
    import corpus_pipeline

    mine = ["language", "posterior", "trigrams_", "class_id", "__key", "leak_item", "leaked", "n_entities", "__pii_found", "__pii_match", "row_", "a.b"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 12")
    docs = docs.select("*", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in mine])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.select("doc_id", *[F.col(f"`{c}`") for c in mine]).collect()
        assert rows and all(list(r)[1:] == [f"{c}-{r['doc_id']}" for c in mine] for r in rows), name
