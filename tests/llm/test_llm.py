"""The training-data operators against brute force, held-out labels and planted cases; and the odd tables that each must take."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import automaton_dedup, decontamination, jaccard_join, language_id, mixing, pii, quality_rules, repeats, site_style_tree, suffix_dedup, token_counts
from docketry.llm.common import find_words
from docketry.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with names that operators use inside."""
    rows = [(0, None, None, None), (1, "", "en", "s"), (2, "  \n\t ", "en", None), (3, "x" * 200_000, "en", "s"), (4, words(60, 1), "en", "s"), (4, words(60, 1), "en", "s"), (5, words(60, 1), None, "s"), (6, "a b c", "en", "s"), (7, "a b c", "de", "t"), (8, "é ñ 日本 🙂 \x00 \x1c", "fr", "s")]
    extra = ["kept", "n_entities", "language", "found_", "k", "id", "bucket", "leaked", "size", "taken", "match_", "codes"]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit("extra").alias(c) for c in extra])


OPERATORS = {
    "op1": lambda d: quality_rules.judge(d, quality_rules.fit(d, d.select("doc_id", F.lit(0).alias("quality")))),
    "op2": suffix_dedup.remove_repeats,
    "op3": lambda d: pii.replace_entities(d, "k"),
    "op4": automaton_dedup.remove_repeats,
    "op5": jaccard_join.jaccard_groups,
    "op6": lambda d: decontamination.contamination(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "op7": language_id.of_documents,
    "op8": lambda d: site_style_tree.extract_main_text(d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "kept")),
    "op9": token_counts.token_prefixes,
    "op10": lambda d: mixing.mix(d, F.length("text"), F.array("source", "lang")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_and_empty_tables(spark, odd, name):
    assert OPERATORS[name](odd).count() == odd.count()
    assert OPERATORS[name](odd.limit(0)).count() == 0


#: Queries with a row for a word or a pair, not for each row of a table; test_methods holds theirs against SQL.
OTHER_ROWS = {"op11_spelling_variants", "op13_hard_negatives"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_ROWS))
def test_queries_run_whole(spark, name):
    n = spark.read.parquet(f"{SF}/{'pages' if name.startswith('op8') or 'page' in name else 'documents'}.parquet").count()
    assert QUERIES[name](spark, SF).count() == n


# 1
def test_base_statistics():
    s = dict(zip(quality_rules.STATS, quality_rules._stats("a b c a b c\nx # y\n\nx # y\nz"), strict=True))
    assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == (13, 13, 2, 1, 12)
    text = "p q r s p q r t"
    ws = text.split()
    grams = [tuple(ws[k : k + 3]) for k in range(len(ws) - 2)]
    covered = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    assert quality_rules._repeated_words(ws) == len(covered)


def test_rules_separate_and_spare():
    r = np.random.default_rng(1)
    n = 600
    bad = r.random(n) < 0.3
    x = {k: r.normal(size=n) for k in quality_rules.FEATURES}
    x["symbol_rate"] = np.where(bad, 2 + r.random(n), r.random(n) * 0.1)
    rules = quality_rules.learn_rules(x, bad)
    assert len(rules) == 1 and "symbol_rate >" in str(rules[0])
    noise = quality_rules.learn_rules({k: r.normal(size=n) for k in quality_rules.FEATURES}, bad)
    assert not noise or all(rule.precision >= 0.9 for rule in noise)
    assert quality_rules.learn_rules({k: v[:0] for k, v in x.items()}, bad[:0]) == []


# 2 and 4
def _covered(rows, size):
    first, out = {}, {}
    for i in sorted(rows):
        for k in range(len(rows[i]) - size + 1):
            first.setdefault(rows[i][k : k + size], i)
    for i, s in rows.items():
        m = np.zeros(len(s), bool)
        for k in range(len(s) - size + 1):
            if first[s[k : k + size]] < i:
                m[k : k + size] = True
        out[i] = m
    return out


def _repeating(seed):
    r = random.Random(seed)
    passages = [words(r.randrange(10, 40), k) for k in range(6)]
    out = []
    for k in range(60):
        parts = [words(r.randrange(0, 60), 1000 + k)] + r.sample(passages, r.randrange(0, 3)) + [words(r.randrange(0, 20), 2000 + k)]
        out.append(" ".join(p for p in parts if p))
    return out + [out[3], out[3], "aaaa " * 60, "aaaa " * 61, words(30, 5)[:49], ""]


@pytest.mark.parametrize("chunk", [1 << 21, 300])
def test_word_repeats_against_brute_force(spark, monkeypatch, chunk):
    """A tiny chunk sends everything through the far stage, a large one answers much on the spot."""
    texts = _repeating(1)
    kind = repeats.Kind(repeats.word_symbols, np.uint64, 13, 5, 200, chunk)
    got = {r["doc_id"]: r for r in automaton_dedup.remove_repeats(frame(spark, texts), kind=kind).collect()}
    rows = {k: tuple(find_words(t)) for k, t in enumerate(texts)}
    for k, m in _covered(rows, 13).items():
        assert got[k]["n_removed"] == m.sum() and got[k]["kept"] == " ".join(w for w, g in zip(rows[k], m, strict=True) if not g)


@pytest.mark.parametrize("chunk", [1 << 24, 2000])
def test_byte_repeats_against_brute_force(spark, chunk):
    texts = _repeating(2)
    kind = repeats.Kind(repeats.byte_symbols, np.uint8, 50, 24, 1000, chunk)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame(spark, texts), kind=kind).collect()}
    rows = {k: t.encode() for k, t in enumerate(texts)}
    for k, m in _covered(rows, 50).items():
        kept = np.frombuffer(rows[k], np.uint8)[~m].tobytes()
        assert bytes(got[k]["kept"]) == kept and got[k]["n_removed"] == m.sum()
        assert got[k]["n_spans"] == int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())


def test_rows_without_id(spark):
    """Null ids come after all others; a copy among them goes, and what is unique stays, in the pipeline too."""
    rows = [(7, words(60, 1)), (None, words(60, 1)), (None, words(60, 2)), (None, words(60, 2)), (None, words(60, 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for op in (suffix_dedup, automaton_dedup):
        got = op.remove_repeats(docs).select("doc_id", "text", (F.col("n_removed") > 0).alias("gone")).collect()
        assert sorted((r["text"], r["gone"]) for r in got) == sorted([(words(60, 1), False), (words(60, 1), True), (words(60, 2), False), (words(60, 2), True), (words(60, 3), False)])
        assert [r["gone"] for r in got if r["doc_id"] == 7] == [False]
    kept = __import__("corpus_pipeline").one_of_near_copies(spark, docs, SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(7, words(60, 1)), (0, words(60, 2)), (0, words(60, 3))])


def test_digest_queries_hold_the_same(spark):
    for r in QUERIES["op2_suffix_array_dedup"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").where("n_removed = 0").limit(20).collect():
        assert r["kept_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_sorting_and_tries():
    r = random.Random(3)
    text = bytes(r.choice(b"ab") for _ in range(3000)) + bytes(60)
    starts = np.arange(2900)
    order, group = suffix_dedup.shallow_sort(np.frombuffer(text, np.uint8), starts)
    heads = [text[s : s + suffix_dedup.SHALLOW] for s in order]
    assert heads == sorted(heads) and all((group[k] == group[k - 1]) == (heads[k] == heads[k - 1]) for k in range(1, len(heads)))
    trie = suffix_dedup.BlindTrie()
    strings = [text[s : s + 12] for s in range(500)]
    leaves = [trie.insert(s) for s in strings]
    assert [trie.strings[k] for k in leaves] == strings and [trie.strings[k] for k in trie.ordered()] == sorted(set(strings))


def test_automaton_against_brute_force():
    r = random.Random(4)
    rows = [[r.randrange(3) for _ in range(r.randrange(5, 40))] for _ in range(30)]
    a = automaton_dedup.SuffixAutomaton()
    for k, row in enumerate(rows):
        a.add(row, k)
    a.settle()
    for row in rows + [[r.randrange(4) for _ in range(30)] for _ in range(10)]:
        want = []
        for k in range(len(row) - 4):
            owners = [o for o, x in enumerate(rows) if any(x[j : j + 5] == row[k : k + 5] for j in range(len(x) - 4))]
            want.append(min(owners, default=None))
        assert a.matches(row, 5) == want


def test_large_shards_are_cut(spark):
    rows = [np.array([7] * 6 + [k, k + 1, k % 5], np.uint64) for k in range(40)]
    b = repeats.Bundle(np.zeros(40, np.uint64), rows, np.full(40, 5), np.arange(40))
    assert all((x == y).all() for x, y in zip(automaton_dedup.smallest_holders(b, 5), automaton_dedup.smallest_holders(b, 5, most=3), strict=True))


# 3
def test_surrogates(spark):
    docs = frame(spark, ["Mail ann.Lee7@mail.example.com or ANN.LEE7@mail.example.com; call +1 (279) 555-0216 or +1-279-555-0216.", "Mrs. Jane Doe met Mr. Jo Roe and г-жа Анна Иванова; 4539 1488 0343 6467 from 10.1.2.3", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", ssn 123-45-6789', "Nothing here: 3.14, v1.2.3.4.5, 12 apples", "Mrs. Jane Doe again at +12795550216", None])
    got = {r["doc_id"]: r for r in pii.replace_entities(docs, "k").collect()}
    a, b = re.findall(r"\S+@\S+\b", got[0]["text"])
    assert a.lower() == b.lower() and a.endswith(".com") and "ann" not in a
    p, q = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1-\d{3}-\d{3}-\d{4}", got[0]["text"])
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(p) == digits(q) != "12795550216"
    assert digits(re.search(r"\+\d+", got[4]["text"])[0]) == digits(p)
    lady = re.search(r"Mrs\. (\w+ \w+)", got[1]["text"])[1]
    assert lady != "Jane Doe" and f"Mrs. {lady} again" in got[4]["text"]
    assert lady.split()[0] in pii._GIVEN["latin", "f"] and re.search(r"г-жа [А-Я][а-я]+ [А-Я]", got[1]["text"])
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", got[1]["text"])[0]
    d = [int(c) for c in digits(card)]
    assert sum(x if k % 2 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0
    assert re.search(r'token = "[0-9a-f]{40}"', got[2]["text"]) and "24be6443" not in got[2]["text"]
    assert got[3]["text"] == "Nothing here: 3.14, v1.2.3.4.5, 12 apples" and got[3]["n_entities"] == 0 and got[5]["text"] is None
    assert {r["doc_id"]: r["text"] for r in pii.replace_entities(docs, "k").collect()} == {k: r["text"] for k, r in got.items()}
    assert pii.replace_entities(docs, key="other").where("doc_id = 0").first()["text"] != got[0]["text"]


def test_collisions_are_redrawn(spark):
    """Nine hundred short numbers: many first draws collide, and some draw an entity."""
    e = spark.range(900).select(F.lit("PHONE").alias("kind"), F.format_string("%04d", F.col("id") * 7).alias("canon"), F.lit(None).cast("string").alias("hint"))
    got = pii.assign(e, "k").collect()
    assert len(got) == 900 and len({r["replacement"] for r in got}) == 900
    assert not {r["replacement"] for r in got} & {r["canon"] for r in got}


def test_full_formats_are_left(spark):
    """Formats with fewer values than entities, and values without letters and digits."""
    rows = [("EMAIL", f"{c}@x.com") for c in "abcdefghijklmnopqrstuvwxyz0123456789"] + [("PHONE", f"+1{k:04}") for k in range(7000)] + [("SECRET", c * 8) for c in "*-#."] + [("SECRET", f"{k}-------") for k in range(10)]
    rows += [(kind, f"{first}{a}{b}{c}ов") for kind, first in (("SURNAME", ""), ("GIVEN", "анна ")) for a in "абвгдежзик" for b in "лмнопрстуф" for c in "абвгдежзиклмнопрстуфхцчшщ"]
    got = pii.assign(spark.createDataFrame(rows, "kind string, canon string").withColumn("hint", F.lit("f")), "k").collect()
    assert {(r["kind"], r["canon"]) for r in got} == set(rows)
    new = {(r["kind"], r["replacement"]) for r in got}
    assert len(new) == len(rows) and not new & set(rows)
    texts = ["Password: ********", "token: --------", "Call +1 12 34", "Call +1 12 35"]
    out = pii.replace_entities(frame(spark, texts), "k").collect()
    assert all(r["n_entities"] == 1 and r["text"] != texts[r["doc_id"]] for r in out)
    m = spark.createDataFrame([("+1 12 34",)], "m string")
    assert m.select(pii.dress(F.col("m"), F.lit("PHONE"), F.lit("+1987654"))).first()[0] == "+1 98 7654"


# 5
def test_jaccard_against_brute_force(spark):
    r = random.Random(5)
    texts = [words(r.randrange(20, 120), k) for k in range(60)]
    for k in range(90):  # near copies of a few texts, some of them on the threshold
        ws = texts[k % 6].split()
        for _ in range(r.randrange(0, 4)):
            ws[r.randrange(len(ws))] = f"new{k}{r.randrange(9)}"
        texts.append(" ".join(ws))
    texts += ["one two", "one two", "one  two", "", None, "one two three"]
    found = {block: jaccard_join.jaccard_groups(frame(spark, texts), block=block, bucket_limit=limit).collect() for block, limit in ((1, 64), (2, 4), (16, 16), (768, 64))}
    got = {x["doc_id"]: x for x in found[16]}
    assert all(sorted(rows) == sorted(found[16]) for rows in found.values())
    sets = {k: frozenset(jaccard_join.shingles(t).tolist()) for k, t in enumerate(texts)}
    rep, by = {}, {}
    for k, s in sets.items():
        rep[k] = by.setdefault(s, k) if s else k
    up = {k: k for k in sets}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    links = dict.fromkeys(sets, 0)
    for a in sorted(set(rep.values())):
        for b in sorted(set(rep.values())):
            if a < b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    assert {k: (v["class_id"], v["copy_id"], v["n_links"]) for k, v in got.items()} == {k: (find(rep[k]), rep[k], links[rep[k]]) for k in sets}


# 6
def test_tiling_finds_moved_parts():
    item, doc = np.arange(1, 31), np.concatenate([np.arange(90, 99), np.arange(16, 31), [77], np.arange(1, 16), [78]])
    found = decontamination.tiles(doc, item, 5)
    assert sorted(n for _, _, n in found) == [15, 15]
    assert decontamination.tiles(doc, np.arange(200, 230), 5) == []


def test_contamination(spark):
    items = [words(30, 70 + k) for k in range(5)]
    half = items[1].split()
    docs = frame(spark, [words(100, 1), words(50, 2) + " " + items[0].upper() + " " + words(50, 3), " ".join(half[15:] + ["x"] + half[:15]), " ".join(half[:9]), None])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block in (20_000_000, 100):  # one block, and several
        got = {r["doc_id"]: (r["leak_item"], r["leaked"]) for r in decontamination.contamination(docs, bench, block_chars=block).collect()}
        assert got == {0: (None, False), 1: (0, True), 2: (1, True), 3: (1, False), 4: (None, False)}


# 7
def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs, sample=200)
    out = language_id.identify(docs, model, F.col("text"), F.lit(None), F.lit(None))
    share = out.agg(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    assert share > 0.97
    wrong = language_id.identify(docs.where("lang = 'en' and n_chars > 500").withColumn("lang", F.lit("de")), model, F.col("text"), F.col("lang"), F.col("source"))
    assert wrong.where("language = 'en'").count() == wrong.count()


def test_other_witnesses_decide_without_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("url", F.concat(F.lit("https://h.example/"), "lang", F.lit("/1")))
    more = spark.createDataFrame([(-1, "123", None, "new", 3, "https://h.example/fr/9")], docs.schema)
    model = language_id.train(docs)
    for salts in (100_000, 0):  # by broadcast, and dealt over salts
        out = language_id.identify(docs.unionByName(more), model, F.col("text"), F.col("lang"), F.col("source"), F.col("url"), broadcast_hosts=salts)
        assert out.where("doc_id = -1").first()["language"] == "fr" and out.count() == docs.count() + 1


# 8
def extracted(spark, pages, url="https://h.example/{}"):
    rows = spark.createDataFrame([(k, url.format(k) if url else None, p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in site_style_tree.extract_main_text(rows).orderBy("page_id").collect()]


def test_main_text(spark):
    page = "<html><body><header>Site</header><nav><a>Menu</a></nav><article><h1>T&amp;C</h1><p>One <b>two\nthree<br>four<p>five<div class='comments'><p>reader</div><form>sign up</form><script>x('</p>')</script></article><aside>more</aside><footer>foot"
    assert extracted(spark, [page]) == ["T&C\nOne two three\nfour\nfive"]
    assert site_style_tree.main_text(None) == "" and site_style_tree.main_text("<p") == "" and site_style_tree.main_text("plain") == "plain"


def test_style_tree_finds_the_frame(spark):
    """Pages without any telling tag: the branch that all pages of a host share goes, on that host alone."""
    page = "<body><div class=top>Our site</div><div class=a><p>{0}</p></div><div class=z>All rights</div></body>"
    rows = [(k, f"https://h.example/{k}", page.format(f"text {k}")) for k in range(6)] + [(9, "https://other.example/", page.format("alone"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (200_000, 0):
        got = {r["page_id"]: r["text"] for r in site_style_tree.extract_main_text(pages, broadcast_limit=limit).collect()}
        assert got[0] == "text 0" and got[5] == "text 5" and got[9] == "Our site\nalone\nAll rights"


# 9
def test_article_text_is_kept(spark):
    """Headings that all articles share, a body whose only class speaks of a frame, and an advert that calls itself an article."""
    soups = [f"<html><body><nav>Home</nav><article><h1>Soup {k}</h1><h2>Ingredients</h2><p>water {k}</p><h3>Method</h3><p>boil {k}</p><div>Printed for you</div></article></body></html>" for k in range(40)]
    assert extracted(spark, soups) == [f"Soup {k}\nIngredients\nwater {k}\nMethod\nboil {k}" for k in range(40)]
    assert extracted(spark, [f'<body><nav>x</nav><div class="related"><p>Body {k}</p></div></body>' for k in range(30)]) == [f"Body {k}" for k in range(30)]
    assert extracted(spark, [f"<body><nav>x {k}</nav></body>" for k in range(30)]) == [""] * 30
    adverts = [f'<body><div id=content>Real text {k}</div><article class="ad">Buy now {k}</article></body>' for k in range(30)]
    assert extracted(spark, adverts) == [f"Real text {k}" for k in range(30)]


def test_tokens_against_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["don't I'LL 'sound <|endoftext|> a<|startoftext|>b 12345 ½Ⅷ ΣΑΣ İstanbul é \x1c\x1d a\x85b\xa0c 日本語 🙂🙂 _x_ ... !!!", "", "   ", "x" * 3000]
    got = {r["doc_id"]: r for r in token_counts.token_prefixes(frame(spark, texts)).select("*", token_counts.total_tokens(F.col("prefix_tokens")).alias("n")).collect()}
    n = [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [got[k]["n"] for k in range(len(texts))] == n
    c = token_counts.counter(public_tokenizers.path("word_bpe_49k.json"))
    for w in ("internationalization", "ñandúes", "thonandwhatever"):
        assert c.closed_prefixes(w) == [len(t.encode(w[:k], add_special_tokens=False).ids) for k in range(len(w) + 1)]
    long = max(texts, key=len)
    for budget in (0, 1, 17, 300):
        cut = c.truncate(texts[0], budget)
        assert len(t.encode(cut, add_special_tokens=False).ids) <= budget and texts[0].startswith(cut)
    assert c.truncate(long[:100], 10**6) == long[:100]


# 10
def test_targets():
    got = mixing.share_out({"b": 100, "a": 100, "c": 1000, None: 10})
    assert sum(got.values()) == pytest.approx(1.5 * 1210) and got["a"] == 200 and all(got[k] <= 2 * s for k, s in {"a": 100, "b": 100, "c": 1000, None: 10}.items())


def test_flow_is_cheapest():
    """Of two patterns that could fill a quota the one that needs no repeats is used first."""
    got = mixing.route({("a",): 100, ("a", "b"): 100, ("b",): 100}, {"a": 150, "b": 150})
    assert sum(got["a",].values()) == 100 and sum(got["a", "b"].values()) == 100 and sum(got["b",].values()) == 100


def test_mix_reaches_targets(spark):
    r = random.Random(6)
    docs = spark.createDataFrame([(k, f"s{r.randrange(3)}" if k % 9 else None, r.randrange(0, 90)) for k in range(800)], "doc_id long, source string, n long")
    run = lambda: mixing.mix(docs, F.col("n"), F.array("source")).collect()
    a, b = run(), run()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 800
    taken, target = {}, {}
    for x in a:
        assert x["taken_"] in (0, x["size_"], 2 * x["size_"])
        taken[x["pattern_"]] = taken.get(x["pattern_"], 0) + x["taken_"]
        target[x["pattern_"]] = x["target_"]
    assert all(abs(taken[p] - target[p]) <= 5 for p in taken)


@pytest.mark.parametrize("at", [0, 50])
def test_one_long_document_leaves_no_gap(spark, at):
    """A document over the gap, drawn first or in mid-order, doesn't keep shorter ones out; rows of one draw go together."""
    rows = [("p", 60_000 if k == at else 500, k << 54) for k in range(101)] + [("q", 30, 5), ("q", 30, 5), ("q", 20, 9), ("q", 20, 11)]
    docs = spark.createDataFrame(rows, "pattern_ string, size_ long, draw_ long")
    wanted = spark.createDataFrame([("p", 110_000, 165_000), ("q", 100, 150)], "pattern_ string, total_ long, words_ long")
    got = {r["pattern_"]: r["n"] for r in mixing.select_words(docs, wanted, 1).groupBy("pattern_").agg(F.sum("taken_").alias("n")).collect()}
    assert got == {"p": 160_000, "q": 140}


def test_pipeline_against_brute_force(spark):
    """On the small tables every language is known, and items leak whole or not at all; so plain code can tell who stays."""
    import corpus_pipeline

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [" ".join(decontamination.tokens(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    sets = {k: frozenset(jaccard_join.shingles(r["text"]).tolist()) for k, r in docs.items()}
    up = {k: k for k in docs}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in docs:
        for b in docs:
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    stay = {k for k in docs if find(k) == k and not any(i in " ".join(decontamination.tokens(docs[k]["text"])) for i in items)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == stay and len(rows) == len(stay)
    assert all(r["size"] == len(find_words(docs[r["doc_id"]]["text"])) for r in rows)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)


def test_stages_keep_columns_and_take_odd_rows(spark, odd):
    import corpus_pipeline

    docs = odd.select("doc_id", "text", "lang", "source", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    for empty in (False, True):
        d = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            d = spark.createDataFrame(stage(spark, d, SF).collect(), docs.schema)
            assert d.columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() == d.count()
