"""Spelling variants, k-d shards and hard negatives against plain code, and the odd tables that each must take."""

import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from docketry.llm import hard_negatives, sharding, spelling

SF = "/root/testdata/sf0.001"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words, ratio=5):
    known, out = sorted(words), {}
    for w in known:
        found = [v for v in known if near(w, v)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= ratio * words[w] else None, len(found))
    rows = set()
    for w in known:
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, out[w][0], root, words[w], out[w][1], words[out[w][0]] if out[w][0] else None))
    return rows


def made_words(seed, n, letters="abé", least=6, most=9):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.randrange(least, most))) for _ in range(n)}
    return {w: r.choice([5, 6, 30, 31, 200, 5000, 200_000]) for w in words}


def test_bit_slices_against_all_pairs():
    for seed, n, most in [(1, 1, 8), (2, 70, 8), (3, 300, 10), (4, 129, 70)]:
        words = sorted(made_words(seed, n, most=most), key=lambda w: (-len(w), w))
        i, j = spelling.near_pairs(words)
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(a, b) for a in range(len(words)) for b in range(len(words)) if near(words[a], words[b])]


@pytest.mark.parametrize("sizes", [{}, {"block_letters": 60, "group_letters": 30}])
def test_variants_against_all_pairs(spark, sizes):
    words = made_words(7, 260) | {"x" * 90: 5, "x" * 91: 500, "y" * 6: 5}
    got = spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"), **sizes)
    assert {tuple(r) for r in got.collect()} == plain_variants(words)


def test_a_shared_stem_is_split(spark):
    """A stem that all words share is no large group: what may differ is split until groups are small."""
    words = {f"stemstemstem{k:04b}{k * 7919 % 997:03d}".translate(str.maketrans("0123456789", "abcdefghij")): 5 + k for k in range(400)}
    rows = spelling._groups(spark.createDataFrame(list(words.items()), "word string, n long"), 200)
    assert rows.groupBy("key").agg(F.sum(F.length("word")).alias("n")).agg(F.max("n")).first()[0] <= 2000
    got = spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"), group_letters=200)
    assert {tuple(r) for r in got.collect()} == plain_variants(words)


def test_vocabulary(spark):
    texts = ["Wander wander WANDER÷wander. Élan élan", None, "", "abcdef " * 7 + "ABCDEF", "z" * 300_000 + " éééééé", "abcdef2abcdef", "wander wander"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "wander wander"), (3, texts[3]), (3, texts[3])]
    for every in (None, 3, 1):
        want = Counter()
        for i, t in rows:
            run = ""
            for c in (t or "") + "\n":
                if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                    run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                    continue
                if run:
                    h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                    if every and h % every == 0:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                    want[run] += 1
                run = ""
        got = spelling.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"), least_n=2, drop_every=every)
        assert {tuple(r) for r in got.collect()} == {(w, n) for w, n in want.items() if len(w) >= 6 and n >= 2}


def test_variants_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, word string, n long")
    assert spelling.spelling_variants(spelling.vocabulary(empty)).count() == 0
    some = spark.createDataFrame([(1, "abcdef " * 5, "w", 3)], "doc_id long, text string, word string, n long")
    assert [tuple(r) for r in spelling.spelling_variants(spelling.vocabulary(some)).collect()] == [("abcdef", None, "abcdef", 5, 0, None)]


def plain_tree(rows, leaves, first=0):
    """rows (id, size, x, y) without ties: shard of each id."""
    if leaves == 1:
        return {r[0]: first for r in rows}
    top = [max(r[d] for r in ALL) - min(r[d] for r in ALL) for d in (2, 3)]
    spread = [(max(r[d] for r in rows) - min(r[d] for r in rows)) / top[d - 2] for d in (2, 3)]
    d = 2 if spread[0] >= spread[1] else 3
    rows = sorted(rows, key=lambda r: r[d])
    goal, sums = Fraction(sum(r[1] for r in rows) * (leaves // 2), leaves), [0]
    for r in rows:
        sums.append(sums[-1] + r[1])
    cut = min(range(len(sums)), key=lambda k: (abs(sums[k] - goal), k))
    return plain_tree(rows[:cut], leaves // 2, first) | plain_tree(rows[cut:], leaves - leaves // 2, first + leaves // 2)


ALL = []


@pytest.mark.parametrize(("few", "leaves"), [(20_000, 16), (3, 7), (1, 4)])
def test_tree_against_plain_cuts(spark, monkeypatch, few, leaves):
    monkeypatch.setattr(sharding, "FEW", few)
    r = random.Random(leaves)
    xs, ys = r.sample(range(10_000), 600), r.sample(range(100_000), 600)
    ALL[:] = [(k, r.choice([1, 5, 40, 41, 300, 2500]), xs[k], ys[k] + 0.5) for k in range(600)]
    got = sharding.kd_tree(spark.createDataFrame(ALL, "id long, size long, x int, y double"), ["x", "y"], "size", leaves=leaves).collect()
    assert {g["id"]: g["shard"] for g in got} == plain_tree(ALL, leaves)
    for k in range(leaves):
        assert sorted(g["slot"] for g in got if g["shard"] == k) == list(range(sum(g["shard"] == k for g in got)))


@pytest.mark.parametrize("few", [20_000, 1])
def test_equal_rows_are_cut_too(spark, monkeypatch, few):
    """A third of the rows are one row, a third share a source; shards still miss their part by little, and reruns agree."""
    monkeypatch.setattr(sharding, "FEW", few)
    rows = [(1, "same", 10)] * 400 + [(k, "hot", 10) for k in range(400)] + [(None if k % 9 == 0 else k, None if k % 7 == 0 else f"s{k % 50}", 7 + k % 5) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, bytes long")
    got = [tuple(r) for r in sharding.kd_tree(df, ["source", "doc_id"], "bytes", leaves=8).collect()]
    total = sum(r[2] for r in rows)
    sums = Counter()
    for r in got:
        sums[r[3]] += r[2]
    assert len(got) == 1200 and all(abs(sums[k] - total / 8) <= 15 for k in range(8))
    again = sharding.kd_tree(df.repartition(5), ["source", "doc_id"], "bytes", leaves=8)
    assert Counter(got) == Counter(tuple(r) for r in again.collect())


def test_hot_buckets_of_slots(spark, monkeypatch):
    rows = spark.range(500).select(F.struct("id").alias("row"), F.when(F.col("id") < 400, 7).otherwise(F.col("id") * 8_000_000).cast("long").alias("tie"), F.col("id").alias("number"), (F.col("id") % 3).cast("int").alias("shard"))
    got = sharding.numbered(rows, bucket_rows=10).collect()
    for k in range(3):
        assert sorted(g["slot"] for g in got if g["shard"] == k) == list(range(len([g for g in got if g["shard"] == k])))


def test_shards_of_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, shard string, row string, number long, n double, k0 string"
    odd = [(None, None, "x", None, 1, float("nan"), "a"), (1, "", None, "r", None, float("inf"), None), (1, "", None, "r", None, float("-inf"), None), (2, "é" * 100_000, "y", "r", 2, 1.5, "b"), (2, "é" * 100_000, "y", "r", 2, 1.5, "b")]
    df = spark.createDataFrame(odd, schema).withColumn("size", F.octet_length("text"))
    out = sharding.kd_tree(df, ["n", "row", "number"], "size", leaves=4)
    assert out.columns == ["doc_id", "text", "row", "number", "n", "k0", "size", "shard", "slot"] and out.count() == 5
    assert Counter(out.where("doc_id = 2").select("shard").collect()).most_common(1)[0][1] == 1  # the two large rows part
    assert sharding.kd_tree(df.limit(0), ["n", "row"], "size", target=10).count() == 0
    by_target = sharding.kd_tree(df, ["doc_id"], "size", target=150_000)
    assert by_target.agg(F.max("shard")).first()[0] <= 2
    sharding.write_shards(by_target, f"{tmp_path}/shards", 2)
    assert spark.read.parquet(f"{tmp_path}/shards").count() == 5


def test_query_of_shards(spark):
    got = sharding.op12_kd_sharding(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    text = {r.doc_id: (r.text or "").encode() for r in docs.itertuples()}
    assert all(r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in got.itertuples(index=False) for r in [r._replace(size=r[1])])
    sums = got.groupby("shard")["size"].sum()
    assert abs(sums - got["size"].sum() / 16).max() <= got["size"].max()


def plain_negatives(rows, scale=256):
    """rows (id, label, whole vector)."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = Counter()
    anchors = {}
    for i, label, v in rows:
        if i % 10 == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for i, (label, v) in anchors.items():
        others = [(-score(v, w), j, m) for j, m, w in rows if j != i]
        for s, p, _ in sorted(o for o in others if o[2] == label)[:5]:
            fits = sorted(o for o in others if o[2] != label and 80 * -s <= 100 * -o[0] <= 100 * -s)[:5]
            for k, (t, n, _) in enumerate(fits):
                out[i, p, k + 1, n, -s, -t] += 1
    return out


@pytest.mark.parametrize("block_bytes", [1 << 25, 300])
@pytest.mark.parametrize("block_rows", [4096, 7])
def test_negatives_against_plain_scores(spark, monkeypatch, block_bytes, block_rows):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    r = random.Random(3)
    hot = [0.25] * 12
    rows = [(k, r.randrange(3), hot if k % 3 == 0 else [r.uniform(-1, 1) + 0.2 for _ in range(12)]) for k in range(150)]
    rows += [rows[5], rows[7], (20, 0, hot), (20, 0, hot), (200, 2, [1.0]), (201, 1, hot + [900.0] * 3), (210, 77, hot)]
    bad = [(None, 1, hot), (300, None, hot), (310, 1, None), (320, 1, [1.0, None]), (330, 1, [float("nan")]), (340, 1, [float("inf")]), (350, 1, []), (360, 1, [1e9])]
    df = spark.createDataFrame([(*x, "extra", "extra") for x in rows + bad], "id long, label int, vector array<float>, score string, anchor_id string").repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("id") % 10 == 0, block_bytes=block_bytes)
    whole = [(i, m, [int(256 * x // 1) for x in spark_floats(v)]) for i, m, v in rows]
    assert Counter(tuple(x) for x in got.collect()) == plain_negatives(whole)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(False)).count() == 0


def spark_floats(v):
    import numpy as np

    return [float(np.float32(x)) for x in v]


def test_bounds_drop_rows_early():
    """Rows that can't be among the first leave before the last columns are read, and the first stay."""
    import numpy as np

    r = np.random.default_rng(5)
    columns = r.integers(-20, 20, (64, 3000)).astype(float)
    columns[:, :40] += 60
    anchor = r.integers(50, 60, 64).astype(float)
    left = []

    def admit(low, high):
        left.append(len(low))
        return high >= np.partition(low, -5)[-5]

    order = np.argsort(-np.abs(anchor), kind="stable")
    rows, scores = hard_negatives.vertical(columns, columns.min(1), columns.max(1), anchor, order, np.arange(3000), admit)
    assert left[-1] < 300 < left[0]
    whole = anchor @ columns
    assert set(np.argsort(-whole)[:5]) <= set(rows.tolist()) and np.array_equal(scores, whole[rows])
