"""Benchmark decontamination by greedy string tiling.

Words that a document shares with a test item are tiled: the longest common run that is still unmarked on both sides is marked
first, then the next, down to a least length, each round finding its runs by a running Karp-Rabin hash. As tiles may lie in any
order, a passage whose parts were moved is covered like one in order. An item leaks where its tiles cover enough of it.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_words, roll, stored, table, with_columns

_tokens = re.compile(r"\w+").findall


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits."""
    return _tokens(text.lower()) if text else []


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two rows of token codes: (start in doc, start in item, length), lengths of `least` and more."""
    free_d, free_i, out = np.ones(len(doc), bool), np.ones(len(item), bool), []
    size = max(least, min(len(item), len(doc)) // 2)
    while True:
        found, longest = [], 0
        if size <= min(len(doc), len(item)):
            hi, hd = roll(item, size), roll(doc, size)
            at: dict[int, list[int]] = {}
            for j in np.flatnonzero(np.lib.stride_tricks.sliding_window_view(free_i, size).all(1)).tolist():
                at.setdefault(int(hi[j]), []).append(j)
            shared = np.flatnonzero(np.isin(hd, np.fromiter(at, np.uint64, len(at))) & np.lib.stride_tricks.sliding_window_view(free_d, size).all(1)) if at else []
            for i in np.asarray(shared).tolist():
                for j in at[int(hd[i])]:
                    if i and j and free_d[i - 1] and free_i[j - 1] and doc[i - 1] == item[j - 1]:
                        continue  # this run was met one token earlier
                    n = 0
                    while i + n < len(doc) and j + n < len(item) and free_d[i + n] and free_i[j + n] and doc[i + n] == item[j + n]:
                        n += 1
                    if n >= size:
                        found.append((n, i, j))
                        longest = max(longest, n)
        if longest > 2 * size:  # a much longer run: begin with its length
            size = longest
            continue
        found.sort(key=lambda t: (-t[0], t[1], t[2]))
        marked = blocked = False
        for n, i, j in found:
            if free_d[i : i + n].all() and free_i[j : j + n].all():
                free_d[i : i + n] = free_i[j : j + n] = False
                out.append((i, j, n))
                marked = True
            else:
                blocked = True
        if marked and blocked:
            continue  # what longer tiles leave of the blocked runs is looked for once more
        if size == least:
            return out
        size = max(least, size // 2)


class _Items:
    """Test items, prepared for look-up by their seeds (hashes of `least` tokens in a row)."""

    def __init__(self, rows: list[tuple[int | None, str]], least: int):
        # items by place: rows that share an id, and rows without one, are items of their own
        rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.ids = [i for i, _ in rows]
        words = {k: tokens(t) for k, (_, t) in enumerate(rows)}
        self.items = {i: w for i, w in words.items() if len(w) >= least}
        self.vocab = {w: k for k, w in enumerate(sorted({w for ws in self.items.values() for w in ws}), 1)}
        hashes = dict(zip(self.vocab, hash_words(list(self.vocab)).tolist(), strict=True))
        self.value = np.zeros(len(self.vocab) + 1, np.uint64)
        for w, k in self.vocab.items():
            self.value[k] = hashes[w]
        self.codes = {i: np.array([self.vocab[w] for w in ws], np.int64) for i, ws in self.items.items()}
        self.seeds: dict[int, set[int]] = {}
        for i, codes in self.codes.items():
            for h in roll(self.value[codes], least).tolist():
                self.seeds.setdefault(h, set()).add(i)
        self.sorted = np.sort(np.fromiter(self.seeds, np.uint64, len(self.seeds)))
        self.least = least

    def cover(self, text: str | None) -> tuple[int | None, float, int]:
        """(place of the item covered most, covered share of it, number of tiles)."""
        words = tokens(text)
        if len(words) < self.least or not len(self.sorted):
            return None, 0.0, 0
        codes = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))
        strange = np.flatnonzero(codes == 0)
        runs = np.diff(np.concatenate([[-1], strange, [len(codes)]]))
        if runs.max() <= self.least:  # no seed's length of known words in a row
            return None, 0.0, 0
        h = roll(self.value[codes], self.least)
        away = np.cumsum(np.concatenate([[0], codes == 0]))
        at = np.flatnonzero(away[self.least :] == away[: -self.least])
        k = np.minimum(np.searchsorted(self.sorted, h[at]), len(self.sorted) - 1)
        at = at[self.sorted[k] == h[at]]
        hits: dict[int, list[int]] = {}
        for p in at.tolist():
            for i in self.seeds[int(h[p])]:
                hits.setdefault(i, []).append(p)
        best: tuple[int | None, float, int] = (None, 0.0, 0)
        for i in sorted(hits):
            # only what lies under a seed can be tiled; a negative code parts the stretches
            covered = np.zeros(len(codes), bool)
            for p in hits[i]:
                covered[p : p + self.least] = True
            gap = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8)])) == 1)
            part = np.insert(codes[covered], np.searchsorted(np.flatnonzero(covered), gap), -1)
            if len(np.intersect1d(part, self.codes[i])) == 0:
                continue
            found = tiles(part, self.codes[i], self.least)
            share = sum(n for _, _, n in found) / len(self.codes[i])
            if share > best[1]:
                best = (i, share, len(found))
        return best


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.5, block_chars: int = 2_000_000, text_col: str = "text") -> DataFrame:
    """docs with leak_item (the benchmark item that tiles cover most; the smallest id of equals; null if none), leak_cover (its
    covered share), leak_tiles and leaked (leak_cover >= threshold).

    A benchmark of up to block_chars characters goes out whole, and nothing is shuffled. A larger one goes in blocks of about that size, each in a pass of its own
    over the documents whose hits (rows, not texts) are stored before the next block goes out; so no executor ever holds two blocks. A block takes about 60 bytes a
    character in each Python worker. An item longer than a block is a block. Items of under `least` tokens (null ones too) can't be
    told from chance and are left out. Items that share an id but not a text are judged each; an item without an id leaks with a null leak_item. Null
    and empty documents leak nothing; repeated rows are judged each.
    """
    sized = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = sized.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_chars))
    sc = docs.sparkSession.sparkContext
    fields = "leak_item bigint, leak_cover double, leak_tiles int"

    def judged(rows: DataFrame, k: int):
        items = [(r["item_id"], r["text"]) for r in sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]
        given = sc.broadcast(_Items(items, least))

        def work(columns):
            found = [given.value.cover(t) for t in columns[0].to_pylist()]
            ids = given.value.ids
            return [pa.array([None if i is None else ids[i] for i, _, _ in found], pa.int64()), pa.array([c for _, c, _ in found], pa.float64()), pa.array([n for _, _, n in found], pa.int32())]

        return with_columns(rows, [text_col], fields, work), given

    if blocks == 1:
        out, _ = judged(docs, 0)
    else:
        # rows get a number that stays, as they are written once
        rows, hits = stored(docs.withColumn("__leak_row", F.monotonically_increasing_id()), "numbered"), None
        for k in range(blocks):
            found, given = judged(rows.select("__leak_row", text_col), k)
            found = stored(found.where("leak_cover > 0").select("__leak_row", "leak_item", "leak_cover", "leak_tiles"), "hits")
            given.unpersist()
            hits = found if hits is None else hits.unionByName(found)
        first = F.max_by(F.struct("leak_item", "leak_cover", "leak_tiles"), F.struct("leak_cover", -F.coalesce("leak_item", F.lit((1 << 63) - 1))))
        hits = hits.groupBy("__leak_row").agg(first.alias("__leak"))
        out = rows.drop("leak_item", "leak_cover", "leak_tiles").join(hits, "__leak_row", "left").drop("__leak_row")
        out = out.withColumns({"leak_item": F.col("__leak.leak_item"), "leak_cover": F.coalesce("__leak.leak_cover", F.lit(0.0)), "leak_tiles": F.coalesce("__leak.leak_tiles", F.lit(0))}).drop("__leak")
    return out.withColumn("leaked", F.col("leak_cover") >= threshold)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = contamination(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "leak_item", F.round("leak_cover", 6).alias("leak_cover"), "leak_tiles", "leaked")
