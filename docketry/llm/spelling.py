"""Spelling variants of a vocabulary: which words differ by one inserted, deleted or replaced code point, and which of them each word is a variant of.

The index is cut into bit slices. For each position and letter there is a bitset over the words of a block: which of them have that letter there. All words of the block
are also the queries, read letter by letter in lockstep. Four bitsets a query are carried along: words that agree so far, and those that agree but for
one replaced, one additional or one missing letter; the slices of the same, the next and the last position move them on. So 64 words are compared by one operation.

Words meet in a block by what one error leaves alone. Of two halves of a word one error touches one, so near words share the other half. A half that very
many words share is split again: inside the part that may still differ, one half is left alone again, until one letter is open.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Words are maximal runs of these.
LETTERS = r"[A-Za-zÀ-ÿ]+"
_runs = re.compile(LETTERS).findall
_LOWER = {k: k + 32 for k in range(65, 91)}
#: Letters of the words of a block, about, and of a group of words that is split no more.
BLOCK_LETTERS, GROUP_LETTERS = 12_000, 24_000


def words_of(texts: list[str | None], ids: list, least_chars: int, drop_every: int | None) -> Counter:
    """Occurrences of the words of some texts, with A-Z lower-cased. Where drop_every divides the checksum of id and word, the word misses the letter that the checksum points at."""
    out: Counter = Counter()
    for text, i in zip(texts, ids, strict=True):
        if not text:
            continue
        head = zlib.crc32(f"{'' if i is None else i}:".encode())
        for run, n in Counter(_runs(text)).items():
            if len(run) < least_chars:
                continue
            word = run.lower() if run.isascii() else run.translate(_LOWER)
            if drop_every:
                h = zlib.crc32(word.encode(), head)
                if h % drop_every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < least_chars:
                        continue
            out[word] += n
    return out


def vocabulary(docs: DataFrame, least_chars: int = 6, least_n: int = 5, drop_every: int | None = None) -> DataFrame:
    """(word, n) of docs (doc_id, text): words of least_chars code points and least_n occurrences at least. Each task counts before the shuffle, up to a million words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                held.update(words_of(part.column(1).to_pylist(), part.column(0).to_pylist(), least_chars, drop_every))
                if len(held) > 1_000_000:
                    yield flush()
        yield flush()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def near_pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all words that differ by one inserted, deleted or replaced code point, both ways round. The words are distinct and in falling order of length."""
    n = len(words)
    sizes = np.array([len(w) for w in words])
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    letters, code = np.unique(points, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    wide = -(-n // 64)

    def bits(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), wide * 8), np.uint8)
        made = np.packbits(rows, axis=1, bitorder="little")
        out[:, : made.shape[1]] = made
        return out.view(np.uint64)

    def column(k: int) -> np.ndarray:
        """The letter of each word at a position; a number that no letter has where the word is over."""
        out = np.full(n, len(letters))
        longer = sizes > k
        out[longer] = code[starts[longer] + k]
        return out

    def slices(k: int) -> np.ndarray:
        """For each letter, the bitset of the words that have it at a position."""
        return bits(column(k)[None, :] == np.arange(len(letters))[:, None])

    equal = np.repeat(bits(np.ones((1, n), bool)), n, axis=0)
    replaced, added, missing = np.zeros_like(equal), np.zeros_like(equal), np.zeros_like(equal)
    before, here, after = np.zeros((len(letters), wide), np.uint64), slices(0), slices(1)
    for k in range(sizes[0]):
        live = int(np.searchsorted(-sizes, -k, "left"))  # queries longer than k: a front part
        q = code[starts[:live] + k]
        e, h, a = equal[:live], here[q], after[q]
        replaced[:live] = (replaced[:live] & h) | (e & ~h)
        added[:live] = (added[:live] | e) & a
        missing[:live] = (missing[:live] & before[q]) | e
        equal[:live] = e & h
        before, here, after = here, after, slices(k + 2)
    added |= equal
    lengths, which = np.unique(sizes, return_inverse=True)
    of_length = np.vstack([bits(sizes[None, :] == lengths[:, None]), np.zeros((1, wide), np.uint64)])

    def with_length(off: int) -> np.ndarray:
        at = np.searchsorted(lengths, lengths + off)
        at[at == len(lengths)] = 0
        return of_length[np.where(lengths[at] == lengths + off, at, len(lengths))[which]]

    near = (replaced & with_length(0)) | (added & with_length(1)) | (missing & with_length(-1))
    i, j = np.nonzero(near)
    found = np.unpackbits(near[i, j][:, None].view(np.uint8), axis=1, bitorder="little")
    row, bit = np.nonzero(found)
    return i[row], j[row] * 64 + bit


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (word, n, c, lo, hi) with the key of what lies outside the open part lo to hi of words of c letters (c + 1 with an additional one)."""
    after = F.col("c") - F.col("hi")
    tail = F.when(after > 0, F.expr("right(word, c - hi)")).otherwise(F.lit(""))
    return rows.withColumn("key", F.xxhash64("c", "lo", "hi", F.expr("left(word, lo)"), tail))


def _split(rows: DataFrame) -> DataFrame:
    """Both halves of the open part: one of them is left alone by an error in the other."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct(mid.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), mid.alias("hi")))
    return _keyed(rows.withColumn("half", F.explode(halves)).select("word", "n", "c", "half.lo", "half.hi"))


def _groups(words: DataFrame, group_letters: int) -> DataFrame:
    """Rows (word, n, c, key) such that near words share a key, and keys have few words: only groups with at most one open letter can be larger than group_letters."""
    c = F.explode(F.array(F.length("word"), F.length("word") - 1))
    rows = words.select("word", "n", c.alias("c")).where("c > 0").select("*", F.lit(0).alias("lo"), F.col("c").alias("hi"))
    rows, done = _split(rows), None
    while True:
        hot = rows.where("hi - lo > 1").groupBy("key").agg(F.sum(F.length("word")).alias("letters")).where(F.col("letters") > group_letters).select("key")
        hot = stored(hot, "hot")
        n = hot.count()
        if n == 0:
            return rows if done is None else done.unionByName(rows)
        # keys are numbers: a million of them are eight megabytes; beyond that both sides are shuffled
        side = F.broadcast(hot) if n <= 1_000_000 else hot
        calm = rows.join(side, "key", "left_anti")
        done = calm if done is None else done.unionByName(calm)
        rows = stored(_split(rows.join(side, "key", "left_semi")), "split")


def near_words(words: DataFrame, block_letters: int = BLOCK_LETTERS, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """(word, near, near_n) for all pairs of words (word, n) that are near, both ways round and once each."""
    rows = _groups(words, group_letters)
    letters = rows.agg(F.coalesce(F.sum(F.length("word")), F.lit(0))).first()[0]
    # very long words have blocks of their own, as a block is as wide as its longest word
    rows = rows.select(F.floor(F.log2(F.greatest("c", F.lit(64)))).cast("int").alias("width"), F.pmod("key", F.lit(max(1, -(-letters // block_letters)))).alias("block"), "word", "n")

    def run(t: pa.Table) -> pa.Table:
        n = dict(zip(t.column("word").to_pylist(), t.column("n").to_pylist(), strict=True))
        known = sorted(n, key=lambda w: (-len(w), w))
        i, j = near_pairs(known)
        names, counts = pa.array(known, pa.string()), pa.array([n[w] for w in known], pa.int64())
        i, j = pa.array(i, pa.int64()), pa.array(j, pa.int64())
        return pa.table({"word": names.take(i), "near": names.take(j), "near_n": counts.take(j)})

    pairs = rows.groupBy("width", "block").applyInArrow(run, "word string, near string, near_n long")
    return pairs.groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where following forms ends. Each turn doubles the steps; forms rise in frequency, so there are no circles and few turns."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(words: DataFrame, ratio: int = 5, **sizes: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct words (word, n).

    A word's form is the most frequent of its near words (of equals the first in code-point order) if it is `ratio` times as frequent as the word or more. Following forms leads to its root; a word
    without a form is its own root. No words give no rows.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(words, **sizes).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    out = words.join(near, "word", "left").withColumn("best_n", -F.col("best.minus"))
    has = F.col("best_n") >= ratio * F.col("n")
    out = stored(out.select("word", F.when(has, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(out.where(F.col("form").isNotNull()))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have no words, and a null doc_id is written as nothing before the colon. Repeated rows count each; texts and words of any length are read whole."""
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents"), drop_every=199))
