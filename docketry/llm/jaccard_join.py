"""Jaccard join of word shingles by chosen paths.

Each document is its set of shingles (five words in a row). A run splits the sets again and again: at every node a shared hash picks
about one token of each set, and sets that hold the same picked token stay together. Sets as similar as the threshold asks stay
together with a fair chance, others part soon. A bucket that is small is compared by brute force, set by set; one that is large is split on by the next picked tokens, down to
a greatest depth. Runs repeat until the chance of having missed a pair at any depth is under the wanted bound. Candidates are then verified exactly.

What is still large at the greatest depth holds near copies that share nearly all tokens, so no token parts them; brute force would cost their square. Such sets
go by parts of their sketches and meet a few leaders instead of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import find_words, hash_words, mix, roll, stored, table
from .components import components

SKETCH = 128
#: Up to so many sets a bucket is compared by brute force.
SMALL = 64
#: From so many leaders on a bucket finds them by parts of their sketches.
MANY = 256
#: Sketch bytes that two sets of a large bucket have to share in a row to stay together; at similarity 0.8 all of the 32 rows differ by a chance of 5e-8.
BAND = 4
_rng = np.random.default_rng(20_17)
_FUNCTIONS = _rng.integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of `size` words in a row. A text with fewer words has one shingle, all its words; one without words has none."""
    words = find_words(text or "")
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(roll(hash_words(words), min(size, len(words))))


def miss_chance(threshold: float, depth: int, spread: float) -> float:
    """Chance that one run parts two sets of this similarity, the less favourable of equal sizes and one inside the other: a branching
    process whose mean is the expected number of common children of a node."""
    worst = 0.0
    for common in (spread, spread * (1 + threshold) / 2):
        stay = 1.0
        for _ in range(depth):
            stay = 1 - math.exp(-stay * common)
        worst = max(worst, 1 - stay)
    return worst


def runs_for(recall: float, threshold: float, depth: int, spread: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(miss_chance(threshold, depth, spread)))


def run_heads(runs: int) -> np.ndarray:
    """Where the paths of each run begin."""
    return mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def paths(tokens: np.ndarray, heads: np.ndarray, depth: int, threshold: float, spread: float) -> np.ndarray:
    """Hashes of the chosen paths of a set that go on from heads by `depth` tokens.

    At each node a token is picked if its hash, which all sets share, is small enough for two sets at the threshold to share `spread`
    picks of it on average."""
    limit = np.uint64(min((1 << 64) - 1, int((1 << 64) * spread * (1 + threshold) / (2 * threshold) / max(1, len(tokens)))))
    step = max(1, (1 << 18) // max(1, len(tokens)))
    for _ in range(depth):
        found = [heads[:0]]
        for at in range(0, len(heads), step):
            some = heads[at : at + step]
            node, token = np.nonzero((tokens[None, :] ^ some[:, None]) * (some[:, None] | np.uint64(1)) < limit)
            found.append(mix(some[node] * np.uint64(0xD6E8FEB86659FD93) + tokens[token]))
        heads = np.concatenate(found)
    return np.unique(heads)


def sketch(tokens: np.ndarray) -> bytes:
    """The low bytes of the smallest hashes under SKETCH functions: equal bytes estimate the similarity."""
    out = np.empty(SKETCH, np.uint8)
    step = max(1, (1 << 19) // max(1, len(tokens)))
    for at in range(0, SKETCH, step):
        out[at : at + step] = (mix2(tokens[None, :] * _FUNCTIONS[at : at + step, None]).min(1) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def mix2(x: np.ndarray) -> np.ndarray:
    """High bits folded into the low ones; enough after a multiplication by a random odd number."""
    return (x >> np.uint64(32)) | (x << np.uint64(32))


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Groups of equal values in the first column of sorted batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for b in batches:
        keys = b.column(0).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and keys[lo] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = keys[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield key, pa.Table.from_batches(held)


def _forest(ids: list[int], sketches: list[bytes], maybe: float) -> list[tuple[int, int]]:
    """All sets of a small bucket against each other: edges that make those hang together which may be similar."""
    if len(ids) == 2:
        pairs = [(0, 1)] if sum(map(int.__eq__, *sketches)) >= maybe * SKETCH else []
    else:
        m = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, SKETCH)
        same = np.count_nonzero(m[:, None, :] == m[None, :, :], axis=2) >= maybe * SKETCH
        pairs = np.argwhere(np.triu(same, 1)).tolist()
    root, out = list(range(len(ids))), []
    for i, j in pairs:
        x, y = i, j
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((ids[j], ids[i]))
    return out


class _Leaders:
    """Edges inside a bucket of many near copies. A set that resembles no leader surely becomes one. A set gets an edge to the first leader
    that it may resemble, and leaders that one set may resemble get edges to each other until they hang together. Two similar sets resemble a common
    leader, so they end in one component, and a bucket costs an edge a set, whatever its size."""

    def __init__(self, surely: float, maybe: float):
        self.surely, self.maybe, self.n = surely * SKETCH, maybe * SKETCH, 0
        self.leaders, self.ids, self.root, self.bands = np.zeros((64, SKETCH), np.uint8), [], [], {}

    def _find(self, k: int) -> int:
        root = self.root
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    def add(self, i: int, s: bytes) -> list[tuple[int, int]]:
        mine, ids, root, out = np.frombuffer(s, np.uint8), self.ids, self.root, []
        if self.n <= MANY:
            at = np.arange(self.n)
        else:  # many leaders are looked up by three bytes in a row
            at = np.array(sorted({k for p in range(0, SKETCH - 2, 3) for k in self.bands.get((p, s[p : p + 3]), ())}), np.int64)
        same = np.count_nonzero(self.leaders[at] == mine, axis=1)
        near = at[same >= self.maybe].tolist()
        if near:
            out.append((i, ids[near[0]]))
            first = self._find(near[0])
            for k in near[1:]:
                if (other := self._find(k)) != first:
                    out.append((ids[k], ids[near[0]]))
                    root[other] = first
        if not len(same) or same.max() < self.surely:
            if self.n == len(self.leaders):
                self.leaders = np.concatenate([self.leaders, np.zeros_like(self.leaders)])
            self.leaders[self.n] = mine
            ids.append(i)
            root.append(self._find(near[0]) if near else self.n)
            self.n += 1
            for k in range(self.n) if self.n == MANY + 1 else range(self.n - 1, self.n) if self.n > MANY else ():
                t = self.leaders[k].tobytes()
                for p in range(0, SKETCH - 2, 3):
                    self.bands.setdefault((p, t[p : p + 3]), []).append(k)
        return out


def _bucket_edges(batches: Iterator[pa.RecordBatch], surely: float, maybe: float) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) inside sorted buckets (bucket, id, sketch): by brute force in small ones, by leaders in those of more than SMALL sets, which stream past."""
    out: list[tuple[int, int]] = []
    key, ids, sketches, leaders = None, [], [], None

    def flushed() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])
        out.clear()
        return made

    for b in batches:
        for bucket, i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if bucket != key:
                if leaders is None and len(ids) > 1:
                    out += _forest(ids, sketches, maybe)
                key, ids, sketches, leaders = bucket, [], [], None
            if leaders is not None:
                out += leaders.add(i, s)
                continue
            ids.append(i)
            sketches.append(s)
            if len(ids) > SMALL:
                leaders = _Leaders(surely, maybe)
                for x, y in zip(ids, sketches, strict=True):
                    out += leaders.add(x, y)
                ids, sketches = [], []
        if len(out) >= 50_000:
            yield flushed()
    if leaders is None and len(ids) > 1:
        out += _forest(ids, sketches, maybe)
    yield flushed()


def overlaps(sets: list[np.ndarray], width: int = 1024) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 blocks over the tokens that two sets or more hold."""
    n = len(sets)
    tokens = np.concatenate(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    distinct, column, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    keep = counts[column] > 1
    rows, column = rows[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((n, n), np.float32)  # counts under 2**24 are exact
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        block = np.zeros((n, width), np.float32)
        block[rows[lo:hi], column[lo:hi] - at] = 1
        out += block @ block.T
    return out


def _verify(batches: Iterator[pa.RecordBatch], size: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, links) from blocks of sets (block, id, part, other, text): for each set the number of partners in the block, and an
    edge to the smallest of them (b = a if there is none smaller).

    A block holds a part of a component, part and other being equal, or two parts; of two parts only pairs across are counted, which are none where one is empty."""
    for _, rows in _sorted_groups(batches):
        ids = rows.column(1).to_numpy().astype(np.int64)
        if len(set(ids.tolist())) < len(ids):  # rows that share an id
            rows = rows.take(np.unique(ids, return_index=True)[1])
            ids = rows.column(1).to_numpy().astype(np.int64)
        part, across = rows.column(2).to_numpy(), rows.column(2)[0].as_py() != rows.column(3)[0].as_py()
        sets = [shingles(t, size) for t in rows.column(4).to_pylist()]
        sizes = np.array([len(s) for s in sets], np.float64)
        both = overlaps(sets)
        # a row at a time: J = both / (size + size - both) >= threshold
        near = np.stack([both[k].astype(np.float64) * (1 + threshold) >= threshold * (sizes[k] + sizes) - 1e-6 for k in range(len(sets))])
        np.fill_diagonal(near, False)
        if across:
            near &= part[:, None] != part[None, :]
        links = near.sum(1)
        # a spanning forest of the block: breadth first from the smallest ids
        root = np.full(len(ids), -1)
        for k in np.argsort(ids).tolist():
            if root[k] >= 0:
                continue
            root[k], todo = k, [k]
            while todo:
                x = todo.pop()
                for y in np.flatnonzero(near[x] & (root < 0)).tolist():
                    root[y] = k
                    todo.append(y)
        a, b = ids, ids[root]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], names=["a", "b", "links"])


def jaccard_groups(docs: DataFrame, size: int = 5, threshold: float = 0.8, recall: float = 0.9999, depth: int = 2, most_depth: int = 4, spread: float = 1.5, bucket_limit: int = SMALL, block: int = 768, block_shingles: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, copy_id, n_links) for every row of docs.

    copy_id is the smallest id with the same set of shingles, class_id the smallest id that links reach (of documents with
    Jaccard similarity of at least threshold, over steps), n_links the number of other sets that are linked to the document's set. Copies are one set, so they are
    never compared. A text under five words is one shingle; null texts and those without words are alone, with no links. Rows that share
    an id are one document. An empty table gives no rows. Ids are integers.

    Every pair of sets at the threshold stays together to most_depth in one run at least with the chance `recall` or more, so it meets in a small bucket or in one that can't be
    split; verification is exact. There, candidates pass by the agreement of 128 sketch bytes (threshold - 0.35 and more, ten standard deviations under a pair at the threshold). A bucket of near copies is
    streamed past its leaders, and verification splits a large component into pairs of parts of `block` sets and about block_shingles shingles, so no group is ever held whole.
    """
    runs = runs_for(recall, threshold, most_depth, spread)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = run_heads(runs)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                rows = []
                for i, t in zip(b.column(0)[at : at + 512].to_pylist(), b.column(1)[at : at + 512].to_pylist(), strict=True):
                    s = shingles(t, size)
                    if len(s):
                        rows.append((i, xxh3_128_digest(s.tobytes()), paths(s, heads, depth, threshold, spread).view(np.int64), sketch(s), len(s)))
                    else:
                        rows.append((i, None, [], None, 0))
                kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["id", "set", "paths", "sketch", "n"])

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (id, text, heads) to the paths that go one token on from heads."""
        for b in batches:
            for at in range(0, b.num_rows, 512):
                ids, found = b.column(0)[at : at + 512], []
                for t, heads in zip(b.column(1)[at : at + 512].to_pylist(), b.column(2)[at : at + 512].to_pylist(), strict=True):
                    found.append(paths(shingles(t, size), np.array(heads, np.int64).view(np.uint64), 1, threshold, spread).view(np.int64))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.list_(pa.int64()))], names=["id", "paths"])

    sets = stored(texts.mapInArrow(signs, "id bigint, set binary, paths array<bigint>, sketch binary, n int"), "sets")
    copies = stored(sets.where("set is not null").groupBy("set").agg(F.min("id").alias("copy")), "copies")
    first = sets.join(copies.select("set", F.col("copy").alias("id")), ["set", "id"], "left_semi")

    def shared(rows: DataFrame) -> DataFrame:
        """Rows (p, id) of buckets that several sets are in, with their size n."""
        sizes = rows.groupBy("p").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("p", "n")
        return stored(rows.join(sizes, "p"), "buckets")

    buckets, found = shared(first.select("id", F.explode("paths").alias("p"))), None
    kept = None
    for at in range(depth, most_depth + 1):
        small = buckets.where(F.col("n") <= bucket_limit).select(F.col("p").alias("bucket"), "id")
        found = small if found is None else found.unionByName(small)
        large = buckets.where(F.col("n") > bucket_limit)
        if at == most_depth or large.isEmpty():
            break
        heads = large.groupBy("id").agg(F.collect_set("p").alias("heads"))
        if kept is None:  # the few texts that large buckets hold are kept for the deeper splits
            kept = stored(texts.join(heads.select("id"), "id", "left_semi").dropDuplicates(["id"]), "large")
        deeper = kept.join(heads, "id").select("id", "text", "heads").mapInArrow(further, "id bigint, paths array<bigint>")
        buckets = shared(deeper.select("id", F.explode("paths").alias("p")))
    # sets that no token parts are split on the bytes of their sketches, four of them at a time; once for each set, however many of its buckets are large
    again = F.transform(F.sequence(F.lit(0), F.lit(SKETCH // BAND - 1)), lambda k: F.xxhash64(k, F.substring(F.col("sketch"), k * BAND + 1, F.lit(BAND))))
    bands = shared(first.join(large.select("id").distinct(), "id", "left_semi").select("id", F.explode(again).alias("p")))
    found = found.unionByName(bands.select(F.col("p").alias("bucket"), "id"))
    found = found.join(first.select("id", "sketch"), "id").select("bucket", "id", "sketch")
    found = found.repartition("bucket").sortWithinPartitions("bucket", "id")
    edges = found.mapInArrow(lambda b: _bucket_edges(b, threshold - 0.06, threshold - 0.35), "a bigint, b bigint")
    comps = stored(components(edges), "components").join(first.select("id", F.col("n").alias("shingles")), "id")

    # exact comparison inside the components, in blocks of one or two parts
    counts = comps.groupBy("component").agg(F.count("*").alias("n"), F.sum("shingles").alias("shingles"))
    counts = counts.select("component", F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("shingles") / block_shingles)).cast("int").alias("parts"))
    placed = comps.join(counts, "component").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # the pairs (i, j) of parts that a part takes part in
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.select("id", "part", "other", F.xxhash64("component", F.least("part", "other"), F.greatest("part", "other")).alias("block"))
    placed = stored(placed, "blocks")
    blocks = placed.join(texts, "id")
    blocks = blocks.select("block", "id", "part", "other", "text").repartition("block").sortWithinPartitions("block", "id")
    checked = stored(blocks.mapInArrow(lambda b: _verify(b, size, threshold), "a bigint, b bigint, links bigint"), "links")
    links = checked.groupBy(F.col("a").alias("copy")).agg(F.sum("links").alias("links"))
    groups = components(checked.where("a <> b").select("a", "b")).select(F.col("id").alias("copy"), F.col("component").alias("class"))
    known = copies.join(links, "copy", "left").join(groups, "copy", "left")
    out = sets.select("id", "set").join(known, "set", "left")
    own = F.coalesce("copy", "id")
    return out.select(F.col("id").alias("doc_id"), F.coalesce("class", own).alias("class_id"), own.alias("copy_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))
