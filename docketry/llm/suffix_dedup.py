"""Removal of byte strings that repeat across documents, by deep-shallow suffix sorting.

Suffixes that may repeat meet in buckets (see repeats.py). There they are sorted by multikey quicksort, whose symbols are eight bytes,
to a shallow depth; most suffixes are told apart by then. Groups that still agree have long common prefixes, and blind tries order them: a trie
keeps only the places where its strings part, so a string goes down by single bytes and is compared with one leaf. Neighbours in the finished order whose common
prefix reaches a window make runs, and the smallest id of a run is the first holder of its window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, with_columns
from .repeats import BYTES, Bundle, Kind, covered_windows, keyed, mask

SHALLOW = 16
#: Parts up to this size are sorted at once instead of being split.
TINY = 24


def shallow_sort(text: np.ndarray, starts: np.ndarray, depth: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): the suffixes at `starts` ordered by their first `depth` bytes, with equal ones in one group.

    Multikey quicksort with symbols of eight bytes: a part is split in three by a pivot symbol, the median of three; the smaller and the larger ones are split on by the same
    symbol, the equal ones by their next; tiny parts are sorted outright. All parts are split at once, so a round is a few passes over the suffixes that are still in parts of two and more. text must reach depth
    bytes past every start, and depth is a multiple of eight."""
    n = len(starts)
    order, group = np.arange(n), np.zeros(n, np.int64)
    if depth < 8 or n < 2:
        return order, group
    words = np.lib.stride_tricks.sliding_window_view(text, 8)

    def symbols(of: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(words[starts[of] + at]).view(">u8").reshape(-1).astype(np.uint64)

    def places(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = np.repeat(np.arange(len(begin)), size)
        return part, np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size) + begin[part]

    begin, size, at = np.array([0]), np.array([n]), np.array([0])  # parts: where they lie, and the depth of their symbol
    symbol = symbols(order, np.zeros(n, np.int64))
    ends = [begin]  # where finished parts begin
    while len(begin):
        tiny = size <= TINY
        equal = []  # (begin, size, depth) of parts whose symbols are equal
        if tiny.any():
            part, place = places(begin[tiny], size[tiny])
            step = np.lexsort((symbol[place], part))
            order[place], symbol[place] = order[place[step]], symbol[place[step]]
            new = np.ones(len(place), bool)
            new[1:] = (part[1:] != part[:-1]) | (symbol[place[1:]] != symbol[place[:-1]])
            heads = np.flatnonzero(new)
            ends.append(place[heads])
            equal.append((place[heads], np.diff(np.append(heads, len(place))), at[tiny][part[heads]] + 8))
        begin, size, at = begin[~tiny], size[~tiny], at[~tiny]
        unequal = []
        if len(begin):
            a, b, c = symbol[begin], symbol[begin + size // 2], symbol[begin + size - 1]
            pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
            part, place = places(begin, size)
            own, by = symbol[place], pivot[part]
            # what is smaller goes to the front of its part, what is equal behind it, what is larger to the end, each in the order in which it stood
            kinds, first = (own < by, own == by, own > by), np.cumsum(size) - size
            counts = [np.add.reduceat(k, first, dtype=np.int64) for k in kinds]
            heads = (begin, begin + counts[0], begin + counts[0] + counts[1])
            target = np.empty(len(place), np.int64)
            for kind, head in zip(kinds, heads, strict=True):
                run = np.cumsum(kind)
                target[kind] = (head - 1 - run[first] + kind[first])[part[kind]] + run[kind]
            order[target], symbol[target] = order[place], own
            ends += [h[c > 0] for h, c in zip(heads, counts, strict=True)]
            equal.append((heads[1], counts[1], at + 8))
            unequal = [(heads[0], counts[0], at), (heads[2], counts[2], at)]
        begin, size, at = (np.concatenate(x) for x in zip(*equal, strict=True))
        going = (size > 1) & (at < depth)
        begin, size, at = begin[going], size[going], at[going]
        if len(begin):  # equal ones go on with their next symbol
            part, place = places(begin, size)
            symbol[place] = symbols(order[place], at[part])
        begin, size, at = (np.concatenate([x, *y]) for x, y in zip((begin, size, at), zip(*unequal, strict=True) if unequal else [[]] * 3, strict=True))
        begin, size, at = (x[size > 1] for x in (begin, size, at))
    marks = np.zeros(n, np.int64)
    marks[np.unique(np.concatenate(ends))] = 1
    return order, np.cumsum(marks) - 1


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    if a == b:
        return len(a)
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


class BlindTrie:
    """Strings of one length; a node is [depth, children by byte], a leaf the number of its string."""

    def __init__(self) -> None:
        self.root: list | int | None = None
        self.strings: list[bytes] = []

    def insert(self, s: bytes) -> int:
        """The leaf of s, an earlier one if the string is known."""
        strings = self.strings
        if self.root is None:
            self.root = 0
            strings.append(s)
            return 0
        node = self.root
        while type(node) is list:  # down by the branching bytes alone; any child where none fits
            node = node[1].get(s[node[0]]) if s[node[0]] in node[1] else next(iter(node[1].values()))
        depth = _common(s, strings[node])
        if depth == len(s):
            return node
        leaf = len(strings)
        strings.append(s)
        other = strings[node][depth]
        above, node = None, self.root
        while type(node) is list and node[0] < depth:
            above, node = (node, s[node[0]]), node[1][s[node[0]]]
        if type(node) is list and node[0] == depth:
            node[1][s[depth]] = leaf
            return leaf
        new = [depth, {other: node, s[depth]: leaf}]
        if above is None:
            self.root = new
        else:
            above[0][1][above[1]] = new
        return leaf

    def ordered(self) -> list[int]:
        """Leaves in the order of their strings."""
        out, todo = [], [] if self.root is None else [self.root]
        while todo:
            node = todo.pop()
            if type(node) is list:
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def sort_windows(text: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): the windows at `starts` in the order of their bytes, and for each place in it whether a run of equal windows begins there, that is whether the common prefix
    with the one before is shorter than a window."""
    order, group = shallow_sort(text, starts, min(SHALLOW, window) // 8 * 8)
    begins = np.ones(len(order), bool)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]) if len(group) else np.zeros(1, int)
    raw, many = text.tobytes(), np.flatnonzero(np.diff(cuts) > 1)
    for lo, hi in zip(cuts[many].tolist(), cuts[many + 1].tolist(), strict=True):
        trie = BlindTrie()
        leaves = [trie.insert(raw[s : s + window]) for s in starts[order[lo:hi]].tolist()]
        rank = {leaf: k for k, leaf in enumerate(trie.ordered())}
        ranks = np.array([rank[leaf] for leaf in leaves])
        step = np.argsort(ranks, kind="stable")
        order[lo:hi] = order[lo:hi][step]
        begins[lo + 1 : hi] = np.diff(ranks[step]) > 0
    return order, begins


def smallest_holders(bundle: Bundle, window: int) -> list[np.ndarray]:
    """For each window of each stretch the smallest id of those that hold the window, by sorting the suffixes at the windows."""
    sizes = np.array([len(s) for s in bundle.symbols])
    text = np.concatenate([*bundle.symbols, np.zeros(SHALLOW, np.uint8)])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(sizes)), bundle.windows)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(bundle.windows) - bundle.windows, bundle.windows)
    order, begin = sort_windows(text, begins[owner] + inner, window)
    first = np.flatnonzero(begin)
    least = np.empty(len(order), np.int64)
    ids = bundle.smallest[owner[order]]
    least[order] = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(order))))
    return np.split(least, np.cumsum(bundle.windows)[:-1])


def remove_repeats(docs: DataFrame, window: int = 50, kind: Kind = BYTES, bucket_symbols: int = 5_000_000) -> DataFrame:
    """(doc_id, text, n_bytes, n_removed, n_spans, kept binary) for every row of docs (doc_id, text).

    Every byte goes that lies in a string of `window` bytes which also starts in a document with a smaller id; strings are judged on the
    input. Null texts count as empty; texts under `window` bytes stay whole; of equal texts the one with the smallest id stays. Rows that share an id are one document as to
    others and keep what they repeat among themselves. kept may end inside a character. Other columns are not read. Rows with a null doc_id are documents of
    their own, after all others.
    """
    kind = Kind(kind.symbols, kind.dtype, window, min(kind.gram, window), kind.piece, kind.chunk)
    docs = keyed(docs.select(F.col("doc_id"), F.col("text")))
    spans = covered_windows(docs.select(F.col("__key").alias("id"), "text"), kind, lambda b: smallest_holders(b, window), bucket_symbols)
    rows = docs.join(spans.withColumnRenamed("id", "__key"), "__key", "left").drop("__key")

    def work(columns):
        out = [[], [], [], []]
        for text, covered in zip(*(c.to_pylist() for c in columns), strict=True):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            gone = mask(len(raw), covered)
            edge = np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1
            for o, v in zip(out, (len(raw), int(gone.sum()), int(edge.sum()), raw[~gone].tobytes()), strict=True):
                o.append(v)
        return [pa.array(o, k) for o, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]

    return with_columns(rows, ["text", "covered"], "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", work).drop("covered")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
