"""Removal of word windows that repeat across documents, by suffix automata.

The reference, all passages that may repeat (see repeats.py), is cut into shards of bounded size. A shard's passages make one suffix automaton, and the
passages are streamed through it; the matching statistics say how long a match ends at each word and which documents have it.
Shards are dealt by anchors instead of being broadcast: here every document is a reference for every other, so sending every shard to every document would cost
documents times shards. A passage meets the one shard that can hold its windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import find_words, table, with_columns
from .repeats import WORDS, Bundle, Kind, covered_windows, keyed, mask


class SuffixAutomaton:
    """Of several rows of symbols; every state knows the smallest owner of the rows that hold its strings."""

    def __init__(self) -> None:
        self.length, self.link, self.next, self.least = [0], [-1], [{}], [None]

    def _clone(self, of: int, length: int) -> int:
        self.length.append(length)
        self.link.append(self.link[of])
        self.next.append(self.next[of].copy())
        self.least.append(None)
        return len(self.length) - 1

    def add(self, row: list[int], owner: int) -> None:
        length, link, nxt, least = self.length, self.link, self.next, self.least
        last = 0
        for c in row:
            known = nxt[last].get(c)
            if known is not None:
                if length[known] == length[last] + 1:
                    last = known
                else:
                    copy = self._clone(known, length[last] + 1)
                    link[known] = copy
                    p = last
                    while p >= 0 and nxt[p].get(c) == known:
                        nxt[p][c] = copy
                        p = link[p]
                    last = copy
            else:
                length.append(length[last] + 1)
                link.append(0)
                nxt.append({})
                least.append(None)
                new, p = len(length) - 1, last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    if length[q] == length[p] + 1:
                        link[new] = q
                    else:
                        copy = self._clone(q, length[p] + 1)
                        while p >= 0 and nxt[p].get(c) == q:
                            nxt[p][c] = copy
                            p = link[p]
                        link[q] = link[new] = copy
                last = new
            if least[last] is None or owner < least[last]:
                least[last] = owner

    def settle(self) -> None:
        """Owners go up the suffix links, from long states to short ones. Call it once, after the last row; clones get theirs here."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            p, o = self.link[s], self.least[s]
            if p > 0 and o is not None and (self.least[p] is None or o < self.least[p]):
                self.least[p] = o

    def matches(self, row: list[int], size: int) -> list[int | None]:
        """For each window of `size` symbols that ends in row the smallest owner of it, None where no row holds it."""
        state, n, out = 0, 0, []
        for k, c in enumerate(row):
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                n += 1
            if k >= size - 1:
                s = state
                if n >= size:
                    while self.length[self.link[s]] >= size:
                        s = self.link[s]
                    out.append(self.least[s])
                else:
                    out.append(None)
        return out


def _stream(rows: list[list[int]], owners: list[int], window: int) -> list[np.ndarray]:
    """The smallest owner of each window of each row, by one automaton of them all."""
    a = SuffixAutomaton()
    for r, o in zip(rows, owners, strict=True):
        a.add(r, o)
    a.settle()
    return [np.array(a.matches(r, window), np.int64) for r in rows]


def smallest_holders(bundle: Bundle, window: int, most: int = 40_000) -> list[np.ndarray]:
    """For each window of each stretch the smallest id of those that hold it.

    Whole anchors fill a shard up to about `most` symbols, which bounds the memory of an automaton. An anchor of more (a common phrase amid different words) is cut
    into shards by the windows' own hashes; equal windows stay together."""
    out: list[np.ndarray | None] = [None] * len(bundle.symbols)
    cuts = np.concatenate([[0], np.flatnonzero(bundle.anchors[1:] != bundle.anchors[:-1]) + 1, [len(bundle.anchors)]])
    sizes = np.concatenate([[0], np.cumsum([len(r) for r in bundle.symbols])])
    held: list[int] = []

    def answered() -> None:
        if held:
            found = _stream([bundle.symbols[k].tolist() for k in held], bundle.smallest[held].tolist(), window)
            for k, x in zip(held, found, strict=True):
                out[k] = x
            held.clear()

    filled = 0
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        n = int(sizes[hi] - sizes[lo])
        if n <= most:
            if filled + n > most:
                answered()
                filled = 0
            held += range(lo, hi)
            filled += n
            continue
        shards = -(-n * window // most)
        placed: dict[int, list[tuple[int, int]]] = {}
        for k in range(lo, hi):
            row = bundle.symbols[k]
            out[k] = np.zeros(len(row) - window + 1, np.int64)
            for s in range(len(row) - window + 1):
                placed.setdefault(xxh3_64_intdigest(row[s : s + window].tobytes()) % shards, []).append((k, s))
        for shard in placed.values():
            found = _stream([bundle.symbols[k][s : s + window].tolist() for k, s in shard], [int(bundle.smallest[k]) for k, _ in shard], window)
            for (k, s), x in zip(shard, found, strict=True):
                out[k][s] = x[0]
    answered()
    return out


def remove_repeats(docs: DataFrame, window: int = 13, kind: Kind = WORDS, bucket_symbols: int = 1_000_000) -> DataFrame:
    """(doc_id, text, n_words, n_removed, kept string) for every row of docs (doc_id, text).

    Every word goes that lies in `window` words in a row which also start in a document with a smaller id; windows are judged on the input. kept
    has the other words, joined by one space. Null texts have no words; texts under `window` words stay whole; of equal texts the one with the smallest
    id stays. Rows that share an id are one document. Words are compared by 64-bit hashes. Other columns are not read. Rows with a null doc_id are documents of
    their own, after all others.
    """
    kind = Kind(kind.symbols, kind.dtype, window, min(kind.gram, window), kind.piece, kind.chunk)
    docs = keyed(docs.select(F.col("doc_id"), F.col("text")))
    spans = covered_windows(docs.select(F.col("__key").alias("id"), "text"), kind, lambda b: smallest_holders(b, window), bucket_symbols)
    rows = docs.join(spans.withColumnRenamed("id", "__key"), "__key", "left").drop("__key")

    def work(columns):
        out = [[], [], []]
        for text, covered in zip(*(c.to_pylist() for c in columns), strict=True):
            words = find_words(text or "")
            gone = mask(len(words), covered)
            kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if covered else words
            for o, v in zip(out, (len(words), len(words) - len(kept), " ".join(kept)), strict=True):
                o.append(v)
        return [pa.array(o, k) for o, k in zip(out, (pa.int64(), pa.int64(), pa.string()), strict=True)]

    return with_columns(rows, ["text", "covered"], "n_words bigint, n_removed bigint, kept string", work).drop("covered")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
