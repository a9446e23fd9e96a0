"""Repeated windows over all documents: which windows of `window` symbols also start in a document with a smaller id.

Symbols are bytes or words. Every window is known by its anchor, the gram of `gram` symbols in it that has the smallest hash, and a run of
windows with one anchor is a stretch. Equal windows have equal anchors, so:

1. The anchors of all stretches are counted (a few bytes each, packed); those that occur once are done with.
2. The stretches of the others are dealt by anchor and compared, each group by a method of the caller's.
3. What is covered comes back to each document as intervals.

Hot anchors don't pile up: a part of the input sends an anchor, or a stretch, once, for the smallest of its documents that holds it; for its other
documents the answer is known on the spot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import find_words, hash_words, mix, roll, stored


@dataclass(frozen=True)
class Kind:
    """What the symbols are, how many make a window, how many a gram, and how large a part is handled at a time."""

    symbols: Callable[[str], np.ndarray]
    dtype: type
    window: int
    gram: int
    piece: int
    chunk: int


def byte_symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def word_symbols(text: str) -> np.ndarray:
    return hash_words(find_words(text))


BYTES = Kind(byte_symbols, np.uint8, 50, 24, 1 << 20, 1 << 24)
WORDS = Kind(word_symbols, np.uint64, 13, 5, 1 << 18, 1 << 21)


def _least(packed: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` values in a row."""
    out, done = packed, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def stretches(parts: list[np.ndarray], kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(part, first window, windows, anchor hash) of all stretches of some rows of symbols, in order."""
    window, gram = kind.window, kind.gram
    keep = [k for k, p in enumerate(parts) if len(p) >= window]
    if not keep:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row = np.concatenate([parts[k] for k in keep])
    sizes = np.array([len(parts[k]) for k in keep])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    if kind.dtype is np.uint8:
        row = row.astype(np.uint64) + np.uint64(1)
    grams = roll(row, gram)
    bits = max(1, int(len(grams)).bit_length())
    low = np.uint64((1 << bits) - 1)
    packed = _least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
    anchor = (packed & low).astype(np.int64)
    # windows over a border of two rows are none
    inside = np.ones(len(anchor), bool)
    for s in starts[1:].tolist():
        inside[max(0, s - window + 1) : s] = False
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    count = np.diff(np.concatenate([first, [len(anchor)]]))
    good = inside[first]
    first, count = first[good], count[good]
    part = np.searchsorted(starts, first, side="right") - 1
    return np.array(keep)[part], first - starts[part], count, grams[anchor[first]]


def _pieces(rows: Iterator[tuple], kind: Kind) -> Iterator[list[tuple]]:
    """Rows (..., symbols last) in lists of about kind.piece symbols."""
    some, n = [], 0
    for r in rows:
        some.append(r)
        n += len(r[-1])
        if n >= kind.piece:
            yield some
            some, n = [], 0
    if some:
        yield some


def _chunks(batches: Iterator[pa.RecordBatch], kind: Kind) -> Iterator[list[tuple]]:
    """Rows (id, *others, symbols of the text in column 1), ordered by id, in lists of about kind.chunk symbols."""
    some, n = [], 0
    for b in batches:
        for r in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True):
            symbols = kind.symbols(r[1] or "")
            if len(symbols) < kind.window:
                continue
            some.append((r[0], *r[2:], symbols))
            n += len(symbols)
            if n >= kind.chunk:
                yield sorted(some, key=lambda r: r[0])
                some, n = [], 0
    if some:
        yield sorted(some, key=lambda r: r[0])


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in `values`; offsets count its items."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def _by_id(ids: np.ndarray, values: np.ndarray) -> tuple[pa.Array, pa.Array]:
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    at = _runs(ids)
    return pa.array(ids[at[:-1]], pa.int64()), _binary(values, at)


def _bucket(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchors >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _code(anchors: np.ndarray, buckets: int) -> np.ndarray:
    """What is sent of an anchor: its bucket and its low 32 bits. Anchors that only seem equal cost a comparison, no error."""
    return (_bucket(anchors, buckets).astype(np.uint64) << np.uint64(32)) | (anchors & np.uint64(0xFFFFFFFF))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """(key, columns) of rows with equal first columns, in sorted batches."""
    key, held = None, None
    for b in batches:
        for r in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True):
            if r[0] != key:
                if held is not None:
                    yield key, held
                key, held = r[0], [[] for _ in r[1:]]
            for h, v in zip(held, r[1:], strict=True):
                h.append(v)
    if held is not None:
        yield key, held


def keyed(docs: DataFrame) -> DataFrame:
    """docs with __key (long): doc_id, and for rows whose doc_id is null a number of their own after all ids.

    Which of several such rows comes first is open; they are stored, so that it stays as it is."""
    key = F.col("doc_id").cast("long")
    seen = docs.agg(F.count_if(key.isNull()).alias("n"), F.max(key).alias("top")).first()
    if not seen["n"]:
        return docs.withColumn("__key", key)
    first = 0 if seen["top"] is None else seen["top"] + 1
    if first + seen["n"] >= 1 << 63:
        raise ValueError("no numbers are left after the ids for rows without an id")
    lost = stored(docs.where(key.isNull()).withColumn("__key", F.monotonically_increasing_id()), "unnamed")
    part, starts = F.shiftright("__key", 33), []
    for r in sorted(lost.groupBy(part.alias("part")).count().collect()):
        starts.append((r["part"], first))
        first += r["count"]
    starts = F.broadcast(docs.sparkSession.createDataFrame(starts, "__part long, __first long"))
    lost = lost.withColumn("__part", part).join(starts, "__part").withColumn("__key", F.col("__first") + F.col("__key").bitwiseAND((1 << 33) - 1))
    return docs.where(key.isNotNull()).withColumn("__key", key).unionByName(lost.drop("__part", "__first"))


@dataclass
class Bundle:
    """The distinct stretches of a bucket that hold an anchor in common with another one."""

    anchors: np.ndarray  # one for each stretch; equal ones stand together
    symbols: list[np.ndarray]
    windows: np.ndarray  # how many windows each has
    smallest: np.ndarray  # the smallest id that has it


def covered_windows(docs: DataFrame, kind: Kind, compare: Callable[[Bundle], list[np.ndarray]], bucket_symbols: int, most_partitions: int = 20_000) -> DataFrame:
    """(id, covered): for each document (id, text) of docs with covered windows, arrays of packed int64 pairs (from, to) of symbols.

    compare gets bundles and says for each stretch, for each of its windows, the smallest id of all stretches that hold that window. A bucket holds about bucket_symbols
    symbols at most, which bounds the memory of a task; a task takes one bucket after the other, so there are never more than most_partitions tasks."""
    symbols = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"] // (1 if kind.dtype is np.uint8 else 6)
    buckets = max(48, -(-symbols // bucket_symbols))
    tasks = min(buckets, most_partitions)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, kind):
            whos, codes = [], []
            at = 0
            for piece in _pieces(iter(chunk), kind):
                part, _, _, anchor = stretches([r[-1] for r in piece], kind)
                whos.append(part + at)
                codes.append(_code(anchor, buckets))
                at += len(piece)
            ids = np.array([r[0] for r in chunk], np.int64)
            who, code = np.concatenate(whos), np.concatenate(codes)
            order = np.lexsort((who, code))
            who, code = ids[who[order]], code[order]
            runs = _runs(code)
            first, last = who[runs[:-1]], who[runs[1:] - 1]
            # several documents of this chunk: known at once, for all of them
            many = np.repeat(first != last, np.diff(runs))
            if many.any():
                i, v = _by_id(who[many], code[many])
                yield pa.RecordBatch.from_arrays([_aside(i), i, v, pa.nulls(len(i), pa.binary()), pa.nulls(len(i), pa.binary())], names=names)
            # one entry for each anchor, packed by bucket: the ids once, how many anchors each, their low bits
            code, who = code[runs[:-1]], first
            bucket = (code >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((who, bucket))
            bucket, who, low = bucket[order], who[order], (code[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            pair = _runs(bucket * np.int64(1 << 40) + np.searchsorted(ids, who))
            runs = _runs(bucket)
            of_pair = np.searchsorted(pair[:-1], runs)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[runs[:-1]], pa.int64()), pa.nulls(len(runs) - 1, pa.int64()), _binary(who[pair[:-1]], of_pair), _binary(np.diff(pair).astype(np.uint32), of_pair), _binary(low, runs)], names=names)

    names = ["bucket", "id", "a", "b", "c"]
    schema = "bucket bigint, id bigint, a binary, b binary, c binary"
    sent = docs.mapInArrow(anchors, schema).repartition(tasks, "bucket").sortWithinPartitions("bucket")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, (ids, a, b, c) in _groups(batches):
            if bucket < 0:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.binary())], names=["id", "codes"])
                continue
            who = np.repeat(np.frombuffer(b"".join(a), np.int64), np.frombuffer(b"".join(b), np.uint32))
            low = np.frombuffer(b"".join(c), np.uint32)
            order = np.argsort(low, kind="stable")
            low, who = low[order], who[order]
            size = np.diff(_runs(low))
            many = np.repeat(size > 1, size)
            if many.any():
                i, v = _by_id(who[many], low[many].astype(np.uint64) | np.uint64(bucket << 32))
                yield pa.RecordBatch.from_arrays([i, v], names=["id", "codes"])

    hits = stored(sent.mapInArrow(shared, "id bigint, codes binary").groupBy("id").agg(F.collect_list("codes").alias("codes")), "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for chunk in _chunks(batches, kind):
            ids, starts, windows, anchors_, bodies, seen = [], [], [], [], [], {}
            known_i, known_v = [], []
            at = 0
            for piece in _pieces(iter(chunk), kind):
                part, first, count, anchor = stretches([r[-1] for r in piece], kind)
                code = _code(anchor, buckets)
                edges = np.searchsorted(part, np.arange(len(piece) + 1))
                for k, (i, wanted, row) in enumerate(piece):
                    lo, hi = edges[k], edges[k + 1]
                    hit = np.flatnonzero(np.isin(code[lo:hi], np.frombuffer(b"".join(wanted), np.uint64))) + lo
                    for s, n, h in zip(first[hit].tolist(), count[hit].tolist(), anchor[hit].tolist(), strict=True):
                        body = row[s : s + n - 1 + kind.window].tobytes()
                        before = seen.setdefault((h, body), i)
                        if before != i:  # a smaller id of this chunk has the whole stretch
                            known_i.append(i)
                            known_v.append((s, s + n - 1 + kind.window))
                        else:
                            ids.append(i)
                            starts.append(s)
                            windows.append(n)
                            anchors_.append(h)
                            bodies.append(body)
                at += len(piece)
            if known_i:
                yield _cover_rows(np.array(known_i, np.int64), np.array(known_v, np.int64), sent_names)
            if ids:
                anchor = np.array(anchors_, np.uint64)
                bucket = _bucket(anchor, buckets)
                order = np.argsort(bucket, kind="stable")
                runs = _runs(bucket[order])
                body = [pack(b"".join([bodies[j] for j in order[x:y].tolist()])) for x, y in zip(runs[:-1], runs[1:], strict=True)]
                cols = [_binary(np.array(v, t)[order], runs) for v, t in ((ids, np.int64), (starts, np.int64), (windows, np.uint32), (anchors_, np.uint64))]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order][runs[:-1]], pa.int64()), pa.nulls(len(body), pa.int64()), *cols, pa.array(body, pa.binary())], names=sent_names)

    sent_names = ["bucket", "id", "a", "b", "c", "d", "e"]
    parts = docs.join(hits, "id").select("id", "text", "codes").mapInArrow(cut, "bucket bigint, id bigint, a binary, b binary, c binary, d binary, e binary")
    parts = parts.repartition(tasks, "bucket").sortWithinPartitions("bucket")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for bucket, columns in _groups(batches):
            if bucket < 0:
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], names=["id", "covered"])
                continue
            a, b, c, d = (b"".join(x) for x in columns[1:5])
            e = b"".join(map(unpack, columns[5]))
            ids, starts, windows, anchor = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), np.frombuffer(c, np.uint32).astype(np.int64), np.frombuffer(d, np.uint64)
            ends = np.cumsum((windows - 1 + kind.window) * np.dtype(kind.dtype).itemsize)
            known: dict[tuple[int, bytes], int] = {}
            text, at, of = memoryview(e), 0, []
            for h, end in zip(anchor.tolist(), ends.tolist(), strict=True):
                of.append(known.setdefault((h, bytes(text[at:end])), len(known)))
                at = end
            of = np.array(of)
            smallest = np.full(len(known), np.iinfo(np.int64).max)
            np.minimum.at(smallest, of, ids)
            out_i, out_v = [], []
            whole = ids > smallest[of]
            out_i.append(ids[whole])
            out_v.append(np.stack([starts[whole], starts[whole] + windows[whole] - 1 + kind.window], 1))
            # stretches with the same anchor but other surroundings may share some windows
            keys = list(known)
            heads = np.array([k[0] for k in keys], np.uint64)
            order = np.argsort(heads, kind="stable")
            size = np.diff(_runs(heads[order]))
            order = order[np.repeat(size > 1, size)]
            if len(order):
                rows = [np.frombuffer(keys[k][1], kind.dtype) for k in order.tolist()]
                least = compare(Bundle(heads[order], rows, np.array([len(r) - kind.window + 1 for r in rows]), smallest[order]))
                owners: dict[int, list[int]] = {}
                for j in np.flatnonzero(~whole).tolist():
                    owners.setdefault(int(of[j]), []).append(j)
                for k, found in zip(order.tolist(), least, strict=True):
                    hit = np.flatnonzero(found < smallest[k])
                    if len(hit):
                        runs = np.concatenate([[0], np.flatnonzero(np.diff(hit) > 1) + 1, [len(hit)]])
                        lo, hi = hit[runs[:-1]], hit[runs[1:] - 1] + kind.window
                        for j in owners[k]:
                            out_i.append(np.full(len(lo), ids[j]))
                            out_v.append(np.stack([lo, hi], 1) + starts[j])
            yield _cover_rows(np.concatenate(out_i), np.concatenate(out_v), ["id", "covered"], False)

    return stored(parts.mapInArrow(answer, "id bigint, covered binary").groupBy("id").agg(F.collect_list("covered").alias("covered")), "covered")


def _aside(ids: pa.Array) -> pa.Array:
    """Buckets, dealt by id, of rows that only have to reach the next stage."""
    return pa.array(-1 - (mix(ids.to_numpy().astype(np.uint64)) % np.uint64(1 << 16)).astype(np.int64), pa.int64())


def _cover_rows(ids: np.ndarray, spans: np.ndarray, names: list[str], mark: bool = True) -> pa.RecordBatch:
    order = np.lexsort((spans[:, 0], ids)) if len(ids) else np.zeros(0, np.int64)
    ids, spans = ids[order], spans[order]
    at = _runs(ids)
    i, v = pa.array(ids[at[:-1]], pa.int64()), _binary(spans.reshape(-1), at * 2)
    n = len(i)
    return pa.RecordBatch.from_arrays([_aside(i), i, v, *(pa.nulls(n, pa.binary()) for _ in names[3:])] if mark else [i, v], names=names)


def mask(size: int, covered: list[bytes] | None) -> np.ndarray:
    """Which of `size` symbols the spans cover."""
    steps = np.zeros(size + 1, np.int32)
    for c in covered or ():
        spans = np.frombuffer(c, np.int64).reshape(-1, 2)
        np.add.at(steps, spans[:, 0], 1)
        np.add.at(steps, spans[:, 1], -1)
    return np.cumsum(steps[:size]) > 0
