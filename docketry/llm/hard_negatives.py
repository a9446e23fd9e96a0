"""Hard negatives of anchors by a vertical scan (BOND): exact inner products without reading every dimension of every row.

Rows are packed once into blocks of whole columns: all first components of the block, then all second ones, and so on, with the least and the
largest value of each. An anchor reads the columns in the order of its own components, largest magnitude first. After every few columns a row's score lies
between its sum so far plus the least, and plus the most, that the columns still to come can give; rows that can't be in a result any more
leave the candidate bitmap, and what is left at the end has its exact score.

Two scans: the first finds the positives of each anchor, the second the negatives in the window of scores that each positive opens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

BLOCK_ROWS = 4096
STEP = 8
#: Components of this magnitude and more are left out, as sums of their products (16,384 components at most) need not fit a long.
TOO_LARGE = 1 << 16
_HITS = "anchor_id bigint, window int, id bigint, score bigint"


def packed(rows: DataFrame) -> DataFrame:
    """Blocks (n, dims, ids, labels, columns) of rows (id, label, vector of integers), each in the order of its labels; short vectors end in zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(k, BLOCK_ROWS)
                labels = part.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
                at = np.argsort(labels, kind="stable")
                vectors = part.column(2)
                sizes = np.diff(vectors.offsets.to_numpy())
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                columns = np.zeros((int(sizes.max()), len(sizes)), np.int32)
                where = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                columns[where, np.repeat(np.arange(len(sizes)), sizes)] = flat
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                data = [[len(at)], [len(columns)], [ids[at].tobytes()], [labels[at].tobytes()], [np.ascontiguousarray(columns[:, at]).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(data, [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()], strict=True)], names=["n", "dims", "ids", "labels", "columns"])

    return rows.select("id", "label", "vector").mapInArrow(run, "n int, dims int, ids binary, labels binary, columns binary")


class Best:
    """The first `most` of what was offered: largest score first, then smallest id."""

    def __init__(self, most: int):
        self.most, self.scores, self.ids = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.most]
        self.scores, self.ids = scores[first], ids[first]

    @property
    def least(self) -> float:
        """A score under this one can't come in any more."""
        return self.scores[-1] if len(self.scores) == self.most else -np.inf


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, -k)[-k] if len(values) >= k else -np.inf


def vertical(columns: np.ndarray, least: np.ndarray, most: np.ndarray, anchor: np.ndarray, order: np.ndarray, rows: np.ndarray, admit: Callable) -> tuple[np.ndarray, np.ndarray]:
    """(rows that admit never turned away, their exact scores). admit takes the bounds of the scores of the rows left and returns a bitmap of those that stay."""
    ends = anchor[order] * least[order], anchor[order] * most[order]
    low, high = np.minimum(*ends), np.maximum(*ends)
    # what the columns from k on can give
    low, high = [np.concatenate([np.cumsum(x[::-1])[::-1], [0]]) for x in (low, high)]
    sums = np.zeros(len(rows), columns.dtype)
    for k in range(0, len(order), STEP):
        now = order[k : k + STEP]
        sums = sums + anchor[now] @ columns[np.ix_(now, rows)]
        stay = admit(sums + low[min(k + STEP, len(order))], sums + high[min(k + STEP, len(order))])
        if not stay.all():
            rows, sums = rows[stay], sums[stay]
        if not len(rows):
            break
    return rows, sums


class Anchors:
    """Some anchors (id, label, vector[, scores of its positives]) and the scan of a block for each."""

    def __init__(self, given: list, most: int, floor: float, ceiling: float):
        self.ids = [g[0] for g in given]
        self.labels = [g[1] for g in given]
        self.vectors = [np.array(g[2], np.int64) for g in given]
        self.orders = [np.argsort(-np.abs(v), kind="stable") for v in self.vectors]
        # windows in hundredths; the smallest whole score of one, and the largest
        self.windows = [[(-(-int(floor) * p // 100), int(ceiling) * p // 100) for p in g[3]] if len(g) > 3 else None for g in given]
        self.most = most

    def scan(self, blocks: Iterator[tuple]) -> Iterator[tuple[int, int, Best]]:
        """(anchor, window, its best) over all blocks of a task; window 0 is that of the positives."""
        best: dict[tuple[int, int], Best] = {}
        for n, dims, ids, labels, columns in blocks:
            ids, labels, columns = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int32), np.frombuffer(columns, np.int32).reshape(dims, n)
            least, most = (columns.min(1), columns.max(1)) if n else (np.zeros(dims), np.zeros(dims))
            top = max(1, int(np.abs(columns).max(initial=0)))
            forms = {np.float64: None, np.int64: None}
            for a, (anchor, label, vector) in enumerate(zip(self.ids, self.labels, self.vectors, strict=True)):
                # sums under 2**53 are whole numbers in doubles too
                form = np.float64 if top * max(1, int(np.abs(vector).max(initial=0))) * max(1, dims) < 1 << 53 else np.int64
                if forms[form] is None:
                    forms[form] = columns.astype(form), least.astype(form), most.astype(form)
                order = self.orders[a]
                order = order[order < dims]
                same = slice(*np.searchsorted(labels, [label, label + 1]))
                if self.windows[a] is None:
                    rows = np.arange(same.start, same.stop)
                    self._positives(forms[form], vector.astype(form), order, rows[ids[rows] != anchor], ids, best.setdefault((a, 0), Best(self.most)))
                else:
                    rows = np.concatenate([np.arange(same.start), np.arange(same.stop, n)])
                    held = [best.setdefault((a, w), Best(self.most)) for w in range(1, len(self.windows[a]) + 1)]
                    self._negatives(forms[form], vector.astype(form), order, rows[ids[rows] != anchor], ids, self.windows[a], held)
        for (a, w), found in best.items():
            yield a, w, found

    @staticmethod
    def _positives(form: tuple, vector: np.ndarray, order: np.ndarray, rows: np.ndarray, ids: np.ndarray, best: Best) -> None:
        def admit(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return high >= max(best.least, _kth(low, best.most))

        rows, scores = vertical(*form, vector, order, rows, admit)
        best.offer(scores.astype(np.int64), ids[rows])

    @staticmethod
    def _negatives(form: tuple, vector: np.ndarray, order: np.ndarray, rows: np.ndarray, ids: np.ndarray, windows: list[tuple[int, int]], held: list[Best]) -> None:
        def admit(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            stay = np.zeros(len(low), bool)
            for (first, last), best in zip(windows, held, strict=True):
                inside = low[(low >= first) & (high <= last)]
                stay |= (high >= max(first, best.least, _kth(inside, best.most))) & (low <= last)
            return stay

        rows, scores = vertical(*form, vector, order, rows, admit)
        scores = scores.astype(np.int64)
        for (first, last), best in zip(windows, held, strict=True):
            inside = (scores >= first) & (scores <= last)
            best.offer(scores[inside], ids[rows][inside])


def _scanned(blocks: DataFrame, anchors: DataFrame, n_blocks: int, most: int, floor: int, ceiling: int) -> DataFrame:
    """The best of each window over all blocks: one pass for each block of anchors, which a broadcast takes along."""
    sc, hits = blocks.sparkSession.sparkContext, None
    for k in range(n_blocks):
        given = [tuple(r)[1:] for r in anchors.where(F.col("part") == k).select("part", "id", "label", "vector", *[c for c in anchors.columns if c == "scores"]).collect()]
        sent = sc.broadcast(given)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            rows = (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows))
            given = Anchors(sent.value, most, floor, ceiling)
            for a, w, best in given.scan(rows):
                m = len(best.ids)
                yield pa.RecordBatch.from_arrays([pa.array([given.ids[a]] * m, pa.int64()), pa.array([w] * m, pa.int32()), pa.array(best.ids, pa.int64()), pa.array(best.scores, pa.int64())], names=["anchor_id", "window", "id", "score"])

        found = stored(blocks.mapInArrow(run, _HITS), "hits")
        sent.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    first = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, is_anchor: F.Column, positives: int = 5, negatives: int = 5, floor: int = 80, ceiling: int = 100, scale: int = 256, block_bytes: int = 1 << 25) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (id, label, vector).

    Components x become floor(scale * x), and scores are their inner products, so results are exact. The positives of an anchor are its first rows of the same label,
    the negatives of a positive the first rows of other labels whose score is between floor and ceiling hundredths of the positive's; larger scores come first, then smaller ids.

    Rows with a null id, label or vector take no part, nor do those with a component that is null, not finite, or of magnitude TOO_LARGE and more. Missing components of a shorter
    vector count as 0. Rows with an anchor's id are none of its partners; other rows that share an id are ranked each, so a repeated row can stand in several places. An anchor id in
    several rows is one anchor, with the smallest label and then vector. An empty table, or one without anchors, gives no rows. Other columns are not read.

    Anchors are told apart by id and go out in blocks of about block_bytes bytes, so each executor holds one block; every block reads the packed rows once. Work is anchors times rows at worst.
    """
    whole = F.coalesce(F.forall("vector", lambda x: F.coalesce(F.abs(x) < TOO_LARGE, F.lit(False))), F.lit(False))
    fit = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole & (F.size("vector") > 0))
    fit = fit.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("vector"))
    blocks = stored(packed(fit), "blocks")
    anchors = fit.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")
    anchors = stored(anchors, "anchors")
    n_blocks = max(1, -(-anchors.agg(F.coalesce(F.sum(24 + 8 * F.size("vector")), F.lit(0))).first()[0] // block_bytes))
    anchors = anchors.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    found = _scanned(blocks, anchors, n_blocks, positives, floor, ceiling)
    found = stored(found.select("anchor_id", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = found.groupBy(F.col("anchor_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("window", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))
    anchors = stored(anchors.join(scores, "id"), "opened")
    out = _scanned(blocks, anchors, n_blocks, negatives, floor, ceiling)
    return out.join(found, ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector")), F.col("id") % 100 == 0)
