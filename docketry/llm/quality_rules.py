"""Quality rules: a decision list learned by sequential covering.

Each rule is a conjunction of thresholds on text statistics. A rule is grown on one part of the labelled rows, one
condition at a time by information gain, and pruned on the other part from its last condition on; the rows
that it covers are then set aside and the next rule is sought. The list becomes one Spark CASE expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import find_words, table

SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_digits", "n_marks", "n_lines")
#: What rules may test: ratios of the statistics, so that they mean the same for short and long texts.
FEATURES = ("mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "capital_rate", "digit_rate", "mark_rate", "words_a_line")


def _repeated_words(words: list[str], size: int = 3) -> int:
    """Words in windows of size words that occur twice or more in the text."""
    if len(words) <= size:
        return 0
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    code = a[: len(a) - size + 1]
    for k in range(1, size):  # pair codes are renumbered, so they stay small for any length
        code = code * len(ids) + a[k : len(a) - size + 1 + k]
        if k < size - 1:
            code = np.unique(code, return_inverse=True)[1]
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    covered = np.zeros(len(a), bool)
    for k in range(size):
        covered[starts + k] = True
    return int(covered.sum())


def _stats(text: str | None) -> list[int]:
    text = text or ""
    words, lines = find_words(text), text.split("\n")
    seen: set[str] = set()
    dup = 0
    for line in lines:
        if line in seen:
            dup += 1
        elif line.strip(" \t\v\f\r"):
            seen.add(line)
    joined = "".join(words)
    letters = sum(map(str.isalpha, joined)) if not joined.isascii() else len(joined) - sum(joined.count(c) for c in "0123456789.,;:!?\"'()-_#*$%&|<>")
    capitals = sum(map(str.isupper, joined))
    digits = sum(joined.count(c) for c in "0123456789")
    return [len(words), len(joined), sum(text.count(c) for c in SYMBOLS), dup, _repeated_words(words), capitals, digits, len(joined) - letters - digits, len(seen) + dup]


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of every whole text: (id, one long column for each of STATS).

    A null text counts as empty, with 0 everywhere. Repeated rows are counted each; ties and other columns of docs play no part.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_stats(t.as_py()) for t in b.column(1)]
            cols = zip(*rows, strict=True) if rows else [[] for _ in STATS]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)], names=["id", *STATS])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"id {kind}, " + ", ".join(f"{s} bigint" for s in STATS)).withColumnRenamed("id", id_col)


def features() -> dict[str, Column]:
    """The features as expressions over the statistics; 0 where the divisor is 0."""
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "mean_word": per("word_chars", "n_words"), "symbol_rate": per("n_symbols", "n_words"), "dup_line_rate": per("n_dup_lines", "n_lines"),
        "repeat_rate": per("n_repeat_words", "n_words"), "capital_rate": per("n_capitals", "word_chars"), "digit_rate": per("n_digits", "word_chars"),
        "mark_rate": per("n_marks", "word_chars"), "words_a_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Rule:
    """All conditions (feature, above?, threshold) hold: the text is rejected."""

    conditions: tuple[tuple[str, bool, float], ...]
    precision: float
    covered: int

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, above, t in self.conditions:
            out &= (x[name] > t) if above else (x[name] <= t)
        return out

    def column(self, columns: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, above, t in self.conditions:
            out = out & ((columns[name] > t) if above else (columns[name] <= t))
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{n} {'>' if a else '<='} {t:.4g}" for n, a, t in self.conditions)


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _thresholds(values: np.ndarray, bad: np.ndarray, cuts: int) -> np.ndarray:
    """Midpoints between neighbouring values where the share of bad rows changes: at most 2 * cuts, evenly taken."""
    v, at = np.unique(values, return_inverse=True)
    share = np.bincount(at, weights=bad) / np.bincount(at)
    turn = np.flatnonzero(share[1:] != share[:-1])
    if len(turn) > 2 * cuts:
        turn = turn[np.linspace(0, len(turn) - 1, 2 * cuts).astype(int)]
    return (v[turn] + v[turn + 1]) / 2


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int, cuts: int) -> list[tuple[str, bool, float]]:
    inside, conditions = np.ones(len(bad), bool), []
    while len(conditions) < most and (inside & ~bad).any() and (inside & bad).any():
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        best = (1e-9, None, None)
        for name, values in x.items():
            thresholds = _thresholds(values[inside], bad[inside], cuts)
            for t in thresholds:
                over = inside & (values > t)
                for above, hit in ((True, over), (False, inside & ~over)):
                    g = _gain(p0, n0, int((hit & bad).sum()), int((hit & ~bad).sum()))
                    if g > best[0]:
                        best = (g, (name, above, float(t)), hit)
        if best[1] is None:
            break
        conditions.append(best[1])
        inside = best[2]
    return conditions


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7, most_rules: int = 12, most_conditions: int = 4, least_precision: float = 0.9, cuts: int = 24) -> list[Rule]:
    """Rules for the rows that `bad` marks, in the order in which they are to be asked.

    A rule whose precision on the pruning part is under least_precision ends the search, so accepted texts are safe
    from rules that hold by chance. No rows, or rows of one kind only, give no rules.
    """
    part = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left, rules = np.ones(len(bad), bool), []
    take = lambda m: ({k: v[m] for k, v in x.items()}, bad[m])
    while len(rules) < most_rules:
        (gx, gb), (px, pb) = take(left & part), take(left & ~part)
        if gb.sum() < 3 or pb.sum() < 1 or gb.all():
            break
        conditions = _grow(gx, gb, most_conditions, cuts)
        if not conditions:
            break
        best, best_worth = None, -2.0
        for k in range(len(conditions), 0, -1):
            hit = Rule(tuple(conditions[:k]), 0, 0).covers(px)
            p, n = int((hit & pb).sum()), int((hit & ~pb).sum())
            worth = (p - n) / (p + n) if p + n else -1.0
            if worth >= best_worth:  # the shorter one of equals
                best, best_worth = Rule(tuple(conditions[:k]), p / (p + n) if p + n else 0.0, p + n), worth
        if best.precision < least_precision:
            break
        rules.append(best)
        left &= ~best.covers(x)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list over columns of STATS: false where a rule holds, the first one that does deciding; else true."""
    columns = features()
    out = None
    for r in rules:
        out = (F if out is None else out).when(r.column(columns), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id", label_col: str = "quality") -> list[Rule]:
    """Rules from the labelled documents; label 0 is bad. At most `sample` labelled rows are used, those whose ids have the
    smallest hashes; the sample alone is collected. Rows with a null id or label are not used; of several labels of an id the
    smallest counts; base failures are left out, as no rule is asked about them; ids that documents lack are ignored; no labels at all give no rules."""
    some = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col)).agg(F.min(label_col).cast("long").alias("label_"))
        .orderBy(F.xxhash64(id_col), id_col).limit(sample)
    )
    # at most `sample` rows of two numbers
    picked = docs.select(id_col, "text").join(F.broadcast(some.select(F.col(id_col).alias("id_"), "label_")), F.col(id_col) == F.col("id_"))
    stats = text_stats(picked.select(F.struct(id_col, "label_").alias("k"), "text"), "k").where(~base_failed())
    rows = stats.select("k", *[c.alias(n) for n, c in features().items()]).orderBy("k").limit(2 * sample).toPandas()
    if rows.empty:
        return []
    bad = rows["k"].map(lambda k: k["label_"]).to_numpy() == 0
    return learn_rules({n: rows[n].to_numpy(float) for n in FEATURES}, bad)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistics of every document with base_failed (under 50 words, or over half of the words in repeated
    three-word windows) and kept: false for base failures, else the decision list's verdict."""
    return text_stats(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & verdict(rules))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
