"""Counts of runs and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def outcomes(rows: DataFrame, outcome: str, reason: str | None = None) -> DataFrame:
    """(outcome, n, reasons): reasons are distinct and sorted, so the list stays as short as there are kinds of failure."""
    aggs = [F.count("*").alias("n")]
    if reason:
        aggs.append(F.array_sort(F.collect_set(reason)).alias("reasons"))
    return rows.groupBy(outcome).agg(*aggs)


def tally(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows for which each condition holds."""
    return rows.agg(*[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long").alias(n) for n, c in conditions.items()])


def text_length(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Characters of a key's texts, clamped to the largest int."""
    return rows.groupBy(key).agg(F.least(F.coalesce(F.sum(F.length(text)), F.lit(0)), F.lit(2147483647)).cast("int").alias("text_length"))


def last_success(runs: DataFrame, step: str, statuses: tuple[str, ...] = ("Succeeded", "PartiallySucceeded")) -> DataFrame:
    return runs.where((F.col("step_name") == step) & F.col("status").isin(*statuses)).agg(F.max("completed_at").alias("completed_at"))


def observed(rows: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, "Observation"]:
    """rows, and counters that are filled while an action runs over them (dropped, out of range, skipped, ...), at no extra pass."""
    seen = Observation(name)
    return rows.observe(seen, *[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long").alias(n) for n, c in conditions.items()]), seen
