"""One row a key, and ranked rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.arrays import cosine


def best_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; order should leave no ties."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def latest_per_key(rows: DataFrame, keys: list[str], date: str, tie: list[Column]) -> DataFrame:
    """The latest row of each key, rows without a date last."""
    return best_per_key(rows, keys, [F.col(date).desc_nulls_last(), *tie])


def first_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    return _extreme(rows, keys, position, F.min_by)


def last_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    return _extreme(rows, keys, position, F.max_by)


def _extreme(rows: DataFrame, keys: list[str], position: str, pick) -> DataFrame:
    """By aggregation, which combines before the shuffle."""
    other = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(pick(F.struct(*other), F.col(position)).alias("_r")).select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def best_version(versions: DataFrame, key: str, date: str, fmt: str, position: str, priority: dict[str, int]) -> DataFrame:
    """The latest version of each key (no date is the earliest), of one date the format with the smallest priority, of those the one
    listed last. Formats without a priority are out."""
    p = F.try_element_at(F.create_map(*[F.lit(x) for kv in priority.items() for x in kv]), F.col(fmt))
    rows = versions.withColumn("_p", p).where("_p IS NOT NULL")
    rank = F.struct(F.coalesce(F.col(date).cast("string"), F.lit("")), -F.col("_p"), F.col(position))
    return rows.groupBy(key).agg(F.max_by(F.struct(*versions.columns), rank).alias("_r")).select("_r.*")


def best_format(versions: DataFrame, keys: list[str], fmt: str, position: str, priority: dict[str, int]) -> DataFrame:
    """For each version the format with the smallest priority, of equals the one listed first."""
    p = F.try_element_at(F.create_map(*[F.lit(x) for kv in priority.items() for x in kv]), F.col(fmt))
    rows = versions.withColumn("_p", p).where("_p IS NOT NULL")
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*versions.columns), F.struct("_p", position)).alias("_r")).select("_r.*")


def best_summary(rows: DataFrame, key: str, code: str, orders: DataFrame) -> DataFrame:
    """The row of each key whose code is furthest on in orders (code, order); rows with an unknown or no code, or no key, are out."""
    known = rows.where(F.col(key).isNotNull()).join(F.broadcast(orders), code)
    return known.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct("order", code)).alias("_r")).select("_r.*")


def current_term(terms: DataFrame, member: str, congress: str, position: str) -> DataFrame:
    """The term with the highest congress; without any, the first listed."""
    return best_per_key(terms, [member], [F.col(congress).desc_nulls_last(), F.col(position)])


def numbered_chunks(rows: DataFrame, chunks: str) -> DataFrame:
    """One row for each chunk that isn't blank, numbered from 0 in order."""
    kept = F.filter(F.col(chunks), lambda c: F.trim(c) != "")
    return rows.select(*[c for c in rows.columns if c != chunks], F.posexplode(kept).alias("chunk_index", "content"))


def cosine_topk(rows: DataFrame, query: list[float], k: int, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The k rows nearest to a query vector, with similarity; rows without a vector are out. Only k rows a task go to the last sort."""
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = rows.where(F.col(vector).isNotNull()).withColumn("similarity", cosine(F.col(vector), q))
    return scored.orderBy(F.col("similarity").desc_nulls_last(), key).limit(k)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys)
