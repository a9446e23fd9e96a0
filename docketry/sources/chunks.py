"""A store of chunks that is only appended to: rows that are replaced are marked in vectors of dead rows, and readers leave them out.

A row has a batch (one for each run that stored some) and a number in it. A vector says which of 32,768 numbers in a row of a batch are dead; it is appended by the run that replaces them, so a
run writes its new rows and a few kilobytes for each batch that it takes rows from. Compaction writes the live rows once and drops the vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .snapshots import Catalog

CHUNKS, DEAD = "text_chunks", "text_chunks_dead"
#: Columns that the files of a run have besides a chunk's own: what the run told itself of its versions and batches (plans.ingest.store_texts).
TOLD = ("text_length", "failed", "__task", "__inside")


def _is_set(bits: Column, number: Column) -> Column:
    """Whether the bit of a row's number is set in the vector of its bucket; no vector has no bits."""
    at = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1, F.lit(False))


def dead_rows(rows: DataFrame) -> DataFrame:
    """Vectors (batch, bucket, bits, n) of the rows (batch, row)."""
    return rows.groupBy("batch", F.bitmap_bucket_number("row").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits"), F.count("*").alias("n"))


def live(catalog: Catalog, version: int | None = None, batches: DataFrame | None = None) -> DataFrame | None:
    """The rows that aren't dead, of all batches or of those given. Vectors of one bucket are put together; they meet the rows by batch and bucket, small as they are."""
    rows, dead = catalog.read(CHUNKS, version), catalog.read(DEAD, version)
    rows = rows if rows is None else rows.drop(*TOLD)
    if rows is not None and batches is not None:
        rows = rows.join(batches, "batch", "left_semi")
    if rows is None or dead is None:
        return rows
    bits = dead.groupBy("batch", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    met = rows.withColumn("bucket", F.bitmap_bucket_number("row")).join(bits, ["batch", "bucket"], "left")
    return met.where(~_is_set(F.col("bits"), F.col("row"))).select(*rows.columns)


def compact(catalog: Catalog, share: float = 0.2) -> bool:
    """Write the live rows once if dead ones have that share; batches and numbers stay. A run that stores chunks meanwhile makes it a Conflict."""
    base = catalog.version()
    rows, dead = catalog.read(CHUNKS, base), catalog.read(DEAD, base)
    if rows is None or dead is None:
        return False
    n, gone = rows.count(), dead.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if gone == 0 or gone < share * n:
        return False
    catalog.commit({CHUNKS: live(catalog, base), DEAD: dead.limit(0)}, base=base)
    return True
