"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of code points that are not a space or one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text) -> "F.Column":
    """Words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where it is unset, a local session gets one of its own; a cluster session must set it, as
    a folder of one machine would be lost with it."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        given = tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set("spark.checkpoint.dir", given)
    return given


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, which cuts its lineage.

    Executors that are lost later cost nothing: the rows are files. The shuffle files of the job that writes them are given back as soon as it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def hash_words(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word, alike in every process."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def roll(values: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash of every k values in a row (len - k + 1 of them), by doubling: the hash
    of two neighbouring runs is made from the hashes of both."""
    values = values.astype(np.uint64)
    if k > len(values):
        return np.zeros(0, np.uint64)
    out, done, power, width, run = None, 0, 1, 1, values
    while True:
        if k & width:
            if out is None:
                out, done = run, width
            else:
                n = len(values) - done - width + 1
                out = out[:n] * np.uint64(pow(base, width, 1 << 64)) + run[done : done + n]
                done += width
        if done == k:
            return mix(out)
        n = len(run) - width
        run = run[:n] * np.uint64(pow(base, width, 1 << 64)) + run[width:]
        width *= 2


def with_columns(df: DataFrame, inputs: list[str], fields: str, work) -> DataFrame:
    """df with further columns that work(list of Arrow arrays) returns for a batch, in the order of fields ("name type, ...").

    All columns of df pass through, nothing is shuffled. A column of df with the name of a new one is replaced.
    """
    import pyarrow as pa

    new = [f.strip().split(" ", 1)[0] for f in fields.split(",")]
    old = [c for c in df.columns if c not in new]
    at = [df.columns.index(c) for c in inputs]
    keep = [df.columns.index(c) for c in old]

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                made = work([part.column(i) for i in at])
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), *made], names=[*old, *new])

    from pyspark.sql import types as T

    return df.mapInArrow(run, T.StructType([df.schema[c] for c in old] + T._parse_datatype_string(fields).fields))
