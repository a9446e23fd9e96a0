"""Where jobs put what the next one reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """A new folder in the one that driver and executors share (spark.checkpoint.dir). Only a local session may leave it unset and gets one of its own."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        given = tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set("spark.checkpoint.dir", given)
    return f"{given}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df, worked out once: written to a new shared folder and read again."""
    path = shared(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
