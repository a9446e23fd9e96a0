"""The given tables, and the stored and incoming states that queries derive from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables by attribute: t.orders reads orders."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of Tables under its own name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = "WITH " + ", ".join(f"{k} AS ({v})" for k, v in STATES.items() if k in sql) + f" {sql}" if any(k in sql for k in STATES) else sql
        return f

    return add


#: States in SQL: orders as they were stored before 2000, and as they came in from 1997 on, dearer and a day later; urgent
#: ones came in ten days earlier instead, and those of low priority without a status.
STATES = {
    "s_orders": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(o_orderdate AS DATE) AS d, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'",
    "i_orders": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS price, CAST(o_orderdate AS DATE) + CASE WHEN o_orderpriority = '1-URGENT' THEN -10 ELSE 1 END AS d, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'",
    "s_lines": "SELECT l_orderkey, l_linenumber, SUM(CAST(l_quantity AS BIGINT)) AS qty, COUNT(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2",
    "i_lines": "SELECT l_orderkey, l_linenumber, SUM(CAST(l_quantity AS BIGINT)) AS qty, COUNT(*) AS n FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2",
}


def stored_orders(t: Tables) -> DataFrame:
    return t.orders.where("o_orderdate < TIMESTAMP '2000-01-01'").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.to_date("o_orderdate").alias("d"), "o_orderpriority")


def incoming_orders(t: Tables) -> DataFrame:
    return t.orders.where("o_orderdate >= TIMESTAMP '1997-01-01'").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice").cast("decimal(18,2)") + 1).cast("decimal(18,2)").alias("price"),
        F.date_add(F.to_date("o_orderdate"), F.when(F.col("o_orderpriority") == "1-URGENT", -10).otherwise(1)).alias("d"), "o_orderpriority",
    )


def lines(t: Tables, without: str, orders: DataFrame | None = None) -> DataFrame:
    """Lines by order and number; those of `orders` (l_orderkey) alone, if given, so that the shuffle that picks them serves the grouping too."""
    rows = t.lineitem.where(F.col("l_returnflag") != without)
    if orders is not None:
        rows = rows.join(orders, "l_orderkey", "left_semi")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"), F.count("*").alias("n"))


def shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, as all engines print them alike."""
    return df.select(*[F.col(c).cast("double").alias(c) if k.startswith("decimal") else F.col(c).cast("string").alias(c) if k == "date" else F.col(c) for c, k in df.dtypes])
