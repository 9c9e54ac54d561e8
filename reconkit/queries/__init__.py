"""Registered queries over the driver tables, with SQL for the result check.

Every query reads whole tables.  Reconciliation queries compare ``orders`` (or
``lineitem``, whose keys repeat) with an altered copy derived from it, so both
sides grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Driver tables of one scale factor, read on access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and, if given, its SQL."""

    def add(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def rnd(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def altered_orders(t: Tables) -> DataFrame:
    """``orders`` as it might look in the target: rows missing, added and changed."""
    o = t.orders
    price, urgent = F.col("o_totalprice"), F.col("o_orderpriority") == "1-URGENT"
    changed = o.filter(price >= 5000).select(
        "o_orderkey",
        "o_custkey",
        F.when(urgent & price.between(100000, 130000), "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(price >= 450000, price + 1).otherwise(price).alias("o_totalprice"),
        "o_orderdate",
        F.when(~((F.col("o_orderstatus") == "P") & price.between(200000, 230000)), F.col("o_orderpriority")).alias(
            "o_orderpriority"
        ),
    )
    added = o.filter((F.col("o_orderpriority") == "5-LOW") & (price > 480000))
    return changed.unionByName(added.withColumn("o_orderkey", -1 - F.col("o_orderkey")))


TARGET = """
target AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice BETWEEN 100000 AND 130000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_totalprice >= 450000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderdate,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice BETWEEN 200000 AND 230000 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_totalprice >= 5000
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice > 480000)
"""


def altered_lineitem(t: Tables) -> DataFrame:
    """``lineitem`` with changed discounts and flags and without one-piece lines."""
    late = (F.col("l_tax") == 0.08) & (F.col("l_linestatus") == "O")
    return t.lineitem.filter("l_quantity <> 1").withColumns(
        {
            "l_discount": F.when(F.col("l_quantity") == 50, F.col("l_discount") + 0.01).otherwise(F.col("l_discount")),
            "l_returnflag": F.when(~late, F.col("l_returnflag")),
        }
    )


LINES = """
lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    CASE WHEN l_quantity = 50 THEN l_discount + 0.01 ELSE l_discount END AS l_discount, l_tax,
    CASE WHEN l_tax = 0.08 AND l_linestatus = 'O' THEN NULL ELSE l_returnflag END AS l_returnflag,
    l_linestatus, l_shipdate
  FROM lineitem WHERE l_quantity <> 1)
"""


def load() -> None:
    """Import all query modules."""
    from reconkit.queries import aggregates, data_io, joins, ordering, recon, scalars, shaping  # noqa: F401
