"""Inputs with missing values, which the given tables do not hold, and with targets that follow a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDERS_NULLS = """(
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
         o_orderdate, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
  FROM orders)"""

CUSTOMER_NULLS = """(
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment
  FROM customer)"""

RULED = """(
  SELECT c_custkey, c_nationkey % 5 AS band, c_acctbal / 1000 AS thousands,
         CASE WHEN c_nationkey % 5 < 2 THEN 'low' WHEN c_nationkey % 5 < 4 THEN 'middle' ELSE 'high' END AS level,
         CASE WHEN c_nationkey % 5 < 2 THEN 'yes' ELSE 'no' END AS low, (c_nationkey % 5) * (c_nationkey % 5) AS amount
  FROM customer)"""


def ruled(customer: DataFrame) -> DataFrame:
    """Customers with a class, a two-valued class and a number that `band` alone decides."""
    band = F.col("c_nationkey") % 5
    return customer.select(
        "c_custkey", band.alias("band"), (F.col("c_acctbal") / 1000).alias("thousands"),
        F.when(band < 2, "low").when(band < 4, "middle").otherwise("high").alias("level"),
        F.when(band < 2, "yes").otherwise("no").alias("low"), (band * band).alias("amount"))


def orders_nulls(orders: DataFrame) -> DataFrame:
    """A pending order has no price yet, and 'not specified' is no priority."""
    return orders.withColumns({
        "o_totalprice": F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")),
        "o_orderpriority": F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")),
    })


def customer_nulls(customer: DataFrame) -> DataFrame:
    """The segment of a customer in debt is unknown."""
    return customer.withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Sums of doubles depend on their order in the last bits."""
    return df.withColumns({n: F.round(n, digits) for n in names})
