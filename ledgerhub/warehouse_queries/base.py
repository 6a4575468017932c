"""Registration and the ERP reading of the given tables.

``nation.n_name`` plays the company, ``orders`` the document headers, ``lineitem`` the
ledger entries and document lines, ``customer`` and ``supplier`` the relations, ``part``
the account list and ``events`` the messages and job runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerhub.sizing import broadcast_within

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin where there is one."""
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def moment(text: str) -> Column:
    """A zone-free timestamp literal, as the tables store theirs."""
    return F.lit(text).cast("timestamp_ntz")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def plain(column: str | Column) -> Column:
    """Decimal result as double: the same value in every engine."""
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def companies(spark: SparkSession, folder: str) -> DataFrame:
    """n_nationkey, Entity, region."""
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("Entity"), F.col("r_name").alias("region")
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "nation").select(F.col("n_name").alias("name"))


def customer_companies(spark: SparkSession, folder: str) -> DataFrame:
    """c_custkey, Entity, region; broadcast while measured small, else an ordinary side."""
    customer = read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    named = companies(spark, folder)
    return broadcast_within(
        customer.join(named, customer.c_nationkey == named.n_nationkey).select(
            "c_custkey", "Entity", "region"
        )
    )


def documents(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    """Orders as document headers of a company."""
    orders = read(spark, folder, "orders") if orders is None else orders
    owner = customer_companies(spark, folder)
    return orders.join(owner, orders.o_custkey == owner.c_custkey).select(
        F.col("o_orderkey").alias("entryNo"),
        "Entity",
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
        "region",
    )


DOCUMENTS_SQL = """
o AS (
  SELECT o_orderkey AS "entryNo", n_name AS "Entity", o_orderstatus AS status,
         o_totalprice AS total, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
         o_orderpriority AS priority, r_name AS region
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def supplier_companies(spark: SparkSession, folder: str) -> DataFrame:
    """s_suppkey, s_nationkey, Entity, region; broadcast while measured small."""
    supplier = read(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    named = companies(spark, folder)
    return broadcast_within(
        supplier.join(named, supplier.s_nationkey == named.n_nationkey).select(
            "s_suppkey", "s_nationkey", "Entity", "region"
        )
    )


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the company that booked them; columns of both sides."""
    lines, owner = read(spark, folder, "lineitem"), supplier_companies(spark, folder)
    return lines.join(owner, lines.l_suppkey == owner.s_suppkey)


ENTRIES_SQL = """
e AS (
  SELECT lineitem.*, s_nationkey, n_name AS "Entity", r_name AS region
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def lines(frame: DataFrame) -> DataFrame:
    """Line items as document lines."""
    return frame.select(
        F.col("l_orderkey").alias("no"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("returnflag"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
        F.col("l_suppkey").alias("supplier"),
    )


LINES_SQL = """
d AS (
  SELECT l_orderkey AS no, l_linenumber AS line, l_partkey AS part,
         l_extendedprice AS price, l_quantity AS quantity, l_returnflag AS returnflag,
         strftime(l_shipdate, '%Y-%m-%d') AS ship_date, l_suppkey AS supplier
  FROM lineitem
)"""
