"""Seven report queries over the order tables, in either table format.

Dates are given as ISO text. In most queries a date selects every day whose ISO form contains it, so
``1996``, ``1996-11`` and ``1996-11-01`` name a year, a month and a day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import date_after, date_before, date_contains, month_of
from millrace.sources.tables import read_table


def _column(table: DataFrame, preferred: str, otherwise: str) -> str:
    """``preferred`` if the table has it."""
    return preferred if preferred in table.columns else otherwise


def _shipped(spark: SparkSession, directory: str, date: str, fmt: str) -> DataFrame:
    return read_table(spark, directory, "lineitem", fmt).where(date_contains(F.col("l_shipdate"), date))


def _revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def q1_shipped_count(spark: SparkSession, directory: str, date: str, fmt: str = "parquet") -> DataFrame:
    """How many line items were shipped on a date."""
    return _shipped(spark, directory, date, fmt).agg(F.count("*").alias("answer"))


def q2_orders_of_date(
    spark: SparkSession,
    directory: str,
    date: str,
    n: int = 20,
    fanout: bool = False,
    clerk: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Clerk and key of the first ``n`` orders with a line item shipped on a date.

    An order is listed once however many of its items match, or once per item with ``fanout``. Tables
    without a clerk show the order priority. Items are counted per order before the join, on the same
    key, so an order of very many items is one row of it.
    """
    items = _shipped(spark, directory, date, fmt).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    orders = read_table(spark, directory, "orders", fmt)
    clerk = clerk or _column(orders, "o_clerk", "o_orderpriority")
    orders = orders.select("o_orderkey", clerk)
    if fanout:
        # Among the first n rows no order can have more than n.
        shown = F.least(F.col("n"), F.lit(n).cast("long"))
        matched = orders.join(items, "o_orderkey").select("o_orderkey", clerk, F.explode(F.sequence(F.lit(1).cast("long"), shown)))
    else:
        matched = orders.join(items, "o_orderkey", "left_semi")
    return matched.select(F.col(clerk).alias("clerk"), F.col("o_orderkey").alias("orderkey")).orderBy("orderkey").limit(n)


def q3_part_supplier(spark: SparkSession, directory: str, date: str, n: int = 20, fmt: str = "parquet") -> DataFrame:
    """Order key, part name and supplier name of the first ``n`` line items shipped on a date."""
    items = _shipped(spark, directory, date, fmt).select("l_orderkey", "l_partkey", "l_suppkey")
    part = read_table(spark, directory, "part", fmt).select(F.col("p_partkey").alias("l_partkey"), "p_name")
    supplier = read_table(spark, directory, "supplier", fmt).select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    named = items.join(part, "l_partkey").join(supplier, "l_suppkey")
    return named.select(F.col("l_orderkey").alias("orderkey"), "p_name", "s_name").orderBy("orderkey", "p_name", "s_name").limit(n)


def q4_shipped_by_nation(spark: SparkSession, directory: str, date: str, fmt: str = "parquet") -> DataFrame:
    """Number of line items shipped on a date per nation of the customer.

    Items are counted per order before the join with the orders, on the same key, and per customer
    before the one with the customers: what moves between tasks are counts, whatever key is frequent.
    """
    items = _shipped(spark, directory, date, fmt).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    orders = read_table(spark, directory, "orders", fmt).select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = read_table(spark, directory, "customer", fmt).select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nation = read_table(spark, directory, "nation", fmt).select("n_nationkey", "n_name")
    per_customer = items.join(orders, "o_orderkey").groupBy("c_custkey").agg(F.sum("n").alias("n"))
    per_nation = per_customer.join(customer, "c_custkey").groupBy("n_nationkey").agg(F.sum("n").alias("n"))
    return (
        per_nation.join(nation, "n_nationkey")
        .select("n_nationkey", "n_name", F.col("n").alias("items"))
        .orderBy("n_nationkey")
    )


def q5_monthly_by_nation(
    spark: SparkSession, directory: str, nations: Sequence[int] = (3, 24), fmt: str = "parquet"
) -> DataFrame:
    """Number of line items shipped per month to customers of the given nations.

    Items meet the orders of these customers first, as few of them stay; then they are counted per nation and month.
    """
    wanted = list(nations)
    customer = (
        read_table(spark, directory, "customer", fmt)
        .where(F.col("c_nationkey").isin(wanted))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    )
    nation = read_table(spark, directory, "nation", fmt).where(F.col("n_nationkey").isin(wanted)).select("n_nationkey", "n_name")
    orders = read_table(spark, directory, "orders", fmt).select("o_orderkey", "o_custkey").join(customer, "o_custkey")
    items = read_table(spark, directory, "lineitem", fmt).select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    shipped = items.join(orders.select("o_orderkey", "n_nationkey"), "o_orderkey")
    # One day of each month stands for it until it is written out, once per group.
    day = F.trunc("l_shipdate", "month").alias("_day")
    monthly = shipped.groupBy("n_nationkey", day).agg(F.count("*").alias("items"))
    monthly = monthly.withColumn("month", month_of(F.col("_day")))
    return (
        monthly.join(nation, "n_nationkey")
        .select("n_nationkey", "n_name", "month", "items")
        .orderBy("n_nationkey", "month")
    )


def q6_pricing_summary(spark: SparkSession, directory: str, date: str, fmt: str = "parquet") -> DataFrame:
    """Sums, averages and number of the line items shipped on a date, per return flag and line status."""
    charge = _revenue() * (1 + F.col("l_tax"))
    return (
        _shipped(spark, directory, date, fmt)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_base_price"),
            F.sum(_revenue()).alias("sum_disc_price"),
            F.sum(charge).alias("sum_charge"),
            F.avg("l_quantity").alias("avg_qty"),
            F.avg("l_extendedprice").alias("avg_price"),
            F.avg("l_discount").alias("avg_disc"),
            F.count("*").alias("count_order"),
        )
    )


def q7_top_unshipped(
    spark: SparkSession,
    directory: str,
    date: str,
    n: int = 5,
    priority: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The ``n`` orders of highest revenue that were placed before a date and shipped after it.

    Revenue is summed per order before the join, which uses the same key. Tables without a shipping
    priority show the order priority.
    """
    items = (
        read_table(spark, directory, "lineitem", fmt)
        .where(date_after(F.col("l_shipdate"), date))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(_revenue()).alias("revenue"))
    )
    orders = read_table(spark, directory, "orders", fmt).where(date_before(F.col("o_orderdate"), date))
    priority = priority or _column(orders, "o_shippriority", "o_orderpriority")
    orders = orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate", priority)
    customer = read_table(spark, directory, "customer", fmt).select("c_custkey", "c_name")
    return (
        items.join(orders, "o_orderkey")
        .join(customer, "c_custkey")
        .select(
            "c_name",
            F.col("o_orderkey").alias("orderkey"),
            "revenue",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("orderdate"),
            F.col(priority).alias("priority"),
        )
        .orderBy(F.desc("revenue"), "orderkey")
        .limit(n)
    )
