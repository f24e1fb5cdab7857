"""Top-k reports and sorts.  ``orderBy().limit()`` keeps k rows per task and merges them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import day, money, total
from tidemark.operators.joins import amounts_by_customer
from tidemark.registry import registered

Tables = Mapping[str, DataFrame]


@registered("""
    SELECT p.p_name AS product_name, p.p_type AS category_name,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2)) * (1 - cast(l.l_discount AS decimal(4,2)))) AS double) AS revenue,
           sum(l.l_quantity) AS quantity_sold
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    GROUP BY 1, 2 ORDER BY revenue DESC, product_name, category_name LIMIT 10
""")
def top_products_revenue(t: Tables, top: int = 10) -> DataFrame:
    net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    by_part = t["lineitem"].groupBy("l_partkey").agg(F.sum(net).alias("net"), F.sum("l_quantity").alias("quantity"))
    return (
        by_part.join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_name").alias("product_name"), F.col("p_type").alias("category_name"))
        .agg(total(F.col("net")).alias("revenue"), F.sum("quantity").alias("quantity_sold"))
        .orderBy(F.desc_nulls_last("revenue"), "product_name", "category_name")
        .limit(top)
    )


@registered("""
    SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS country, count(*) AS order_count,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_spent
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY 1, 2, 3 ORDER BY total_spent DESC, customer_id LIMIT 10
""")
def top_customers_spend(t: Tables, top: int = 10) -> DataFrame:
    """The top is taken on the customer key alone; names are looked up for the winners only."""
    winners = (
        amounts_by_customer(t["orders"])
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .orderBy(F.desc_nulls_last("amount"), "o_custkey")
        .limit(top)
    )
    return (
        winners.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("country"),
            F.col("n").alias("order_count"),
            F.col("amount").cast("double").alias("total_spent"),
        )
    )


@registered("""
    SELECT o_custkey AS customer_id, count(*) AS order_count FROM orders
    GROUP BY 1 ORDER BY order_count DESC, customer_id LIMIT 20
""")
def top_hot_keys(t: Tables, top: int = 20) -> DataFrame:
    return (
        t["orders"]
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.count("*").alias("order_count"))
        .orderBy(F.desc("order_count"), "customer_id")
        .limit(top)
    )


@registered("""
    SELECT cast(date_trunc('month', o_orderdate) AS date) AS order_month, o_orderpriority AS payment_method,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS revenue
    FROM orders GROUP BY 1, 2 ORDER BY order_month DESC, revenue DESC, payment_method ASC
""")
def sort_multi_key(t: Tables) -> DataFrame:
    return (
        t["orders"]
        .groupBy(
            day(F.date_trunc("month", "o_orderdate")).alias("order_month"),
            F.col("o_orderpriority").alias("payment_method"),
        )
        .agg(total(money("o_totalprice")).alias("revenue"))
        .orderBy(F.desc_nulls_first("order_month"), F.desc_nulls_first("revenue"), F.asc_nulls_last("payment_method"))
    )


@registered("""
    SELECT o_orderkey AS order_id, cast(o_orderdate AS date) AS order_date, o_totalprice AS total_amount
    FROM orders WHERE o_orderdate >= date '2000-10-01' ORDER BY o_orderkey LIMIT 100
""")
def limit_arbitrary(t: Tables, since="2000-10-01", rows: int = 100) -> DataFrame:
    """A LIMIT without an order of its own, made repeatable by the key."""
    return (
        t["orders"]
        .filter(F.col("o_orderdate") >= F.lit(since).cast("date"))
        .orderBy("o_orderkey")
        .limit(rows)
        .select(
            F.col("o_orderkey").alias("order_id"),
            day("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("total_amount"),
        )
    )
