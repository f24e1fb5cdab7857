"""Subquery forms: IN / NOT IN, correlated scalars, and their join rewrites."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ORDERS_AS_OF, back, day, money, on, total
from tidemark.registry import registered

Tables = Mapping[str, DataFrame]


def not_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """``key NOT IN (SELECT sub_key ...)`` with its NULL rules, as a shuffled anti join.

    A NULL in the subquery leaves no row; a NULL key survives only an empty subquery.
    Spark's own null-aware anti join broadcasts the subquery; this one need not.
    """
    facts = sub.agg(
        F.count("*").alias("rows"), F.count_if(F.col(sub_key).isNull()).alias("nulls")
    )
    rows, nulls = facts.select("rows").scalar(), facts.select("nulls").scalar()
    present = sub.filter(F.col(sub_key).isNotNull()).select(F.col(sub_key).alias("_sub_key"))
    return df.join(present, F.col(key) == F.col("_sub_key"), "left_anti").filter(
        (nulls == 0) & (F.col(key).isNotNull() | (rows == 0))
    )


@registered("""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total_amount FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
      AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def sub_in(t: Tables, customer_segment: str = "BUILDING", flag: str = "R") -> DataFrame:
    members = t["customer"].filter(F.col("c_mktsegment") == customer_segment)
    returned = t["lineitem"].filter(F.col("l_returnflag") == flag)
    chosen = t["orders"].join(members, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return not_in(chosen, "o_orderkey", returned, "l_orderkey").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
    )


_TOP_RECENT = """
    SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_id,
           (SELECT count(*) FROM orders x WHERE x.o_custkey = o.o_custkey) AS total_orders,
           (SELECT cast(sum(cast(x.o_totalprice AS decimal(12,2))) AS double) FROM orders x
            WHERE x.o_custkey = o.o_custkey) AS total_spent,
           cast(o.o_orderdate AS date) AS order_date, o.o_totalprice AS total_amount
    FROM orders o WHERE o.o_orderdate >= date '2001-07-02'
    ORDER BY o.o_totalprice DESC, o.o_orderkey LIMIT 20
"""


@registered(_TOP_RECENT)
def sub_scalar_correlated(t: Tables, as_of: date = ORDERS_AS_OF, days: int = 30, top: int = 20) -> DataFrame:
    """Two scalar subqueries per row; Catalyst turns both into outer joins with aggregates.

    The order and limit stand beside the subqueries: over an input that is already
    sorted and limited, Spark 4.1 moves the limit past the rewritten join and drops the sort.
    """
    orders = t["orders"]
    return orders.sparkSession.sql(
        """
        SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_id,
               (SELECT count(*) FROM {orders} x WHERE x.o_custkey = o.o_custkey) AS total_orders,
               (SELECT cast(sum(cast(x.o_totalprice AS decimal(12,2))) AS double) FROM {orders} x
                WHERE x.o_custkey = o.o_custkey) AS total_spent,
               cast(o.o_orderdate AS date) AS order_date, o.o_totalprice AS total_amount
        FROM {recent} o ORDER BY o.o_totalprice DESC, o.o_orderkey LIMIT {top}
        """,
        orders=orders,
        recent=orders.filter(F.col("o_orderdate") >= on(back(as_of, days))),
        top=top,
    )


def _top_recent(orders: DataFrame, as_of: date, days: int, top: int) -> DataFrame:
    """The top orders alone; the totals of their customers are looked up afterwards."""
    return (
        orders.filter(F.col("o_orderdate") >= on(back(as_of, days)))
        .orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey")
        .limit(top)
    )


@registered(_TOP_RECENT)
def sub_cte_rewrite(t: Tables, as_of: date = ORDERS_AS_OF, days: int = 30, top: int = 20) -> DataFrame:
    """One aggregate joined back instead of two subqueries, over the customers that are needed."""
    orders = t["orders"]
    recent = _top_recent(orders, as_of, days, top)
    stats = (
        orders.join(recent.select(F.col("o_custkey").alias("k")), F.col("o_custkey") == F.col("k"), "left_semi")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.count("*").alias("total_orders"), total(money("o_totalprice")).alias("total_spent"))
    )
    return recent.join(stats, F.col("o_custkey") == F.col("customer_id")).select(
        "customer_id",
        F.col("o_orderkey").alias("order_id"),
        "total_orders",
        "total_spent",
        day("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
    )


@registered("""
    SELECT n.n_name AS country, m.customer_id, m.month, m.revenue, s.total
    FROM (SELECT o_custkey AS customer_id, cast(date_trunc('month', o_orderdate) AS date) AS month,
                 cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS revenue
          FROM orders WHERE o_orderdate >= date '2001-01-01' GROUP BY 1, 2) m
    JOIN (SELECT o_custkey AS customer_id, cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS total
          FROM orders WHERE o_orderdate >= date '2001-01-01' GROUP BY 1) s ON m.customer_id = s.customer_id
    JOIN customer c ON m.customer_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def sub_derived_join(t: Tables, since=date(2001, 1, 1)) -> DataFrame:
    """Monthly and whole-period revenue per customer; the second rolls up the first instead of scanning again."""
    monthly = (
        t["orders"]
        .filter(F.col("o_orderdate") >= on(since))
        .groupBy(F.col("o_custkey").alias("customer_id"), day(F.date_trunc("month", "o_orderdate")).alias("month"))
        .agg(F.sum(money("o_totalprice")).alias("amount"))
    )
    whole = monthly.groupBy(F.col("customer_id").alias("k")).agg(total(F.col("amount")).alias("total"))
    return (
        monthly.join(whole, F.col("customer_id") == F.col("k"))
        .join(t["customer"], F.col("customer_id") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("country"), "customer_id", "month", F.col("amount").cast("double").alias("revenue"), "total"
        )
    )
