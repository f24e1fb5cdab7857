"""Filters and row-wise projections."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ORDERS_AS_OF, back, day, mean, money, months_back, on, share, total
from tidemark.registry import registered

Tables = Mapping[str, DataFrame]


@registered("""
    SELECT cast(o_orderdate AS date) AS order_date, count(*) AS order_count,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS total_revenue
    FROM orders
    WHERE cast(o_orderdate AS date) BETWEEN date '2001-06-01' AND date '2001-06-30'
    GROUP BY 1
""")
def flt_date_between_daily(t: Tables, lo=date(2001, 6, 1), hi=date(2001, 6, 30)) -> DataFrame:
    days = day("o_orderdate")
    return (
        t["orders"]
        .filter(days.between(on(lo), on(hi)))
        .groupBy(days.alias("order_date"))
        .agg(F.count("*").alias("order_count"), total(money("o_totalprice")).alias("total_revenue"))
    )


@registered("""
    SELECT o_orderpriority AS payment_method,
           count(CASE WHEN o_orderdate >= date '2001-07-02' THEN 1 END) AS orders_30_days,
           count(*) AS orders_3_months,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS revenue_3_months
    FROM orders WHERE o_orderdate >= date '2001-05-01' GROUP BY 1
""")
def flt_relative_window(t: Tables, as_of: date = ORDERS_AS_OF, days: int = 30, months: int = 3) -> DataFrame:
    recent = F.col("o_orderdate") >= on(back(as_of, days))
    return (
        t["orders"]
        .filter(F.col("o_orderdate") >= on(min(back(as_of, days), months_back(as_of, months))))
        .groupBy(F.col("o_orderpriority").alias("payment_method"))
        .agg(
            F.count_if(recent).alias(f"orders_{days}_days"),
            F.count("*").alias(f"orders_{months}_months"),
            total(money("o_totalprice")).alias(f"revenue_{months}_months"),
        )
    )


@registered("""
    SELECT p.p_type AS category, count(DISTINCT o.o_custkey) AS unique_customers, count(*) AS order_count,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) AS revenue
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
    WHERE o.o_orderstatus IN ('F', 'O') AND o.o_orderdate >= date '2000-01-01'
    GROUP BY 1
""")
def flt_in_list(t: Tables, statuses=("F", "O"), since=date(2000, 1, 1)) -> DataFrame:
    chosen = t["orders"].filter(F.col("o_orderstatus").isin(*statuses) & (F.col("o_orderdate") >= on(since)))
    return (
        t["lineitem"]
        .join(chosen, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_type").alias("category"))
        .agg(
            F.countDistinct("o_custkey").alias("unique_customers"),
            F.count("*").alias("order_count"),
            total(money("l_extendedprice")).alias("revenue"),
        )
    )


@registered("""
    SELECT p_partkey, p_name, p_brand, p_type FROM part
    WHERE p_brand LIKE 'Brand#1%' AND p_name ILIKE '%BOLT%' AND p_type NOT ILIKE 'eco%'
""")
def flt_like_prefix(t: Tables, prefix="Brand#1%", anywhere="%BOLT%", without="eco%") -> DataFrame:
    return (
        t["part"]
        .filter(F.col("p_brand").like(prefix) & F.col("p_name").ilike(anywhere) & ~F.col("p_type").ilike(without))
        .select("p_partkey", "p_name", "p_brand", "p_type")
    )


@registered("""
    WITH typed AS (
      SELECT l_orderkey, l_linenumber, l_partkey,
             cast(l_extendedprice AS decimal(12,2)) AS unit_price, cast(l_quantity AS decimal(6,0)) AS quantity,
             cast(nullif(l_discount, 0) AS decimal(4,2)) AS discount
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey,
           cast(round(unit_price * quantity * coalesce(discount, 0), 2) AS double) AS discount_amount,
           cast(round(unit_price * quantity - unit_price * quantity * coalesce(discount, 0), 2) AS double) AS total_amount
    FROM typed
""")
def prj_line_amounts(t: Tables) -> DataFrame:
    gross = money("l_extendedprice") * F.col("l_quantity").cast("decimal(6,0)")
    # A zero discount is stored as NULL in the source this stands for.
    rate = F.nullif(F.col("l_discount"), F.lit(0.0)).cast("decimal(4,2)")
    discount = gross * F.coalesce(rate, F.lit(0).cast("decimal(4,2)"))
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(discount, 2).cast("double").alias("discount_amount"),
        F.round(gross - discount, 2).cast("double").alias("total_amount"),
    )


@registered("""
    SELECT o_orderkey, cast(o_totalprice AS decimal(12,2))::double AS amount,
           CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'medium'
                WHEN o_totalprice < 400000 THEN 'large' ELSE 'very large' END AS amount_band,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing' ELSE 'pending' END AS status_label
    FROM orders
""")
def prj_bucket_case(t: Tables, edges=((50_000, "small"), (200_000, "medium"), (400_000, "large"))) -> DataFrame:
    (first, label), *rest = edges
    band = F.when(F.col("o_totalprice") < first, label)
    for edge, label in rest:
        band = band.when(F.col("o_totalprice") < edge, label)
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "processing")
    return t["orders"].select(
        "o_orderkey",
        money("o_totalprice").cast("double").alias("amount"),
        band.otherwise("very large").alias("amount_band"),
        status.otherwise("pending").alias("status_label"),
    )


@registered("""
    SELECT o_custkey AS customer_id,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS pending_orders,
           count(*) FILTER (WHERE o_orderstatus = 'F') AS delivered_orders,
           round(1e2 * count(*) FILTER (WHERE o_orderstatus = 'P')
                 / nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0), 2) AS pending_pct,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) / count(*) AS avg_amount
    FROM orders GROUP BY 1
""")
def prj_safe_ratio(t: Tables) -> DataFrame:
    pending, delivered = F.count_if(F.col("o_orderstatus") == "P"), F.count_if(F.col("o_orderstatus") == "F")
    return (
        t["orders"]
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(
            pending.alias("pending_orders"),
            delivered.alias("delivered_orders"),
            share(pending, delivered).alias("pending_pct"),
            mean(money("o_totalprice")).alias("avg_amount"),
        )
    )
