"""Grouped and whole-table aggregates."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import EVENTS_AS_OF, ORDERS_AS_OF, back, day, mean, money, on, share, total
from tidemark.operators.joins import amounts_by_customer
from tidemark.registry import registered
from tidemark.sources.footers import stored_counts

Tables = Mapping[str, DataFrame]


@registered("""
    SELECT r.r_name AS region, count(*) AS sales_count,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_amount,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) / count(*) AS avg_amount
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1
""")
def agg_basic_region(t: Tables) -> DataFrame:
    return (
        amounts_by_customer(t["orders"])
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("region"))
        .agg(
            F.sum("n").alias("sales_count"),
            total(F.col("amount")).alias("total_amount"),
            (F.sum("amount").cast("double") / F.sum("n")).alias("avg_amount"),
        )
    )


@registered(
    """
    SELECT o_custkey AS customer_id, count(*) AS order_count,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS total_spent,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) / count(*) AS avg_order_value
    FROM orders WHERE o_orderdate >= date '1999-08-02' GROUP BY 1 HAVING count(*) > 5
    ORDER BY total_spent DESC, customer_id LIMIT 100
    """,
    days=730,
)
def agg_key_having_top(
    t: Tables, as_of: date = ORDERS_AS_OF, days: int = 90, more_than: int = 5, top: int = 100
) -> DataFrame:
    return (
        t["orders"]
        .filter(F.col("o_orderdate") >= on(back(as_of, days)))
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(
            F.count("*").alias("order_count"),
            total(money("o_totalprice")).alias("total_spent"),
            mean(money("o_totalprice")).alias("avg_order_value"),
        )
        .filter(F.col("order_count") > more_than)
        .orderBy(F.desc_nulls_last("total_spent"), "customer_id")
        .limit(top)
    )


@registered("""
    SELECT user_id AS account_id, count(*) AS transaction_count,
           cast(sum(cast(value AS decimal(12,2))) AS double) AS total_amount,
           cast(sum(cast(value AS decimal(12,2))) AS double) / count(*) AS avg_amount,
           min(ts) AS first_transaction, max(ts) AS last_transaction, count(DISTINCT event_type) AS category_count
    FROM events WHERE ts >= date '2023-11-02' GROUP BY 1 HAVING count(*) >= 10
    ORDER BY total_amount DESC, account_id LIMIT 5000
""")
def agg_account_profile(
    t: Tables, as_of: date = EVENTS_AS_OF, days: int = 90, at_least: int = 10, top: int = 5000
) -> DataFrame:
    return (
        t["events"]
        .filter(F.col("ts") >= on(back(as_of, days)))
        .groupBy(F.col("user_id").alias("account_id"))
        .agg(
            F.count("*").alias("transaction_count"),
            total(money("value")).alias("total_amount"),
            mean(money("value")).alias("avg_amount"),
            F.min("ts").alias("first_transaction"),
            F.max("ts").alias("last_transaction"),
            F.countDistinct("event_type").alias("category_count"),
        )
        .filter(F.col("transaction_count") >= at_least)
        .orderBy(F.desc_nulls_last("total_amount"), "account_id")
        .limit(top)
    )


@registered("""
    SELECT event_type AS merchant_category, count(*) AS transaction_count,
           cast(sum(cast(value AS decimal(12,2))) AS double) AS total_amount,
           cast(sum(cast(value AS decimal(12,2))) AS double) / count(*) AS avg_amount,
           count(DISTINCT user_id) AS unique_accounts
    FROM events WHERE ts >= date '2024-01-11' AND value > 0 GROUP BY 1
""", days=20)
def agg_non_key_group(t: Tables, as_of: date = EVENTS_AS_OF, days: int = 90) -> DataFrame:
    return (
        t["events"]
        .filter((F.col("ts") >= on(back(as_of, days))) & (F.col("value") > 0))
        .groupBy(F.col("event_type").alias("merchant_category"))
        .agg(
            F.count("*").alias("transaction_count"),
            total(money("value")).alias("total_amount"),
            mean(money("value")).alias("avg_amount"),
            F.countDistinct("user_id").alias("unique_accounts"),
        )
    )


@registered("""
    SELECT l_partkey AS product_id, count(*) AS sales_count,
           cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS total_revenue
    FROM lineitem GROUP BY 1 ORDER BY total_revenue DESC, product_id LIMIT 100
""")
def agg_product_top(t: Tables, top: int = 100) -> DataFrame:
    return (
        t["lineitem"]
        .groupBy(F.col("l_partkey").alias("product_id"))
        .agg(F.count("*").alias("sales_count"), total(money("l_extendedprice")).alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), "product_id")
        .limit(top)
    )


@registered("""
    SELECT cast(date_trunc('month', o_orderdate) AS date) AS month, count(*) AS order_count,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS total_revenue,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) / count(*) AS avg_order_value
    FROM orders GROUP BY 1
""")
def agg_month_trunc(t: Tables) -> DataFrame:
    return (
        t["orders"]
        .groupBy(day(F.date_trunc("month", "o_orderdate")).alias("month"))
        .agg(
            F.count("*").alias("order_count"),
            total(money("o_totalprice")).alias("total_revenue"),
            mean(money("o_totalprice")).alias("avg_order_value"),
        )
    )


@registered("""
    SELECT o_orderpriority AS payment_method, count(DISTINCT o_custkey) AS unique_customers,
           count(DISTINCT o_orderkey) AS order_count, count(DISTINCT cast(o_orderdate AS date)) AS active_days
    FROM orders GROUP BY 1
""")
def agg_count_distinct_multi(t: Tables) -> DataFrame:
    return (
        t["orders"]
        .groupBy(F.col("o_orderpriority").alias("payment_method"))
        .agg(
            F.countDistinct("o_custkey").alias("unique_customers"),
            F.countDistinct("o_orderkey").alias("order_count"),
            F.countDistinct(day("o_orderdate")).alias("active_days"),
        )
    )


@registered("""
    SELECT user_id, count(*) AS total, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
           count(*) FILTER (WHERE event_type = 'error') AS errors,
           cast(coalesce(sum(cast(value AS decimal(12,2))) FILTER (WHERE event_type = 'purchase'), 0) AS double) AS spent
    FROM events GROUP BY 1
""")
def agg_filter_clause(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    bought = F.sum(F.when(kind == "purchase", money("value")))
    return (
        t["events"]
        .groupBy("user_id")
        .agg(
            F.count("*").alias("total"),
            F.count_if(kind == "purchase").alias("purchases"),
            F.count_if(kind == "error").alias("errors"),
            F.coalesce(bought.cast("double"), F.lit(0.0)).alias("spent"),
        )
    )


@registered("""
    SELECT cast(date_trunc('month', o_orderdate) AS date) AS month,
           cast(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS bigint) AS success_count,
           cast(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS bigint) AS failed_count,
           cast(sum(CASE WHEN o_orderstatus = 'F' THEN cast(o_totalprice AS decimal(12,2)) ELSE 0 END) AS double)
             AS success_amount
    FROM orders GROUP BY 1
""")
def agg_conditional_sum(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return (
        t["orders"]
        .groupBy(day(F.date_trunc("month", "o_orderdate")).alias("month"))
        .agg(
            F.sum(F.when(status == "F", 1).otherwise(0)).alias("success_count"),
            F.sum(F.when(status == "P", 1).otherwise(0)).alias("failed_count"),
            total(F.when(status == "F", money("o_totalprice")).otherwise(0)).alias("success_amount"),
        )
    )


@registered("""
    SELECT n.n_name AS country, count(*) AS segment_count, string_agg(s.seg, ', ' ORDER BY s.seg) AS segments
    FROM (SELECT DISTINCT c_nationkey, c_mktsegment || ':' || count(*) AS seg
          FROM customer GROUP BY c_nationkey, c_mktsegment) s
    JOIN nation n ON s.c_nationkey = n.n_nationkey GROUP BY 1
""")
def agg_string_list(t: Tables) -> DataFrame:
    """Lists the segments of each country; rows are reduced to one per segment before they are strung together."""
    parts = (
        t["customer"]
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(F.count("*").alias("n"))
        .select("c_nationkey", F.concat_ws(":", "c_mktsegment", F.col("n").cast("string")).alias("seg"))
    )
    return (
        parts.join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"))
        .agg(
            F.count("*").alias("segment_count"),
            F.expr("listagg(seg, ', ') WITHIN GROUP (ORDER BY seg)").alias("segments"),
        )
    )


@registered("""
    WITH s AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS row_count FROM orders GROUP BY 1)
    SELECT min(row_count) AS min_rows, max(row_count) AS max_rows,
           cast(round(sum(row_count)::double / count(*)) AS bigint) AS avg_rows,
           cast(round(stddev_samp(row_count)) AS bigint) AS stddev_rows,
           round(1e2 * (max(row_count) - min(row_count)) / nullif(sum(row_count)::double / count(*), 0), 2) AS skew_percent
    FROM s
""")
def agg_stddev_skew(t: Tables) -> DataFrame:
    """Spread of the rows over the month directories of the stored orders."""
    counts = stored_counts(t["orders"], F.year("o_orderdate") * 100 + F.month("o_orderdate"))
    average = F.sum("row_count").cast("double") / F.count("*")
    return counts.agg(
        F.min("row_count").alias("min_rows"),
        F.max("row_count").alias("max_rows"),
        F.round(average).cast("bigint").alias("avg_rows"),
        F.round(F.stddev_samp("row_count")).cast("bigint").alias("stddev_rows"),
        share(F.max("row_count") - F.min("row_count"), average).alias("skew_percent"),
    )


@registered("""
    SELECT o_orderpriority AS category,
           cast(json_object('total_orders', count(*), 'delivered', count(*) FILTER (WHERE o_orderstatus = 'F'),
                'first_day', strftime(min(o_orderdate), '%Y-%m-%d'),
                'status', CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') = 0 THEN 'HEALTHY' ELSE 'UNHEALTHY' END)
                AS varchar) AS metrics
    FROM orders GROUP BY 1
""")
def agg_json_report(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    metrics = F.struct(
        F.count("*").alias("total_orders"),
        F.count_if(status == "F").alias("delivered"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first_day"),
        F.when(F.count_if(status == "P") == 0, "HEALTHY").otherwise("UNHEALTHY").alias("status"),
    )
    return t["orders"].groupBy(F.col("o_orderpriority").alias("category")).agg(F.to_json(metrics).alias("metrics"))


@registered(
    """
    WITH s AS (SELECT o_custkey, count(*) AS n, sum(cast(o_totalprice AS decimal(12,2))) AS spent
               FROM orders WHERE o_orderdate >= date '2000-08-01' GROUP BY 1)
    SELECT c.c_mktsegment AS customer_segment, count(*) AS customer_count,
           cast(sum(s.spent) AS double) AS segment_revenue, cast(sum(s.n) AS double) / count(*) AS avg_orders_per_customer
    FROM s JOIN customer c ON s.o_custkey = c.c_custkey WHERE s.spent > 500000 GROUP BY 1
    """,
    more_than=500_000,
)
def agg_of_agg_segments(t: Tables, as_of: date = ORDERS_AS_OF, days: int = 365, more_than: int = 10_000) -> DataFrame:
    stats = amounts_by_customer(t["orders"].filter(F.col("o_orderdate") >= on(back(as_of, days))))
    return (
        stats.filter(F.col("amount") > more_than)
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("customer_segment"))
        .agg(
            F.count("*").alias("customer_count"),
            total(F.col("amount")).alias("segment_revenue"),
            (F.sum("n").cast("double") / F.count("*")).alias("avg_orders_per_customer"),
        )
    )


@registered("""
    SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
""")
def agg_find_duplicates(t: Tables, keys=("l_orderkey", "l_linenumber")) -> DataFrame:
    return t["lineitem"].groupBy(*keys).agg(F.count("*").alias("duplicate_count")).filter(F.col("duplicate_count") > 1)


@registered("""
    SELECT cast(json_extract_string(props, '$.k') AS bigint) AS k, event_type, count(*) AS event_count,
           count(DISTINCT user_id) AS unique_users, min(ts) AS first_occurrence, max(ts) AS last_occurrence
    FROM events GROUP BY 1, 2
""")
def agg_json_event_type(t: Tables) -> DataFrame:
    return (
        t["events"]
        .groupBy(F.get_json_object("props", "$.k").cast("bigint").alias("k"), "event_type")
        .agg(
            F.count("*").alias("event_count"),
            F.countDistinct("user_id").alias("unique_users"),
            F.min("ts").alias("first_occurrence"),
            F.max("ts").alias("last_occurrence"),
        )
    )


@registered("""
    SELECT count(*) AS total_rows, cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS total_amount,
           cast(min(l_shipdate) AS date) AS first_date, cast(max(l_shipdate) AS date) AS last_date,
           count(*) FILTER (WHERE l_discount = 0) AS undiscounted
    FROM lineitem
""")
def agg_single_total(t: Tables) -> DataFrame:
    return t["lineitem"].agg(
        F.count("*").alias("total_rows"),
        total(money("l_extendedprice")).alias("total_amount"),
        day(F.min("l_shipdate")).alias("first_date"),
        day(F.max("l_shipdate")).alias("last_date"),
        F.count_if(F.col("l_discount") == 0).alias("undiscounted"),
    )
