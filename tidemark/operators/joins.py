"""Joins of facts with dimensions, with other facts, and with themselves.

Two rules keep these usable when one key owns a large part of the rows:
a side that only feeds an aggregate is aggregated per join key before it is
joined, and no join lets two facts multiply their rows.  Small dimensions are
broadcast by Spark's own size check, never by an unconditional hint.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import EVENTS_AS_OF, ORDERS_AS_OF, back, day, micros, money, on, total
from tidemark.registry import registered
from tidemark.sources.layouts import colocated_pair, replicated

Tables = Mapping[str, DataFrame]


def amounts_by_customer(orders: DataFrame) -> DataFrame:
    """Orders, amount, and largest amount per customer: the fact side of many dimension joins."""
    return orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"),
        F.sum(money("o_totalprice")).alias("amount"),
        F.max(money("o_totalprice")).alias("largest"),
    )


def with_customer(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders with the columns of their customer.

    Orders meet the customer before the lines meet the order: that way the rows that
    cross the network by customer are orders, not the several times as many lines.
    """
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


@registered("""
    SELECT n.n_name AS country, p.p_type AS category, count(*) AS order_count,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) AS total_revenue,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) / count(*) AS avg_line_value
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN part p ON l.l_partkey = p.p_partkey
    WHERE o.o_orderdate >= date '2001-01-01' GROUP BY 1, 2
""")
def join_star_two_dims(t: Tables, since=date(2001, 1, 1)) -> DataFrame:
    orders = t["orders"].filter(F.col("o_orderdate") >= on(since))
    return (
        t["lineitem"]
        .join(with_customer(orders, t["customer"]), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("c_nationkey", F.col("p_type").alias("category"))
        .agg(F.count("*").alias("order_count"), F.sum(money("l_extendedprice")).alias("revenue"))
        # The country name depends on the nation key only, so it joins the aggregate.
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"), "category")
        .agg(F.sum("order_count").alias("order_count"), F.sum("revenue").alias("revenue"))
        .select(
            "country",
            "category",
            "order_count",
            F.col("revenue").cast("double").alias("total_revenue"),
            (F.col("revenue").cast("double") / F.col("order_count")).alias("avg_line_value"),
        )
    )


@registered("""
    SELECT c.c_mktsegment AS customer_segment, count(*) AS order_count,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_revenue,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) / count(*) AS avg_order_value,
           cast(max(cast(o.o_totalprice AS decimal(12,2))) AS double) AS max_order_value
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_orderdate >= date '2001-05-03' AND o.o_orderstatus = 'F'
    GROUP BY 1 HAVING sum(cast(o.o_totalprice AS decimal(12,2))) > 10000
""")
def join_broadcast_segment(
    t: Tables, as_of: date = ORDERS_AS_OF, days: int = 90, status: str = "F", least: int = 10_000
) -> DataFrame:
    recent = t["orders"].filter((F.col("o_orderdate") >= on(back(as_of, days))) & (F.col("o_orderstatus") == status))
    customers = replicated(t["customer"].select("c_custkey", "c_mktsegment"))
    return (
        amounts_by_customer(recent)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("customer_segment"))
        .agg(F.sum("n").alias("order_count"), F.sum("amount").alias("revenue"), F.max("largest").alias("largest"))
        .filter(F.col("revenue") > least)
        .select(
            "customer_segment",
            "order_count",
            F.col("revenue").cast("double").alias("total_revenue"),
            (F.col("revenue").cast("double") / F.col("order_count")).alias("avg_order_value"),
            F.col("largest").cast("double").alias("max_order_value"),
        )
    )


@registered("""
    SELECT c.c_mktsegment AS customer_segment, count(DISTINCT o.o_custkey) AS unique_customers,
           count(*) AS order_count, cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_revenue
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_orderdate >= date '2001-07-02' GROUP BY 1
""")
def join_colocated_hash(t: Tables, as_of: date = ORDERS_AS_OF, days: int = 30, buckets: int | None = None) -> DataFrame:
    """Both sides are stored bucketed on the customer key, so neither is shuffled for the join.

    The facts are stored as one row per customer: a hot one is summed up before its bucket is written.
    """
    facts, customers = colocated_pair(
        amounts_by_customer(t["orders"].filter(F.col("o_orderdate") >= on(back(as_of, days)))),
        "o_custkey",
        t["customer"].select("c_custkey", "c_mktsegment"),
        "c_custkey",
        buckets,
    )
    return (
        facts.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("customer_segment"))
        .agg(
            F.count("*").alias("unique_customers"),
            F.sum("n").alias("order_count"),
            total(F.col("amount")).alias("total_revenue"),
        )
    )


def _payments(t: Tables, since: date) -> DataFrame:
    """Line items as payments, with the paying customer; dated by the ship date."""
    lines = t["lineitem"].filter(F.col("l_shipdate") >= on(since))
    owner = t["orders"].select("o_orderkey", F.col("o_custkey").alias("payer"))
    return lines.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "payer",
        F.struct("l_orderkey", "l_linenumber").alias("payment_id"),
        money("l_extendedprice").alias("paid"),
        "l_linestatus",
    )


def _payments_by_customer(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payer").agg(
        F.count("*").alias("payment_rows"),
        F.countDistinct("payment_id").alias("payment_count"),
        F.sum("paid").alias("paid"),
        F.sum(F.when(F.col("l_linestatus") == "F", F.col("paid")).otherwise(0)).alias("paid_ok"),
    )


_BALANCE_SOURCE = """
    WITH o AS (SELECT o_custkey AS customer_id, o_orderkey, cast(o_totalprice AS decimal(12,2)) AS amount
               FROM orders WHERE o_orderdate >= date '2000-08-01'),
         p AS (SELECT o_custkey AS customer_id, l_orderkey, l_linenumber, cast(l_extendedprice AS decimal(12,2)) AS paid
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= date '2000-08-01')
"""


@registered(
    _BALANCE_SOURCE
    + """
    SELECT o.customer_id, count(DISTINCT o.o_orderkey) AS order_count,
           count(DISTINCT (p.l_orderkey, p.l_linenumber)) AS payment_count,
           cast(sum(o.amount) AS double) AS total_orders, cast(sum(p.paid) AS double) AS total_payments,
           cast(sum(o.amount) - sum(p.paid) AS double) AS balance
    FROM o JOIN p ON o.customer_id = p.customer_id
    GROUP BY 1 HAVING count(DISTINCT o.o_orderkey) > 2
    ORDER BY balance DESC, customer_id LIMIT 1000
    """,
    days=365,
    more_than=2,
)
def join_fact_fact_balance(
    t: Tables, as_of: date = ORDERS_AS_OF, days: int = 180, more_than: int = 5, top: int = 1000
) -> DataFrame:
    """Orders joined with payments per customer, as written: every order meets every payment.

    The sums over that product are each side's sum times the other side's row count,
    so they are computed from one row per customer and side and no pair is produced.
    """
    since = back(as_of, days)
    orders = (
        t["orders"]
        .filter(F.col("o_orderdate") >= on(since))
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("order_rows"),
            F.countDistinct("o_orderkey").alias("order_count"),
            F.sum(money("o_totalprice")).alias("ordered"),
        )
        .filter(F.col("order_count") > more_than)
    )
    both = orders.join(_payments_by_customer(_payments(t, since)), F.col("o_custkey") == F.col("payer"))
    ordered = F.col("ordered") * F.col("payment_rows")
    paid = F.col("paid") * F.col("order_rows")
    return (
        both.select(
            F.col("o_custkey").alias("customer_id"),
            "order_count",
            "payment_count",
            ordered.cast("double").alias("total_orders"),
            paid.cast("double").alias("total_payments"),
            (ordered - paid).cast("double").alias("balance"),
        )
        .orderBy(F.desc_nulls_last("balance"), "customer_id")
        .limit(top)
    )


@registered(
    _BALANCE_SOURCE
    + """
    , os AS (SELECT customer_id, count(DISTINCT o_orderkey) AS order_count, sum(amount) AS amount FROM o GROUP BY 1),
      ps AS (SELECT customer_id, count(DISTINCT (l_orderkey, l_linenumber)) AS payment_count, sum(paid) AS paid
             FROM p GROUP BY 1)
    SELECT os.customer_id, order_count, payment_count, cast(amount AS double) AS total_orders,
           cast(paid AS double) AS total_payments, cast(amount - paid AS double) AS balance
    FROM os JOIN ps ON os.customer_id = ps.customer_id WHERE order_count > 2
    ORDER BY balance DESC, customer_id LIMIT 1000
    """,
    days=365,
    more_than=2,
)
def join_fact_fact_preagg(
    t: Tables, as_of: date = ORDERS_AS_OF, days: int = 180, more_than: int = 5, top: int = 1000
) -> DataFrame:
    """The balance a reader expects: each side counted once."""
    since = back(as_of, days)
    orders = (
        t["orders"]
        .filter(F.col("o_orderdate") >= on(since))
        .groupBy("o_custkey")
        .agg(F.countDistinct("o_orderkey").alias("order_count"), F.sum(money("o_totalprice")).alias("ordered"))
        .filter(F.col("order_count") > more_than)
    )
    return (
        orders.join(_payments_by_customer(_payments(t, since)), F.col("o_custkey") == F.col("payer"))
        .select(
            F.col("o_custkey").alias("customer_id"),
            "order_count",
            "payment_count",
            F.col("ordered").cast("double").alias("total_orders"),
            F.col("paid").cast("double").alias("total_payments"),
            (F.col("ordered") - F.col("paid")).cast("double").alias("balance"),
        )
        .orderBy(F.desc_nulls_last("balance"), "customer_id")
        .limit(top)
    )


@registered(
    """
    WITH p AS (SELECT o_custkey AS customer_id, l_orderkey, l_linenumber, l_linestatus,
                      cast(l_extendedprice AS decimal(12,2)) AS paid
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= date '2001-02-02')
    SELECT c.c_mktsegment AS customer_segment, cast(date_trunc('month', o.o_orderdate) AS date) AS order_month,
           count(DISTINCT o.o_custkey) AS unique_customers, count(DISTINCT o.o_orderkey) AS order_count,
           count(DISTINCT (p.l_orderkey, p.l_linenumber)) AS payment_count,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_orders,
           cast(sum(p.paid) AS double) AS total_payments,
           cast(sum(CASE WHEN p.l_linestatus = 'F' THEN p.paid ELSE 0 END) AS double) AS successful_payments,
           round(cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) / count(*), 2) AS avg_order_value
    FROM orders o JOIN p ON o.o_custkey = p.customer_id JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_orderdate >= date '2001-02-02' AND o.o_orderstatus IN ('F', 'O')
    GROUP BY 1, 2 HAVING count(DISTINCT o.o_orderkey) > 5
    """,
    more_than=5,
)
def join_multi_conditional(
    t: Tables, as_of: date = ORDERS_AS_OF, days: int = 180, statuses=("F", "O"), more_than: int = 100
) -> DataFrame:
    """Orders x payments x customers by segment and month, without building the product.

    A customer's payments belong to no other customer, so distinct counts add up over
    customers, and sums over the product are sums times the other side's row count.
    """
    since = back(as_of, days)
    monthly = (
        t["orders"]
        .filter((F.col("o_orderdate") >= on(since)) & F.col("o_orderstatus").isin(*statuses))
        .groupBy("o_custkey", day(F.date_trunc("month", "o_orderdate")).alias("order_month"))
        .agg(
            F.count("*").alias("order_rows"),
            F.countDistinct("o_orderkey").alias("orders"),
            F.sum(money("o_totalprice")).alias("ordered"),
        )
    )
    pairs = F.col("order_rows") * F.col("payment_rows")
    return (
        monthly.join(_payments_by_customer(_payments(t, since)), F.col("o_custkey") == F.col("payer"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("customer_segment"), "order_month")
        .agg(
            F.count("*").alias("unique_customers"),
            F.sum("orders").alias("order_count"),
            F.sum("payment_count").alias("payment_count"),
            total(F.col("ordered") * F.col("payment_rows")).alias("total_orders"),
            total(F.col("paid") * F.col("order_rows")).alias("total_payments"),
            total(F.col("paid_ok") * F.col("order_rows")).alias("successful_payments"),
            F.sum(pairs).alias("pairs"),
        )
        .filter(F.col("order_count") > more_than)
        .withColumn("avg_order_value", F.round(F.col("total_orders") / F.col("pairs"), 2))
        .drop("pairs")
    )


@registered("""
    SELECT o.o_orderkey AS order_id, cast(o.o_orderdate AS date) AS order_date,
           count(l.l_orderkey) AS item_count, sum(l.l_quantity) AS total_quantity
    FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
    WHERE o.o_orderdate >= date '2000-10-01' GROUP BY 1, 2
""")
def join_left_count(t: Tables, since=date(2000, 10, 1)) -> DataFrame:
    items = (
        t["lineitem"]
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("item_count"), F.sum("l_quantity").alias("total_quantity"))
    )
    return (
        t["orders"]
        .filter(F.col("o_orderdate") >= on(since))
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            day("o_orderdate").alias("order_date"),
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            "total_quantity",
        )
    )


@registered("""
    SELECT n.n_name AS country_name, r.r_name AS region, count(*) AS user_count,
           count(DISTINCT o.o_orderkey) AS transaction_count,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_amount
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY 1, 2
""")
def join_left_two_level(t: Tables) -> DataFrame:
    """``user_count`` counts joined rows, as the statement does: a user with k orders counts k times."""
    spent = (
        t["orders"]
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("order_rows"),
            F.countDistinct("o_orderkey").alias("orders"),
            F.sum(money("o_totalprice")).alias("amount"),
        )
    )
    per_nation = (
        t["customer"]
        .join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy("c_nationkey")
        .agg(
            F.sum(F.coalesce("order_rows", F.lit(1))).alias("user_count"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("transaction_count"),
            total(F.col("amount")).alias("total_amount"),
        )
    )
    return (
        per_nation.join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("country_name"),
            F.col("r_name").alias("region"),
            "user_count",
            "transaction_count",
            "total_amount",
        )
    )


@registered("""
    SELECT o.o_orderkey AS order_id, cast(o.o_orderdate AS date) AS order_date, o.o_orderstatus AS status,
           c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS country, c.c_mktsegment AS customer_segment,
           p.p_partkey AS product_id, p.p_name AS product_name, p.p_type AS category_name, l.l_quantity AS quantity,
           l.l_extendedprice AS unit_price, l.l_discount AS discount,
           cast(cast(l.l_extendedprice AS decimal(12,2)) * (1 - cast(l.l_discount AS decimal(4,2))) AS double) AS subtotal,
           o.o_totalprice AS order_total
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
""")
def join_order_details(t: Tables) -> DataFrame:
    rate = F.col("l_discount").cast("decimal(4,2)")
    placed = with_customer(t["orders"], t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")))
    return (
        t["lineitem"]
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            day("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("status"),
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_name"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_discount").alias("discount"),
            (money("l_extendedprice") * (1 - rate)).cast("double").alias("subtotal"),
            F.col("o_totalprice").alias("order_total"),
        )
    )


@registered("""
    SELECT count(*) AS joined_rows FROM lineitem t1 JOIN lineitem t2 USING (l_partkey)
""")
def join_self_using(t: Tables, key: str = "l_partkey") -> DataFrame:
    """Row count of a self join: a key with n rows contributes n * n, found without pairing rows."""
    counts = t["lineitem"].filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(F.sum(F.col("n") * F.col("n")).alias("joined_rows"))


@registered("""
    WITH o AS (SELECT count(*) AS total_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS delivered_orders,
                      count(*) FILTER (WHERE o_orderstatus = 'P') AS pending_orders FROM orders),
         c AS (SELECT count(*) AS total_customers, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt FROM customer),
         e AS (SELECT count(*) AS total_events, max(ts) AS last_event FROM events)
    SELECT 'Shop Health' AS category, total_orders, delivered_orders, pending_orders, total_customers, in_debt,
           total_events, last_event,
           CASE WHEN pending_orders = 0 THEN 'HEALTHY' ELSE 'UNHEALTHY' END AS health_status
    FROM o CROSS JOIN c CROSS JOIN e
""")
def join_cross_scalar(t: Tables) -> DataFrame:
    """One row from three one-row aggregates, as scalar subqueries."""
    status = F.col("o_orderstatus")
    orders = t["orders"].agg(
        F.count("*").alias("total_orders"),
        F.count_if(status == "F").alias("delivered_orders"),
        F.count_if(status == "P").alias("pending_orders"),
    )
    customers = t["customer"].agg(F.count("*").alias("total_customers"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"))
    events = t["events"].agg(F.count("*").alias("total_events"), F.max("ts").alias("last_event"))
    return orders.select(
        F.lit("Shop Health").alias("category"),
        "*",
        *[customers.select(c).scalar().alias(c) for c in customers.columns],
        *[events.select(c).scalar().alias(c) for c in events.columns],
        F.when(F.col("pending_orders") == 0, "HEALTHY").otherwise("UNHEALTHY").alias("health_status"),
    )


@registered("""
    WITH k AS (SELECT event_id, event_type, nullif(user_id % 40, 0) AS grp, nullif(hour(ts), 0) AS slot, ts FROM events)
    SELECT w.event_id AS waiting_id, count(*) AS holder_count, min(h.event_id) AS first_holder, max(h.ts) AS last_held
    FROM k w JOIN k h ON w.grp IS NOT DISTINCT FROM h.grp AND w.slot IS NOT DISTINCT FROM h.slot
    WHERE w.event_type = 'error' AND h.event_type = 'purchase'
    GROUP BY 1
""")
def join_null_safe(t: Tables, waiting: str = "error", holding: str = "purchase") -> DataFrame:
    """Waiting rows matched to the holders of the same, possibly NULL, composite key."""
    keyed = t["events"].select(
        "event_id",
        "event_type",
        F.nullif(F.col("user_id") % 40, F.lit(0)).alias("grp"),
        F.nullif(F.hour("ts"), F.lit(0)).alias("slot"),
        "ts",
    )
    holders = (
        keyed.filter(F.col("event_type") == holding)
        .groupBy(F.col("grp").alias("h_grp"), F.col("slot").alias("h_slot"))
        .agg(F.count("*").alias("holder_count"), F.min("event_id").alias("first_holder"), F.max("ts").alias("last_held"))
    )
    same = F.col("grp").eqNullSafe(F.col("h_grp")) & F.col("slot").eqNullSafe(F.col("h_slot"))
    return (
        keyed.filter(F.col("event_type") == waiting)
        .join(holders, same)
        .select(F.col("event_id").alias("waiting_id"), "holder_count", "first_holder", "last_held")
    )


_LATER_LARGER = """
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, cast(o.o_orderdate AS date) AS order_date,
           o.o_totalprice AS total_amount
    FROM orders o
    WHERE EXISTS (SELECT 1 FROM orders o2 WHERE o2.o_custkey = o.o_custkey
                  AND o2.o_orderdate > o.o_orderdate AND o2.o_totalprice > o.o_totalprice)
"""


def _largest_later(orders: DataFrame) -> DataFrame:
    """Per customer and day, the largest amount on any later day.

    Orders are reduced to one row per customer and day first, so the window of a
    customer is never longer than the calendar, however many orders it has.
    """
    days = orders.groupBy(F.col("o_custkey").alias("k"), day("o_orderdate").alias("d")).agg(
        F.max("o_totalprice").alias("largest")
    )
    later = W.partitionBy("k").orderBy(F.unix_date("d")).rangeBetween(1, W.unboundedFollowing)
    return days.select("k", "d", F.max("largest").over(later).alias("later_largest"))


def _order_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
    )


def _same_customer_day() -> Column:
    return (F.col("o_custkey") == F.col("k")) & (day("o_orderdate") == F.col("d"))


@registered(_LATER_LARGER)
def join_semi_later_larger(t: Tables) -> DataFrame:
    """EXISTS a later, larger order of the same customer, as a semi join with at most one partner per row."""
    orders = t["orders"]
    exceeded = _same_customer_day() & (F.col("later_largest") > F.col("o_totalprice"))
    return _order_columns(orders.join(_largest_later(orders), exceeded, "left_semi"))


@registered(_LATER_LARGER)
def join_semi_later_larger_window(t: Tables) -> DataFrame:
    """The same question answered by the RANGE frame itself: look the running maximum up and compare."""
    orders = t["orders"]
    found = orders.join(_largest_later(orders), _same_customer_day())
    return _order_columns(found.filter(F.col("later_largest") > F.col("o_totalprice")))


@registered("""
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, 'no returned line' AS reason
    FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') v
      ON o.o_orderkey = v.l_orderkey
    WHERE v.l_orderkey IS NULL
""")
def join_anti_left_null(t: Tables, flag: str = "R") -> DataFrame:
    valid = t["lineitem"].filter(F.col("l_returnflag") == flag)
    return (
        t["orders"]
        .join(valid, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.lit("no returned line").alias("reason"),
        )
    )


@registered("""
    SELECT p.p_partkey AS product_id, p.p_name AS product_name FROM part p
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_shipdate >= date '2001-06-01')
""")
def join_anti_not_exists(t: Tables, since=date(2001, 6, 1)) -> DataFrame:
    source = t["lineitem"].filter(F.col("l_shipdate") >= on(since))
    return (
        t["part"]
        .join(source, F.col("p_partkey") == F.col("l_partkey"), "left_anti")
        .select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
    )


def near_in_time(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int
) -> DataFrame:
    """Rows of both sides with an equal key whose times differ by at most ``seconds``.

    Time is cut into slots of that length; a right row is offered to its own slot and
    the two beside it, so the equi join is on (key, slot) and a busy key spreads out.
    """
    span = seconds * 1_000_000
    left_at, right_at = micros(left_ts), micros(right_ts)
    slot = F.floor(right_at / F.lit(span))
    offered = right.withColumnRenamed(key, f"_{key}").withColumn("_slot_r", F.explode(F.sequence(slot - 1, slot + 1)))
    return (
        left.withColumn("_slot", F.floor(left_at / F.lit(span)))
        .join(
            offered,
            (F.col(key) == F.col(f"_{key}"))
            & (F.col("_slot") == F.col("_slot_r"))
            & (left_at - right_at).between(-span, span),
        )
        .drop("_slot", "_slot_r", f"_{key}")
    )


@registered("""
    SELECT e.user_id, e.event_id, e.ts AS event_ts, p.event_id AS purchase_id, p.ts AS purchase_ts, p.value AS amount
    FROM events e JOIN events p ON e.user_id = p.user_id
      AND p.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts + INTERVAL 1 HOUR
    WHERE e.event_type = 'click' AND p.event_type = 'purchase'
""")
def join_interval_events(t: Tables, kind: str = "click", seconds: int = 3600) -> DataFrame:
    events = t["events"]
    clicks = events.filter(F.col("event_type") == kind).select("user_id", "event_id", F.col("ts").alias("event_ts"))
    purchases = events.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"), F.col("value").alias("amount")
    )
    return near_in_time(clicks, purchases, "user_id", "event_ts", "purchase_ts", seconds)


@registered("""
    SELECT v.table_name, max(e.ts) AS last_load
    FROM (VALUES ('click'), ('purchase'), ('refund')) v(table_name) LEFT JOIN events e ON e.event_type = v.table_name
    GROUP BY 1 HAVING max(e.ts) < TIMESTAMP '2024-01-31 00:00:00' OR max(e.ts) IS NULL
""", hours=0)
def join_values_left(
    t: Tables, expected=("click", "purchase", "refund"), as_of: date = EVENTS_AS_OF, hours: int = 24
) -> DataFrame:
    """Names from a fixed list whose last log entry is missing or older than the limit."""
    limit = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz") - F.expr(f"make_dt_interval(0, {int(hours)})")
    log = t["events"]
    last = log.groupBy("event_type").agg(F.max("ts").alias("last_load"))
    names = log.sparkSession.createDataFrame([(name,) for name in expected], "table_name string")
    return (
        names.join(last, F.col("table_name") == F.col("event_type"), "left")
        .filter((F.col("last_load") < limit) | F.col("last_load").isNull())
        .select("table_name", "last_load")
    )


@registered("""
    SELECT l_orderkey AS order_id, 1 AS item_no, l_partkey AS item_id, l_quantity AS quantity FROM lineitem
    UNION ALL
    SELECT l_orderkey, 2, l_suppkey, cast(l_linenumber AS double) FROM lineitem
""")
def join_lateral_array(t: Tables) -> DataFrame:
    """Each row meets the elements of its own JSON array."""
    items = F.array(
        F.struct(F.lit(1).alias("no"), F.col("l_partkey").alias("id"), F.col("l_quantity").alias("qty")),
        F.struct(F.lit(2).alias("no"), F.col("l_suppkey").alias("id"), F.col("l_linenumber").cast("double").alias("qty")),
    )
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_linenumber")
    docs = lines.select(F.col("l_orderkey").alias("order_id"), F.to_json(items).alias("items"))
    parsed = F.from_json("items", "array<struct<no int, id bigint, qty double>>")
    return docs.select("order_id", F.explode(parsed).alias("item")).select(
        "order_id",
        F.col("item.no").alias("item_no"),
        F.col("item.id").alias("item_id"),
        F.col("item.qty").alias("quantity"),
    )

