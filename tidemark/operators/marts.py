"""Subject-area marts over sales and events."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ORDERS_AS_OF, back, day, mean, micros, money, months_back, on, share, total
from tidemark.operators.joins import amounts_by_customer, with_customer
from tidemark.operators.unions import stacked
from tidemark.operators.windows import RFM_SQL, rfm_scores
from tidemark.registry import registered

Tables = Mapping[str, DataFrame]


@registered(
    """
    SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS country, c.c_mktsegment AS customer_segment,
           count(DISTINCT o.o_orderkey) AS total_orders,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_spent,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) / nullif(count(o.o_orderkey), 0) AS avg_order_value,
           cast(min(o.o_orderdate) AS date) AS first_order_date, cast(max(o.o_orderdate) AS date) AS last_order_date,
           cast(datediff('day', min(o.o_orderdate), max(o.o_orderdate)) AS integer) AS customer_lifetime_days
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY 1, 2, 3, 4
    """
)
def mart_customer_stats(t: Tables, since: date | None = None) -> DataFrame:
    """Customers without orders stay, with NULL amounts and zero orders."""
    orders = t["orders"] if since is None else t["orders"].filter(F.col("o_orderdate") >= on(since))
    stats = orders.groupBy("o_custkey").agg(
        F.countDistinct("o_orderkey").alias("total_orders"),
        total(money("o_totalprice")).alias("total_spent"),
        mean(money("o_totalprice")).alias("avg_order_value"),
        day(F.min("o_orderdate")).alias("first_order_date"),
        day(F.max("o_orderdate")).alias("last_order_date"),
    )
    return (
        t["customer"]
        .join(stats, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
            "total_spent",
            "avg_order_value",
            "first_order_date",
            "last_order_date",
            F.datediff("last_order_date", "first_order_date").alias("customer_lifetime_days"),
        )
    )


@registered(
    """
    SELECT p.p_partkey AS product_id, p.p_name AS product_name, p.p_type AS category_name, p.p_brand AS brand,
           count(l.l_partkey) AS times_ordered, sum(l.l_quantity) AS total_quantity_sold,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) AS total_revenue,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) / nullif(count(l.l_partkey), 0) AS avg_selling_price
    FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey
    GROUP BY 1, 2, 3, 4
    """
)
def mart_product_stats(t: Tables, since: date | None = None) -> DataFrame:
    lines = t["lineitem"] if since is None else t["lineitem"].filter(F.col("l_shipdate") >= on(since))
    stats = lines.groupBy("l_partkey").agg(
        F.count("*").alias("times_ordered"),
        F.sum("l_quantity").alias("total_quantity_sold"),
        total(money("l_extendedprice")).alias("total_revenue"),
        mean(money("l_extendedprice")).alias("avg_selling_price"),
    )
    return (
        t["part"]
        .join(stats, F.col("p_partkey") == F.col("l_partkey"), "left")
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("brand"),
            F.coalesce("times_ordered", F.lit(0)).alias("times_ordered"),
            "total_quantity_sold",
            "total_revenue",
            "avg_selling_price",
        )
    )


@registered("""
    WITH f AS (SELECT cast(o_orderdate AS date) AS full_date, l_orderkey, l_partkey, l_suppkey, l_quantity,
                 cast(l_extendedprice AS decimal(12,2)) * cast(l_discount AS decimal(4,2)) AS discount_amount,
                 cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2))) AS total_amount
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT full_date, cast(year(full_date) AS integer) AS year, cast(month(full_date) AS integer) AS month,
           monthname(full_date) AS month_name, p.p_type AS category, r.r_name AS region,
           count(DISTINCT l_orderkey) AS transaction_count, sum(l_quantity) AS total_quantity,
           cast(sum(total_amount) AS double) AS total_revenue,
           cast(sum(total_amount) AS double) / count(*) AS avg_transaction_amount,
           cast(sum(discount_amount) AS double) AS total_discount
    FROM f JOIN part p ON f.l_partkey = p.p_partkey JOIN supplier s ON f.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY 1, 2, 3, 4, 5, 6
""")
def mart_sales_by_category(t: Tables) -> DataFrame:
    price, rate = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
    dates = t["orders"].select("o_orderkey", day("o_orderdate").alias("full_date"))
    stores = (
        t["supplier"]
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("region"))
    )
    amount, discount = price * (1 - rate), price * rate
    # One row per order, category and region: an order has one date, so counting these rows
    # counts orders.  The shuffle on the order key serves the join with the dates as well.
    per_order = (
        t["lineitem"]
        .join(t["part"].select("p_partkey", F.col("p_type").alias("category")), F.col("l_partkey") == F.col("p_partkey"))
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "category", "region", "l_quantity", amount.alias("amount"), discount.alias("discount"))
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "category", "region")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.sum("amount").alias("amount"), F.count("amount").alias("amounts"), F.sum("discount").alias("discount"),
        )
    )
    sums = (
        per_order.join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("full_date", "category", "region")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("quantity").alias("total_quantity"),
            total(F.col("amount")).alias("total_revenue"),
            (total(F.col("amount")) / F.sum("amounts")).alias("avg_transaction_amount"),
            total(F.col("discount")).alias("total_discount"),
        )
    )
    # Calendar attributes depend on the date alone, so they are added to the aggregate.
    return sums.select(
        "*",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
    )


@registered("""
    SELECT p.p_type AS category, sum(l.l_quantity) AS items_sold,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) AS revenue,
           cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) / count(DISTINCT o.o_orderkey) AS avg_order
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
    WHERE o.o_orderdate >= date '2000-08-01' GROUP BY 1
""")
def mart_category_year(t: Tables, as_of: date = ORDERS_AS_OF, days: int = 365) -> DataFrame:
    orders = t["orders"].filter(F.col("o_orderdate") >= on(back(as_of, days))).select("o_orderkey")
    return (
        t["lineitem"]
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_type").alias("category"))
        .agg(
            F.sum("l_quantity").alias("items_sold"),
            total(money("l_extendedprice")).alias("revenue"),
            (total(money("l_extendedprice")) / F.countDistinct("o_orderkey")).alias("avg_order"),
        )
    )


@registered("""
    WITH f AS (SELECT n.n_name AS country, p.p_type AS category, o.o_orderdate AS d,
                      cast(l.l_extendedprice AS decimal(12,2)) AS amount
               FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
               JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
    cur AS (SELECT country, category, sum(amount) AS revenue FROM f WHERE d >= date '2001-05-01' GROUP BY 1, 2),
    prev AS (SELECT country, category, sum(amount) AS revenue FROM f
             WHERE d >= date '2001-02-01' AND d < date '2001-05-01' GROUP BY 1, 2)
    SELECT cur.country, cur.category, cast(cur.revenue AS double) AS current_revenue,
           cast(coalesce(prev.revenue, 0) AS double) AS previous_revenue,
           round(1e2 * cast(cur.revenue - coalesce(prev.revenue, 0) AS double) / nullif(cast(prev.revenue AS double), 0), 2)
             AS growth_percentage
    FROM cur LEFT JOIN prev ON cur.country = prev.country AND cur.category = prev.category
""")
def mart_period_growth(t: Tables, as_of: date = ORDERS_AS_OF, months: int = 3) -> DataFrame:
    """Both periods in one pass over the fact: each amount goes to the column of its period."""
    middle, start = months_back(as_of, months), months_back(as_of, 2 * months)
    orders = t["orders"].filter(F.col("o_orderdate") >= on(start))
    current, amount = F.col("o_orderdate") >= on(middle), money("l_extendedprice")
    return (
        t["lineitem"]
        .join(with_customer(orders, t["customer"]), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("c_nationkey", F.col("p_type").alias("category"))
        .agg(
            F.sum(F.when(current, amount)).alias("cur"),
            F.sum(F.when(~current, amount)).alias("prev"),
        )
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"), "category")
        .agg(F.sum("cur").alias("cur"), F.sum("prev").alias("prev"))
        .filter(F.col("cur").isNotNull())
        .select(
            "country",
            "category",
            F.col("cur").cast("double").alias("current_revenue"),
            F.coalesce(F.col("prev").cast("double"), F.lit(0.0)).alias("previous_revenue"),
            share(
                (F.col("cur") - F.coalesce(F.col("prev"), F.lit(0))).cast("double"), F.col("prev").cast("double")
            ).alias("growth_percentage"),
        )
    )


@registered("""
    SELECT o_custkey AS customer_id, cast(datediff('day', max(o_orderdate), timestamp '2001-08-01') AS integer) AS recency_days,
           count(*) AS frequency, cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS monetary
    FROM orders GROUP BY 1
""")
def mart_rfm_base(t: Tables, as_of: date = ORDERS_AS_OF) -> DataFrame:
    return (
        t["orders"]
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(
            F.datediff(on(as_of), day(F.max("o_orderdate"))).alias("recency_days"),
            F.count("*").alias("frequency"),
            total(money("o_totalprice")).alias("monetary"),
        )
    )


# Customer segments and the lowest and highest (recency, frequency, monetary)
# scores that belong to them.  The first row that fits counts; the last fits everyone.
RFM_SEGMENTS = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (1, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Lost", (1, 2), (1, 2), (1, 5)),
    ("Regular", (1, 5), (1, 5), (1, 5)),
]


def rfm_segment() -> Column:
    fits = [
        F.when(F.col("r_score").between(*r) & F.col("f_score").between(*f) & F.col("m_score").between(*m), F.lit(name))
        for name, r, f, m in RFM_SEGMENTS
    ]
    return F.coalesce(*fits)


def _segment_case() -> str:
    """The same rows as a CASE of the oracle."""
    named = zip(("r_score", "f_score", "m_score"), (1, 2, 3))
    columns = list(named)
    tests = [f"WHEN {' AND '.join(f'{c} BETWEEN {row[i][0]} AND {row[i][1]}' for c, i in columns)} THEN '{row[0]}'" for row in RFM_SEGMENTS]
    return f"CASE {' '.join(tests)} END"


_SEGMENT_SQL = RFM_SQL + f", seg AS (SELECT *, {_segment_case()} AS customer_segment FROM scores)"


@registered(
    _SEGMENT_SQL
    + """
    SELECT customer_id, last_order, cast(datediff('day', last_order, date '2001-08-01') AS integer) AS recency_days, frequency, monetary,
           r_score, f_score, m_score, cast(r_score + f_score + m_score AS integer) AS total_score, customer_segment FROM seg
    """
)
def mart_customer_rfm(t: Tables, as_of: date = ORDERS_AS_OF) -> DataFrame:
    """One row per customer: recency, the three scores, their sum and the segment."""
    return rfm_scores(t["orders"]).select(
        "customer_id",
        "last_order",
        F.datediff(on(as_of), "last_order").alias("recency_days"),
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("total_score"),
        rfm_segment().alias("customer_segment"),
    )


@registered(
    _SEGMENT_SQL
    + """
    SELECT customer_segment, count(*) AS customer_count,
           cast(sum(cast(monetary AS decimal(18,2))) AS double) / count(*) AS avg_lifetime_value,
           cast(sum(frequency) AS double) / count(*) AS avg_purchase_frequency,
           cast(min(r_score + f_score + m_score) AS integer) AS min_total, cast(max(r_score + f_score + m_score) AS integer) AS max_total
    FROM seg GROUP BY 1
    """
)
def mart_rfm_segments(t: Tables) -> DataFrame:
    combined = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return (
        rfm_scores(t["orders"])
        .groupBy(rfm_segment().alias("customer_segment"))
        .agg(
            F.count("*").alias("customer_count"),
            mean(F.col("monetary").cast("decimal(18,2)")).alias("avg_lifetime_value"),
            mean(F.col("frequency")).alias("avg_purchase_frequency"),
            F.min(combined).alias("min_total"),
            F.max(combined).alias("max_total"),
        )
    )


@registered("""
    WITH e AS (SELECT *, 'CAMP' || (cast(json_extract_string(props, '$.k') AS bigint) % 5) AS campaign_id FROM events),
    hits AS (SELECT DISTINCT e.campaign_id, p.event_id, cast(p.value AS decimal(12,2)) AS amount
             FROM e JOIN events p ON e.user_id = p.user_id AND p.event_type = 'purchase'
               AND p.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts + INTERVAL 1 HOUR
             WHERE e.event_type IN ('view', 'click')),
    sales AS (SELECT campaign_id, count(*) AS purchases, sum(amount) AS revenue FROM hits GROUP BY 1),
    views AS (SELECT campaign_id, count(*) FILTER (WHERE event_type = 'view') AS views,
                     100.0 + 50 * (count(*) % 7) AS budget FROM e GROUP BY 1)
    SELECT v.campaign_id, v.views, coalesce(s.purchases, 0) AS purchases, cast(v.budget AS double) AS budget,
           cast(coalesce(s.revenue, 0) AS double) AS revenue,
           round(1e2 * coalesce(s.purchases, 0) / nullif(v.views, 0), 2) AS conversion_pct,
           cast(s.revenue AS double) / s.purchases AS avg_order,
           round(1e2 * (cast(coalesce(s.revenue, 0) AS double) - cast(v.budget AS double)) / cast(v.budget AS double), 2) AS roi_pct
    FROM views v LEFT JOIN sales s ON v.campaign_id = s.campaign_id
""")
def mart_campaign_roi(t: Tables, seconds: int = 3600) -> DataFrame:
    """Campaigns against the purchases made within an hour of a touch by the same user.

    A purchase counts once per campaign.  Touches are reduced to the first and last per
    user, campaign and hour: whether one lies within the hour around a purchase can be
    read off those two, so neither a busy user nor a busy hour produces pairs.
    """
    campaign = F.concat(F.lit("CAMP"), (F.get_json_object("props", "$.k").cast("bigint") % 5).cast("string"))
    events = t["events"].withColumn("campaign_id", campaign).withColumn("at", micros("ts"))
    span = seconds * 1_000_000
    slot = F.floor(F.col("at") / F.lit(span))
    touches = (
        events.filter(F.col("event_type").isin("view", "click"))
        .groupBy(F.col("user_id").alias("toucher"), "campaign_id", slot.alias("touch_slot"))
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    )
    purchases = events.filter(F.col("event_type") == "purchase").select(
        "user_id", "event_id", "at", money("value").alias("amount"), F.explode(F.sequence(slot - 1, slot + 1)).alias("slot")
    )
    near = (
        (F.col("user_id") == F.col("toucher"))
        & (F.col("slot") == F.col("touch_slot"))
        & (F.col("last_at") >= F.col("at") - span)
        & (F.col("first_at") <= F.col("at") + span)
    )
    sales = (
        purchases.join(touches, near)
        .groupBy("campaign_id", "event_id")
        .agg(F.max("amount").alias("amount"))
        .groupBy(F.col("campaign_id").alias("sold_by"))
        .agg(F.count("*").alias("purchases"), F.sum("amount").cast("double").alias("revenue"))
    )
    campaigns = events.groupBy("campaign_id").agg(
        F.count_if(F.col("event_type") == "view").alias("views"), (100.0 + 50 * (F.count("*") % 7)).alias("budget")
    )
    revenue, bought = F.coalesce("revenue", F.lit(0.0)), F.coalesce("purchases", F.lit(0))
    return campaigns.join(sales, F.col("campaign_id") == F.col("sold_by"), "left").select(
        "campaign_id",
        "views",
        bought.alias("purchases"),
        "budget",
        revenue.alias("revenue"),
        share(bought, F.col("views")).alias("conversion_pct"),
        (F.col("revenue") / F.col("purchases")).alias("avg_order"),
        share(revenue - F.col("budget"), F.col("budget")).alias("roi_pct"),
    )


@registered("""
    WITH o AS (SELECT o_custkey, count(*) AS orders, cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS spent,
                      cast(max(o_orderdate) AS date) AS last_order FROM orders GROUP BY 1),
    w AS (SELECT user_id, count(*) AS page_events, count(DISTINCT cast(ts AS date)) AS active_days FROM events
          WHERE event_type IN ('view', 'click') GROUP BY 1),
    a AS (SELECT user_id, count(*) AS app_events, count(*) FILTER (WHERE event_type = 'error') AS errors, max(ts) AS last_seen
          FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1)
    SELECT c_custkey AS customer_id, c_name AS customer_name, coalesce(orders, 0) AS orders, coalesce(spent, 0) AS spent,
           last_order, coalesce(page_events, 0) AS page_events, coalesce(active_days, 0) AS active_days,
           coalesce(app_events, 0) AS app_events, coalesce(errors, 0) AS errors, last_seen
    FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN w ON c_custkey = w.user_id LEFT JOIN a ON c_custkey = a.user_id
""")
def mart_customer_360(t: Tables, web=("view", "click")) -> DataFrame:
    """Every source is reduced to one row per customer before it joins the customer list."""
    orders = t["orders"].groupBy("o_custkey").agg(
        F.count("*").alias("orders"),
        total(money("o_totalprice")).alias("spent"),
        day(F.max("o_orderdate")).alias("last_order"),
    )
    kind = F.col("event_type")
    pages = (
        t["events"].filter(kind.isin(*web)).groupBy(F.col("user_id").alias("web_user"))
        .agg(F.count("*").alias("page_events"), F.countDistinct(day("ts")).alias("active_days"))
    )
    app = (
        t["events"].filter(~kind.isin(*web)).groupBy(F.col("user_id").alias("app_user"))
        .agg(F.count("*").alias("app_events"), F.count_if(kind == "error").alias("errors"), F.max("ts").alias("last_seen"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        t["customer"]
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(pages, F.col("c_custkey") == F.col("web_user"), "left")
        .join(app, F.col("c_custkey") == F.col("app_user"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            zero("orders"),
            F.coalesce("spent", F.lit(0.0)).alias("spent"),
            "last_order",
            *[zero(c) for c in ("page_events", "active_days", "app_events", "errors")],
            "last_seen",
        )
    )


@registered("""
    SELECT cast(o_orderdate AS date) AS sale_date, count(*) AS order_count,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS total_sales,
           cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) / count(*) AS avg_order,
           count(DISTINCT o_custkey) AS unique_customers
    FROM orders GROUP BY 1
""")
def mart_daily_dashboard(t: Tables) -> DataFrame:
    return (
        t["orders"]
        .groupBy(day("o_orderdate").alias("sale_date"))
        .agg(
            F.count("*").alias("order_count"),
            total(money("o_totalprice")).alias("total_sales"),
            mean(money("o_totalprice")).alias("avg_order"),
            F.countDistinct("o_custkey").alias("unique_customers"),
        )
    )


@registered(
    _SEGMENT_SQL
    + """
    , d AS (SELECT user_id, cast(ts AS date) AS d, count(*) AS n, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1, 2),
    u AS (SELECT user_id, count(*) AS visits, sum(n)::bigint AS events, max(hi) AS last_activity,
                 sum(date_diff('microsecond', lo, hi) // 1000000)::bigint AS seconds_in_app FROM d GROUP BY 1)
    SELECT u.*, seg.customer_segment AS rfm_segment FROM u LEFT JOIN seg ON u.user_id = seg.customer_id
    """
)
def mart_engagement(t: Tables) -> DataFrame:
    """A visit is a day with activity; its length runs from the first to the last event of that day."""
    visits = (
        t["events"]
        .groupBy("user_id", day("ts").alias("d"))
        .agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    )
    seconds = F.floor((micros("hi") - micros("lo")) / F.lit(1_000_000))
    users = visits.groupBy("user_id").agg(
        F.count("*").alias("visits"),
        F.sum("n").alias("events"),
        F.max("hi").alias("last_activity"),
        F.sum(seconds).alias("seconds_in_app"),
    )
    segments = rfm_scores(t["orders"]).select("customer_id", rfm_segment().alias("rfm_segment"))
    return users.join(segments, F.col("user_id") == F.col("customer_id"), "left").drop("customer_id")


@registered("""
    WITH v AS (SELECT user_id, min(ts) AS at FROM events WHERE event_type = 'view' GROUP BY 1),
    c AS (SELECT e.user_id, min(e.ts) AS at FROM events e JOIN v ON e.user_id = v.user_id AND e.ts > v.at
          WHERE e.event_type = 'click' GROUP BY 1),
    p AS (SELECT e.user_id, min(e.ts) AS at FROM events e JOIN c ON e.user_id = c.user_id AND e.ts > c.at
          WHERE e.event_type = 'purchase' GROUP BY 1)
    SELECT 1 AS step, 'view' AS step_name, (SELECT count(*) FROM v) AS users, 1e2 AS pct_of_first
    UNION ALL SELECT 2, 'click', (SELECT count(*) FROM c), round(1e2 * (SELECT count(*) FROM c) / nullif((SELECT count(*) FROM v), 0), 2)
    UNION ALL SELECT 3, 'purchase', (SELECT count(*) FROM p), round(1e2 * (SELECT count(*) FROM p) / nullif((SELECT count(*) FROM v), 0), 2)
""")
def mart_funnel(t: Tables, steps=("view", "click", "purchase")) -> DataFrame:
    """Users that reach each step after the step before it: the first event of a kind later than the previous one.

    One scan.  A user's events at one time are a set of kinds; such sets, in order, move the user from step to
    step.  A day of a user is folded into a function, from the step at its start to the step at its
    end, and the days' functions are applied one after another, so a task never holds all events of a user.
    """
    bits = [F.when(F.col("event_type") == kind, 1 << i) for i, kind in enumerate(steps)]
    events = t["events"].filter(F.col("event_type").isin(*steps) & F.col("ts").isNotNull())
    at_once = events.groupBy("user_id", "ts").agg(F.bit_or(F.coalesce(*bits)).alias("kinds"))
    start = F.array(*[F.lit(i) for i in range(len(steps) + 1)])
    ordered = lambda c: F.array_sort(F.collect_list(c))
    days = at_once.groupBy("user_id", day("ts").alias("d")).agg(ordered(F.struct("ts", "kinds")).alias("times"))
    # From every step at once; Spark has no shift by a column, so the bit is taken by division.
    moved = lambda step, kinds: (step + F.call_function("div", kinds, F.pow(F.lit(2), step).cast("int")) % 2).cast("int")
    folded = F.aggregate("times", start, lambda done, x: F.transform(done, lambda step: moved(step, x["kinds"])))
    through = days.select("user_id", F.struct("d", folded.alias("f")).alias("day")).groupBy("user_id").agg(ordered("day").alias("days"))
    last = F.aggregate("days", F.lit(0), lambda step, x: F.element_at(x["f"], step + 1))
    # Events without a user are one first step and never a later one.
    reached = through.select(F.when(F.col("user_id").isNull(), F.least(last, F.lit(1))).otherwise(last).alias("step"))
    counts = reached.agg(*[F.count_if(F.col("step") >= i).alias(f"n_{i}") for i in range(1, len(steps) + 1)])
    table = [
        F.struct(F.lit(i).alias("step"), F.lit(kind).alias("step_name"), F.col(f"n_{i}").alias("users"))
        for i, kind in enumerate(steps, start=1)
    ]
    return counts.select("n_1", F.inline(F.array(*table))).select(
        "step", "step_name", "users", share(F.col("users"), F.col("n_1")).alias("pct_of_first")
    )


@registered("""
    WITH e AS (SELECT *, 'screen_' || json_extract_string(props, '$.k') AS screen,
                      CASE user_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS platform FROM events)
    (SELECT 'top_screens' AS report, screen AS name, count(*) AS n, cast(NULL AS double) AS avg_time FROM e
     WHERE event_type = 'view' GROUP BY 2 ORDER BY n DESC, name LIMIT 10)
    UNION ALL
    SELECT 'time_by_platform', platform, count(*), cast(sum(cast(value AS decimal(12,2))) AS double) / count(*)
    FROM e WHERE event_type = 'view' GROUP BY 2
    UNION ALL SELECT 'active_users', platform, count(DISTINCT user_id), NULL FROM e GROUP BY 2
""")
def mart_screen_stats(t: Tables, top: int = 10) -> DataFrame:
    platform = F.when(F.col("user_id") % 3 == 0, "ios").when(F.col("user_id") % 3 == 1, "android").otherwise("web")
    events = t["events"].select(
        "user_id",
        "event_type",
        "value",
        F.concat(F.lit("screen_"), F.get_json_object("props", "$.k")).alias("screen"),
        platform.alias("platform"),
    )
    views = events.filter(F.col("event_type") == "view")
    none = F.lit(None).cast("double")
    screens = (
        views.groupBy(F.col("screen").alias("name")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(top)
    )
    times = views.groupBy(F.col("platform").alias("name")).agg(F.count("*").alias("n"), mean(money("value")).alias("avg_time"))
    users = events.groupBy(F.col("platform").alias("name")).agg(F.countDistinct("user_id").alias("n"))
    return stacked(
        [
            screens.select(F.lit("top_screens").alias("report"), "name", "n", none.alias("avg_time")),
            times.select(F.lit("time_by_platform").alias("report"), "name", "n", "avg_time"),
            users.select(F.lit("active_users").alias("report"), "name", "n", none.alias("avg_time")),
        ]
    )


@registered("""
    SELECT cast(o_orderdate AS date) AS order_date, count(*) AS order_count,
           cast(sum(cast(l_quantity AS decimal(6,0)) * cast(l_extendedprice AS decimal(12,2))) AS double) AS total_revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def mart_sales_by_day(t: Tables) -> DataFrame:
    worth = F.col("l_quantity").cast("decimal(6,0)") * money("l_extendedprice")
    return (
        t["lineitem"]
        .join(t["orders"].select("o_orderkey", day("o_orderdate").alias("order_date")), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("order_date")
        .agg(F.count("*").alias("order_count"), total(worth).alias("total_revenue"))
    )


@registered("""
    SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS country, count(*) AS total_orders,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS total_spent
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2, 3
""")
def mart_customer_spend(t: Tables) -> DataFrame:
    """The companion of the daily report: orders and spend of every customer with an order."""
    return (
        amounts_by_customer(t["orders"])
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("country"),
            F.col("n").alias("total_orders"),
            F.col("amount").cast("double").alias("total_spent"),
        )
    )
