"""Window questions, arranged so that no window holds an unbounded group."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import ORDERS_AS_OF, day, money, months_back, on, share
from tidemark.functions.ordering import lead_in_blocks, with_tiles
from tidemark.operators.joins import amounts_by_customer
from tidemark.registry import registered
from tidemark.sources.footers import stored_counts

Tables = Mapping[str, DataFrame]


@registered("""
    SELECT o_orderpriority AS priority, count(*) AS row_count,
           round(1e2 * count(*) / sum(count(*)) OVER (), 2) AS percentage
    FROM orders GROUP BY 1
""")
def win_share_of_total(t: Tables) -> DataFrame:
    """The window sees one row per priority."""
    counts = t["orders"].groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("row_count"))
    return counts.withColumn("percentage", share(F.col("row_count"), F.sum("row_count").over(W.partitionBy())))


@registered("""
    SELECT cast(strftime(l_shipdate, '%Y') AS integer) AS segment_id, count(*) AS row_count,
           round(1e2 * count(*) / sum(count(*)) OVER (), 2) AS percentage,
           CASE WHEN count(*) BETWEEN avg(count(*)) OVER () * 0.9::double AND avg(count(*)) OVER () * 1.1::double
                THEN 'Balanced' ELSE 'Skewed' END AS distribution_status
    FROM lineitem GROUP BY 1
""")
def win_band_vs_avg(t: Tables, low: float = 0.9, high: float = 1.1) -> DataFrame:
    """How the directories of the stored line items compare with their average."""
    everything = W.partitionBy()
    average = F.avg("row_count").over(everything)
    return (
        stored_counts(t["lineitem"], F.year("l_shipdate"))
        .withColumn("percentage", share(F.col("row_count"), F.sum("row_count").over(everything)))
        .withColumn(
            "distribution_status",
            F.when(F.col("row_count").between(average * low, average * high), "Balanced").otherwise("Skewed"),
        )
    )


@registered("""
    SELECT order_id, customer_id, order_date, total_amount, next_amount FROM (
      SELECT o_orderkey AS order_id, o_custkey AS customer_id, cast(o_orderdate AS date) AS order_date,
             o_totalprice AS total_amount,
             lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_amount
      FROM orders) WHERE next_amount > total_amount
""")
def win_lead_growth(t: Tables, keys_per_block: int = 10_000_000) -> DataFrame:
    """Orders whose next order by the same customer is larger.

    A block is a day and a range of order keys; keys are unique, so a block holds at
    most ``keys_per_block`` rows even for a customer with a third of all orders.
    """
    orders = t["orders"].select("o_orderkey", "o_custkey", day("o_orderdate").alias("order_date"), "o_totalprice")
    return (
        lead_in_blocks(
            orders,
            key="o_custkey",
            order=["order_date", "o_orderkey"],
            block={"_day": F.col("order_date"), "_keys": F.floor(F.col("o_orderkey") / keys_per_block)},
            value="o_totalprice",
            out="next_amount",
        )
        .filter(F.col("next_amount") > F.col("o_totalprice"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "order_date",
            F.col("o_totalprice").alias("total_amount"),
            "next_amount",
        )
    )


@registered("""
    WITH r AS (
      SELECT o.o_custkey AS customer_id, n.n_name AS country,
             cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS customer_revenue,
             row_number() OVER (ORDER BY sum(cast(o.o_totalprice AS decimal(12,2))) DESC, o.o_custkey) AS rank
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE o.o_orderdate >= date '2001-05-01' GROUP BY 1, 2)
    SELECT r.customer_id, c.c_name AS customer_name, r.country, r.customer_revenue, cast(r.rank AS integer) AS rank
    FROM r JOIN customer c ON r.customer_id = c.c_custkey WHERE r.rank <= 10
""")
def win_rank_global_top(t: Tables, as_of: date = ORDERS_AS_OF, months: int = 3, top: int = 10) -> DataFrame:
    """The first rows by a global order: a top-k over all rows, a row number over k rows."""
    best = (
        amounts_by_customer(t["orders"].filter(F.col("o_orderdate") >= on(months_back(as_of, months))))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .orderBy(F.desc("amount"), "o_custkey")
        .limit(top)
    )
    return (
        best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("amount"), "o_custkey")))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("country"),
            F.col("amount").cast("double").alias("customer_revenue"),
            "rank",
        )
    )


@registered("""
    SELECT o_custkey AS customer_id, o_orderkey AS order_id, cast(o_orderdate AS date) AS order_date,
           o_orderstatus AS status, o_totalprice AS total_amount
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1
""")
def win_latest_per_key(t: Tables) -> DataFrame:
    """ROW_NUMBER() = 1 as an aggregate: each task keeps one candidate per key before the shuffle."""
    newest = F.struct("o_orderdate", "o_orderkey")
    row = F.struct("o_orderkey", day("o_orderdate").alias("order_date"), "o_orderstatus", "o_totalprice")
    return (
        t["orders"]
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.max_by(row, newest).alias("r"))
        .select(
            "customer_id",
            F.col("r.o_orderkey").alias("order_id"),
            F.col("r.order_date").alias("order_date"),
            F.col("r.o_orderstatus").alias("status"),
            F.col("r.o_totalprice").alias("total_amount"),
        )
    )


def rfm_scores(orders: DataFrame) -> DataFrame:
    """Recency, frequency and money of each customer with their NTILE(5) scores."""
    base = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        day(F.max("o_orderdate")).alias("last_order"),
        F.count("*").alias("frequency"),
        F.sum(money("o_totalprice")).alias("monetary"),
    )
    scored = with_tiles(base, "customer_id", 5, r_score=("last_order", True), f_score=("frequency", False), m_score=("monetary", False))
    return scored.withColumn("monetary", F.col("monetary").cast("double"))


RFM_SQL = """
    WITH m AS (SELECT o_custkey AS customer_id, max(cast(o_orderdate AS date)) AS last_order, count(*) AS frequency,
                      sum(cast(o_totalprice AS decimal(12,2))) AS monetary FROM orders GROUP BY 1),
    scores AS (SELECT customer_id, last_order, frequency, cast(monetary AS double) AS monetary,
           cast(ntile(5) OVER (ORDER BY last_order DESC, customer_id) AS integer) AS r_score,
           cast(ntile(5) OVER (ORDER BY frequency, customer_id) AS integer) AS f_score,
           cast(ntile(5) OVER (ORDER BY monetary, customer_id) AS integer) AS m_score FROM m)
"""


@registered(RFM_SQL + "SELECT * FROM scores")
def win_ntile_rfm(t: Tables) -> DataFrame:
    return rfm_scores(t["orders"])


@registered("""
    SELECT n.n_name AS country, o.o_custkey AS customer_id, cast(date_trunc('month', o.o_orderdate) AS date) AS month,
           cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double) AS monthly_revenue,
           cast(sum(sum(cast(o.o_totalprice AS decimal(12,2)))) OVER (PARTITION BY o.o_custkey) AS double) AS total_revenue
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE o.o_orderdate >= date '2001-01-01' GROUP BY 1, 2, 3
""")
def win_sum_of_sum(t: Tables, since=date(2001, 1, 1)) -> DataFrame:
    """The window sees one row per customer and month."""
    monthly = (
        t["orders"]
        .filter(F.col("o_orderdate") >= on(since))
        .groupBy(F.col("o_custkey").alias("customer_id"), day(F.date_trunc("month", "o_orderdate")).alias("month"))
        .agg(F.sum(money("o_totalprice")).alias("amount"))
        .withColumn("whole", F.sum("amount").over(W.partitionBy("customer_id")))
    )
    return (
        monthly.join(t["customer"], F.col("customer_id") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("country"),
            "customer_id",
            "month",
            F.col("amount").cast("double").alias("monthly_revenue"),
            F.col("whole").cast("double").alias("total_revenue"),
        )
    )

