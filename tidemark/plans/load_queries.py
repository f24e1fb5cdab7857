"""Registered load queries: targets and sources are slices of the given tables."""

from __future__ import annotations

import re
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import day, mean, money, months_back, ntz, on, total
from tidemark.functions.scratch import scratch_path
from tidemark.operators import loads
from tidemark.operators import quality as dq
from tidemark.operators.joins import with_customer
from tidemark.plans import pipelines
from tidemark.registry import registered
from tidemark.sources import statistics, writers
from tidemark.sources.ledger import Ledger
from tidemark.sources.views import Question, SummaryView
from tidemark.sources.writers import VersionedTable

_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
# Keys not divisible by 3 are stored; the others arrive, and even ones with a changed price.
_SLICES = """
    WITH target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0),
    source AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)
"""


def _target(t) -> DataFrame:
    return t["orders"].filter(F.col("o_orderkey") % 3 != 0).select(*_ORDER)


def _source(t) -> DataFrame:
    changed = t["orders"].filter((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 == 0))
    return changed.select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice")
    )


@registered(_SLICES + """
    SELECT * FROM target UNION ALL SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)
""")
def load_insert_ignore(t) -> DataFrame:
    """Every source key arrives twice; the smaller row of the two is the one stored."""
    source = _source(t)
    twin = source.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return loads.load_insert_ignore(_target(t), source.unionByName(twin), ["o_orderkey"])


@registered(_SLICES + "SELECT * FROM target UNION ALL SELECT * FROM source")
def load_append(t) -> DataFrame:
    return loads.load_append(_target(t), _source(t))


@registered(_SLICES + """
    SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE t.o_orderkey = s.o_orderkey) UNION ALL SELECT * FROM source
""")
def load_upsert(t) -> DataFrame:
    return loads.load_upsert(_target(t), _source(t), ["o_orderkey"])


@registered(_SLICES + """
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
           CASE WHEN s.o_orderkey IS NOT NULL THEN nullif(s.o_totalprice, floor(s.o_totalprice)) ELSE t.o_totalprice END AS o_totalprice,
           CASE WHEN t.o_orderkey IS NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus
    FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey
""")
def load_upsert_partial(t) -> DataFrame:
    """Only the price is updated; a whole-number price arrives as NULL and must overwrite."""
    price = F.col("o_totalprice")
    source = _source(t).withColumn("o_totalprice", F.nullif(price, F.floor(price).cast("double")))
    return loads.load_upsert_partial(_target(t), source, ["o_orderkey"], ["o_totalprice"])


_SCD_SQL = """
    WITH old AS (SELECT p_partkey AS product_id, p_name AS product_name, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS category, p_retailprice AS price
                 FROM part WHERE p_partkey % 5 <> 0),
    new AS (SELECT p_partkey AS product_id, p_name AS product_name, CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS category,
                   CASE WHEN p_partkey % 4 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS price FROM part WHERE p_partkey % 7 <> 0 OR p_partkey % 5 = 0),
    j AS (SELECT o.product_id AS ok, n.product_id AS nk, o.product_name AS oname, o.category AS ocat, o.price AS oprice, n.product_name AS nname,
                 n.category AS ncat, n.price AS nprice, o.product_id IS NOT NULL AND n.product_id IS NOT NULL AND o.product_name IS NOT DISTINCT FROM n.product_name
                 AND o.category IS NOT DISTINCT FROM n.category AND o.price IS NOT DISTINCT FROM n.price AS same
          FROM old o FULL JOIN new n ON o.product_id = n.product_id),
    hist AS (SELECT p_partkey AS product_id, 'first ' || p_name AS product_name, p_type AS category, p_retailprice AS price, date '2023-01-01' AS valid_from,
                    date '2024-01-01' AS valid_to, false AS is_current FROM part WHERE p_partkey % 5 = 1)
"""


def _products_dim(t) -> DataFrame:
    key = F.col("p_partkey")
    columns = [key.alias("product_id"), F.col("p_retailprice").alias("price")]
    current = t["part"].filter(key % 5 != 0).select(
        *columns, F.col("p_name").alias("product_name"), F.when(key % 11 != 0, F.col("p_type")).alias("category"),
        on("2024-01-01").alias("valid_from"), on(loads.END_OF_TIME).alias("valid_to"), F.lit(True).alias("is_current"),
    )
    history = t["part"].filter(key % 5 == 1).select(
        *columns, F.concat(F.lit("first "), F.col("p_name")).alias("product_name"), F.col("p_type").alias("category"),
        on("2023-01-01").alias("valid_from"), on("2024-01-01").alias("valid_to"), F.lit(False).alias("is_current"),
    )
    return current.unionByName(history)


def _products_source(t) -> DataFrame:
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    return t["part"].filter((key % 7 != 0) | (key % 5 == 0)).select(
        key.alias("product_id"), F.col("p_name").alias("product_name"), F.when(key % 13 != 0, F.col("p_type")).alias("category"),
        F.when(key % 4 == 0, price + 1).otherwise(price).alias("price"),
    )


_TRACKED = ["product_name", "category", "price"]
_SCD_ROWS = """
    SELECT product_id, product_name, category, price, valid_from, valid_to, is_current FROM hist
    UNION ALL SELECT ok, oname, ocat, oprice, date '2024-01-01', CASE WHEN {open} THEN date '9999-12-31' ELSE date '2025-02-01' END, {open}
      FROM j WHERE ok IS NOT NULL
    UNION ALL SELECT nk, nname, ncat, nprice, date '2025-02-01', date '9999-12-31', true FROM j WHERE nk IS NOT NULL AND NOT same
"""


@registered(_SCD_SQL + _SCD_ROWS.format(open="same"))
def load_scd2_bulk(t) -> DataFrame:
    return loads.load_scd2_bulk(_products_dim(t), _products_source(t), "product_id", _TRACKED, date(2025, 2, 1))


@registered(_SCD_SQL + _SCD_ROWS.format(open="(same OR nk IS NULL)"))
def load_scd2_one(t) -> DataFrame:
    return loads.load_scd2_one(_products_dim(t), _products_source(t), "product_id", _TRACKED, date(2025, 2, 1))


@registered("""
    WITH s AS (SELECT l_orderkey * 8 + l_linenumber AS transaction_id, o_orderdate AS ts, (l_extendedprice::decimal(12,2) * l_quantity::decimal(6,0)) AS gross,
        (l_discount * 100)::decimal(5,2) AS pct, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate <= timestamp '2001-07-31 00:00:00'),
    f AS (SELECT ts, strftime(ts, '%Y%m')::integer AS month, gross - round(gross * pct * 0.01, 2) AS total_amount FROM s WHERE l_partkey % 5 <> 0)
    SELECT 'fact' AS part, month::varchar AS name, count(*) AS row_count, max(ts) AS last_ts, sum(total_amount)::double AS total_amount FROM f GROUP BY 2
    UNION ALL SELECT 'control', 'fact_transactions', count(*), max(ts), NULL FROM f WHERE ts > timestamp '2001-01-15 00:00:00'
    UNION ALL SELECT 'control', 'fact_orders', 5, timestamp '2024-01-02 00:00:00', NULL
""")
def load_incremental(t) -> DataFrame:
    """Transactions up to the middle of January are loaded; a later run adds what came since.

    A run looks up product and store keys of current dimension rows, derives the date key, and
    publishes facts and watermark in one entry.
    """
    spark = t["orders"].sparkSession
    ledger = Ledger(spark, scratch_path(spark, "incremental"))
    start = ledger.begin()
    start.replace("products", _products_dim(t).withColumn("product_key", F.col("product_id") + 1000))
    start.replace("stores", t["supplier"].select(F.col("s_suppkey").alias("store_id"), (F.col("s_suppkey") * 2).alias("store_key")))
    start.replace(
        "control",
        spark.createDataFrame(
            [("fact_orders", datetime(2024, 1, 2), 5, "SUCCESS")],
            "table_name string, last_load_timestamp timestamp_ntz, rows_loaded bigint, status string",
        ),
    )
    start.commit("setup")
    owners = t["orders"].select("o_orderkey", F.col("o_custkey").alias("customer_id"), ntz("o_orderdate").alias("transaction_ts"))
    staged = _staged_lines(t).join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    source = staged.withColumn("transaction_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")).drop("l_orderkey", "l_linenumber", "o_orderkey")
    for run_at in (datetime(2001, 1, 15), datetime(2001, 7, 31)):
        pipelines.load_transactions(ledger, source, run_at)
    facts, control = ledger.rows("facts"), ledger.rows("control")
    summary = facts.groupBy(F.floor(F.col("date_key") / 100).cast("string").alias("name")).agg(
        F.count("*").alias("row_count"), F.max("transaction_ts").alias("last_ts"), total(F.col("total_amount")).alias("total_amount")
    )
    moved = control.select(
        F.lit("control").alias("part"), F.col("table_name").alias("name"), F.col("rows_loaded").alias("row_count"),
        F.col("last_load_timestamp").alias("last_ts"), F.lit(None).cast("double").alias("total_amount"),
    )
    return summary.select(F.lit("fact").alias("part"), "*").unionByName(moved)


def _staged_lines(t) -> DataFrame:
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("decimal(6,0)").alias("quantity"), money("l_extendedprice").alias("unit_price"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_percent"),
    )


@registered("""
    WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey + 1000 AS product_key, l_suppkey * 2 AS store_key,
        l_extendedprice::decimal(12,2) * l_quantity::decimal(6,0) AS gross, (l_discount * 100)::decimal(5,2) AS pct FROM lineitem WHERE l_partkey % 5 <> 0)
    SELECT l_orderkey, l_linenumber, product_key, store_key, round(gross * pct * 0.01, 2)::double AS discount_amount,
           (gross - round(gross * pct * 0.01, 2))::double AS total_amount FROM f
""")
def load_fact_enrich(t) -> DataFrame:
    """Lines of products without a current dimension row are not loaded."""
    products = _products_dim(t).withColumn("product_key", F.col("product_id") + 1000)
    stores = t["supplier"].select(F.col("s_suppkey").alias("store_id"), (F.col("s_suppkey") * 2).alias("store_key"))
    facts = loads.load_fact_enrich(
        _staged_lines(t), {"product_id": (products, "product_id", "product_key"), "store_id": (stores, "store_id", "store_key")}
    )
    amounts = [F.col(c).cast("double").alias(c) for c in ("discount_amount", "total_amount")]
    return facts.select("l_orderkey", "l_linenumber", "product_key", "store_key", *amounts)


@registered("""
    SELECT s_suppkey AS store_id, s_name AS store_name, s_suppkey + 500 AS store_key FROM supplier WHERE s_suppkey % 4 = 0
    UNION ALL
    SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) + (SELECT max(s_suppkey) + 500 FROM supplier WHERE s_suppkey % 4 = 0)
    FROM supplier WHERE s_suppkey % 4 <> 0
""")
def dim_surrogate_key(t) -> DataFrame:
    stores = t["supplier"].select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"))
    known = stores.filter(F.col("store_id") % 4 == 0).withColumn("store_key", F.col("store_id") + 500)
    return loads.dim_surrogate_key(known, stores, "store_id", "store_key")


_LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _lines(t) -> DataFrame:
    return t["lineitem"].select(*_LINE_KEYS, "l_partkey", "l_suppkey", "l_extendedprice", day("l_shipdate").alias("loaded_on"))


@registered("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, cast(l_shipdate AS date) AS loaded_on FROM lineitem a
    WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_shipdate < b.l_shipdate)
""")
def dedup_delete_older(t) -> DataFrame:
    return loads.dedup_delete_older(_lines(t), _LINE_KEYS, "loaded_on")


@registered("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, loaded_on FROM (
      SELECT *, cast(l_shipdate AS date) AS loaded_on, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1
""")
def dedup_keep_latest(t) -> DataFrame:
    return loads.dedup_keep_latest(_lines(t), _LINE_KEYS, ["loaded_on"])


@registered("""
    SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity::decimal(6,0) * l_extendedprice::decimal(12,2))::double AS total_amount FROM lineitem
""")
def upd_line_total(t) -> DataFrame:
    lines = t["lineitem"].select(*_LINE_KEYS, "l_partkey", F.col("l_quantity").cast("decimal(6,0)").alias("q"), money("l_extendedprice").alias("p"))
    rows = loads.upd_line_total(lines, "q", "p", "total_amount").drop("q", "p")
    return rows.withColumn("total_amount", F.col("total_amount").cast("double"))


@registered("""
    SELECT o_orderkey, o_custkey, coalesce(s.amount, 0)::double AS total_amount FROM orders LEFT JOIN
      (SELECT l_orderkey, sum(l_extendedprice::decimal(12,2)) AS amount FROM lineitem GROUP BY 1) s ON o_orderkey = l_orderkey
""")
def upd_order_total(t) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_custkey", F.lit(0).cast("decimal(22,2)").alias("total_amount"))
    items = t["lineitem"].select("l_orderkey", money("l_extendedprice").alias("amount"))
    rows = loads.upd_order_total(orders, items, "o_orderkey", "l_orderkey", "amount", "total_amount")
    return rows.withColumn("total_amount", F.col("total_amount").cast("double"))


def sales_facts(t) -> DataFrame:
    """Line items with the date and customer of their order."""
    owners = t["orders"].select("o_orderkey", "o_custkey", day("o_orderdate").alias("sale_date"))
    return t["lineitem"].join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "sale_date", F.col("l_partkey").alias("product_key"), F.col("l_suppkey").alias("store_key"),
        F.col("l_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"), money("l_extendedprice").alias("total_amount"),
        "l_linenumber",
    )


_JOINED = 500_000  # line items that a task joins and groups


def _dealt(t) -> dict[str, DataFrame]:
    """The tables of ``sales_facts``, dealt by number of rows.

    A task that joins them goes on to group its rows by transaction and by customer, three hash maps
    of nearly all rows; AQE sizes it by compressed bytes, which tell little about that memory.
    """
    tasks = writers.tasks_for(t["lineitem"].count(), _JOINED)
    return {"lineitem": t["lineitem"].repartition(tasks, "l_orderkey"), "orders": t["orders"].repartition(tasks, "o_orderkey")}


_DAILY = """
    SELECT sale_date, product_key, store_key, count(DISTINCT transaction_id) AS transaction_count, sum(quantity)::bigint AS total_quantity,
           sum(total_amount)::double AS total_revenue, sum(total_amount)::double / count(*) AS avg_transaction_amount,
           count(DISTINCT customer_id) AS unique_customers
"""
_FACTS_SQL = """
    WITH f AS (SELECT cast(o_orderdate AS date) AS sale_date, l_partkey AS product_key, l_suppkey AS store_key, l_orderkey AS transaction_id,
        o_custkey AS customer_id, l_quantity::bigint AS quantity, l_extendedprice::decimal(12,2) AS total_amount, l_linenumber
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def _by_month(daily: DataFrame) -> DataFrame:
    return daily.withColumn("sale_month", F.date_format("sale_date", "yyyy-MM"))


def _stored_daily(daily: DataFrame) -> str:
    """The daily aggregate as a table of months."""
    path = scratch_path(daily.sparkSession, "daily")
    return writers.write_partitioned(_by_month(daily), path, "sale_month")


def _read_daily(spark, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(_by_month(like).schema).parquet(path).drop("sale_month")


@registered(_FACTS_SQL + _DAILY + " FROM f GROUP BY 1, 2, 3")
def agg_refresh_daily(t, refreshed: date = date(2001, 7, 31)) -> DataFrame:
    """The stored aggregate lacks lines of one day; that day is refreshed from the whole fact.

    Only the directory of the day's month is read and written.
    """
    facts = sales_facts(_dealt(t))
    today = F.col("sale_date") == on(refreshed)
    early = loads.daily_sales(facts.filter(~today | (F.col("l_linenumber") != 2)))
    path = _stored_daily(early)
    writers.rewrite_partitions(
        facts.sparkSession, path, "sale_month", _by_month(loads.daily_sales(facts.filter(today))),
        lambda stored, fresh: stored.filter(~today).unionByName(fresh),
    )
    return _read_daily(facts.sparkSession, path, early)


@registered(_FACTS_SQL + """
""" + _DAILY + " FROM f GROUP BY 1, 2, 3")
def load_late_facts(t) -> DataFrame:
    """The last lines of the orders of the final month arrive late; only the months they touch are rewritten."""
    facts = sales_facts(_dealt(t))
    is_late = (F.col("l_linenumber") == 7) & (F.col("sale_date") >= on("2001-07-01"))
    on_time, late = facts.filter(~is_late), facts.filter(is_late)
    early = loads.daily_sales(on_time)
    path = _stored_daily(early)
    days = late.select("sale_date").distinct()
    touched = loads.daily_sales(facts.join(days, "sale_date", "left_semi"))
    writers.rewrite_partitions(
        facts.sparkSession, path, "sale_month", _by_month(touched),
        lambda stored, fresh: stored.join(days, "sale_date", "left_anti").unionByName(fresh),
    )
    return _read_daily(facts.sparkSession, path, early)


@registered("""
    WITH o AS (SELECT cast(o_orderdate AS date) AS order_date, r_name AS region, o_custkey, o_orderkey % 50 AS product_id,
        o_totalprice::decimal(12,2) AS amount, (o_totalprice::decimal(12,2) * 0.1)::decimal(12,2) AS discount
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    d AS (SELECT order_date AS summary_date, count(*) AS total_orders, sum(amount)::double AS total_revenue, sum(discount)::double AS total_discount,
             sum(amount)::double / count(*) AS avg_order_value, count(DISTINCT o_custkey) AS unique_customers, count(DISTINCT product_id) AS unique_products
          FROM o WHERE order_date = date '2001-07-31' GROUP BY 1)
    SELECT *, (SELECT region FROM o WHERE order_date = date '2001-07-31' GROUP BY region ORDER BY sum(amount) DESC, region LIMIT 1) AS top_region FROM d
    UNION ALL SELECT date '2001-07-30', 1, 1.0, 0.0, 1.0, 1, 1, 'EUROPE'
""")
def agg_daily_summary(t) -> DataFrame:
    """The summary holds a stale row for the day and one for the day before."""
    places = (
        t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", F.col("r_name").alias("region"))
    )
    amount = money("o_totalprice")
    orders = t["orders"].join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        day("o_orderdate").alias("order_date"), "region", F.col("o_custkey").alias("customer_id"), (F.col("o_orderkey") % 50).alias("product_id"),
        amount.alias("total_amount"), (amount * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(12,2)").alias("discount_amount"),
    )
    rows = [(date(2001, 7, 30), 1, 1.0, 0.0, 1.0, 1, 1, "EUROPE"), (date(2001, 7, 31), 9, 9.0, 9.0, 9.0, 9, 9, "STALE")]
    summary = orders.sparkSession.createDataFrame(
        rows,
        "summary_date date, total_orders bigint, total_revenue double, total_discount double, avg_order_value double, "
        "unique_customers bigint, unique_products bigint, top_region string",
    )
    return loads.agg_daily_summary(summary, orders, date(2001, 7, 31))


_MV_SQL = """
    SELECT cast(date_trunc('month', o_orderdate) AS date) AS month, n_name AS country, p_type AS category, count(*) AS order_count,
           sum(l_extendedprice::decimal(12,2))::double AS total_revenue, sum(l_extendedprice::decimal(12,2))::double / count(*) AS avg_order_value,
           count(DISTINCT o_custkey) AS unique_customers
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
"""


def _sales_view(t) -> SummaryView:
    """Sales as a table of months, and a view over it that is as new as the table.

    The first lines of the orders of two months arrive after the view was made, so it is
    brought up to date by them alone.
    """
    spark = t["orders"].sparkSession
    places = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    sales = (
        t["lineitem"]
        .join(with_customer(t["orders"], places), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .select(
            day(F.date_trunc("month", "o_orderdate")).alias("month"), F.col("n_name").alias("country"), F.col("p_type").alias("category"),
            F.col("o_custkey").alias("customer_id"), money("l_extendedprice").alias("amount"), "l_linenumber",
        )
    )
    ledger = Ledger(spark, scratch_path(spark, "sales"))
    view = SummaryView(ledger, "sales", "month", ["country", "category"], "amount", "customer_id")
    late = (F.col("l_linenumber") == 1) & (F.col("month") >= on("2001-06-01"))
    for rows in (sales.filter(~F.coalesce(late, F.lit(False))), sales.filter(late)):
        change = ledger.begin()
        change.append("sales", rows.drop("l_linenumber"), part="month")
        change.commit("sales")
        view.refresh()
    return view


@registered(_MV_SQL)
def mv_monthly_sales(t) -> DataFrame:
    """The whole view after a load that touched two months."""
    names = {"rows": "order_count", "amount": "total_revenue", "average": "avg_order_value", "members": "unique_customers"}
    return _sales_view(t).answer(Question(("month", "country", "category"))).withColumnsRenamed(names)


@registered("""
    SELECT cast(date_trunc('month', o_orderdate) AS date) AS month, n_name AS country, sum(l_extendedprice::decimal(12,2))::double AS revenue, count(*) AS orders
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderdate >= date '2000-06-01' GROUP BY 1, 2
""")
def mv_query(t, since=date(2000, 6, 1)) -> DataFrame:
    """A coarser question, answered from the summary because it covers it and is as new as the table."""
    question = Question(("month", "country"), ("amount", "rows"), since=since)
    return _sales_view(t).answer(question).withColumnsRenamed({"amount": "revenue", "rows": "orders"})


@registered("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '1999-08'")
def part_drop_old(t, months: int = 24) -> DataFrame:
    """The directories of old months are deleted; no row is read for it."""
    spark = t["orders"].sparkSession
    rows = t["orders"].select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    path = writers.write_partitioned(rows, scratch_path(spark, "months"), "month")
    cutoff = months_back(date(2001, 8, 1), months).strftime("%Y-%m")
    writers.drop_partitions(path, "month", lambda month: re.fullmatch(r"[0-9]{4}-[0-9]{2}", month) is not None and month < cutoff)
    return spark.read.schema("o_orderkey bigint, month string").parquet(path)


@registered("SELECT event_id, ts FROM events WHERE cast(ts AS date) >= date '2024-01-11'")
def log_retention(t, days: int = 20) -> DataFrame:
    return loads.log_retention(t["events"].select("event_id", "ts"), "ts", days, date(2024, 1, 31))


@registered(_SCD_SQL + """
    SELECT coalesce(nk, ok) AS product_id, CASE WHEN ok IS NULL THEN 'insert' WHEN nk IS NULL THEN 'delete' ELSE 'update' END AS change_type,
           CASE WHEN nk IS NULL THEN oname ELSE nname END AS product_name, CASE WHEN nk IS NULL THEN ocat ELSE ncat END AS category,
           CASE WHEN nk IS NULL THEN oprice ELSE nprice END AS price FROM j WHERE NOT same
""")
def cdc_capture(t) -> DataFrame:
    before = _products_dim(t).filter("is_current").select("product_id", *_TRACKED)
    return loads.cdc_capture(before, _products_source(t), ["product_id"])


@registered("""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 <> 0
""")
def pipe_staging_to_prod(t) -> DataFrame:
    """Orders are staged with missing customers and negative prices, checked, let through the gate, promoted and analyzed."""
    spark, root = t["orders"].sparkSession, scratch_path(t["orders"].sparkSession, "pipe")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    rows = t["orders"].select(
        "o_orderkey", F.when(key % 10 != 0, F.col("o_custkey")).alias("o_custkey"), F.when(key % 9 == 0, -price).otherwise(price).alias("o_totalprice")
    )
    staging, production = VersionedTable(spark, f"{root}/staging"), VersionedTable(spark, f"{root}/production")
    staging.publish(rows)
    fixes = {"o_totalprice": F.when(price < 0, 0.0).otherwise(price)}
    name = f"tidemark_{uuid.uuid4().hex}"
    checks = [dq.Rule("no customer", "o_custkey IS NULL"), dq.Rule("negative price", "o_totalprice < 0", "WARNING")]
    try:
        return pipelines.pipe_staging_to_prod(
            staging, production, ["o_orderkey"], f"{root}/log", drop_if=F.col("o_custkey").isNull() | price.isNull(), fixes=fixes,
            checks=checks, max_bad=rows.count() // 5, statistics=(name, ["o_orderkey", "o_custkey"]),
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the name alone; rows belong to ``production``


@registered("""
    SELECT 'o_orderkey' AS column_name, cast(min(o_orderkey) AS varchar) AS low, cast(max(o_orderkey) AS varchar) AS high, count_if(o_orderkey IS NULL)::bigint AS null_count, count(*) AS row_count FROM orders
    UNION ALL SELECT 'o_custkey', cast(min(CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END) AS varchar), cast(max(CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END) AS varchar),
      count_if(o_orderkey % 10 = 0 OR o_custkey IS NULL)::bigint, count(*) FROM orders
    UNION ALL SELECT 'order_day', cast(min(o_orderdate)::date AS varchar), cast(max(o_orderdate)::date AS varchar), count_if(o_orderdate IS NULL)::bigint, count(*) FROM orders
""")
def load_statistics(t) -> DataFrame:
    """What the catalog knows of a table's columns after two loads, each of which took the statistics anew."""
    spark, name = t["orders"].sparkSession, f"tidemark_{uuid.uuid4().hex}"
    key, columns = F.col("o_orderkey"), ["o_orderkey", "o_custkey", "order_day"]
    rows = t["orders"].select("o_orderkey", F.when(key % 10 != 0, F.col("o_custkey")).alias("o_custkey"), day("o_orderdate").alias("order_day"))
    table = VersionedTable(spark, scratch_path(spark, "analyzed"))
    try:
        for wave in (key % 3 == 0, key % 3 != 0):
            table.append(rows.filter(wave))
            count = statistics.analyze(table, name, columns)
        told = statistics.column_statistics(spark, name, columns)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return told.drop("distinct_estimate").withColumn("row_count", F.lit(count).cast("bigint"))


@registered(_FACTS_SQL + """
    , g AS (SELECT sale_date, product_key, store_key, transaction_id, customer_id, quantity, total_amount FROM (
        SELECT * REPLACE (transaction_id * 8 + l_linenumber AS transaction_id), row_number() OVER (PARTITION BY transaction_id, l_linenumber ORDER BY sale_date DESC, product_key DESC, store_key DESC, customer_id DESC,
               quantity DESC, total_amount DESC) AS rn FROM f WHERE sale_date <= date '2001-07-31') WHERE rn = 1)
""" + _DAILY + " FROM g WHERE sale_date = date '2001-07-31' GROUP BY 1, 2, 3")
def pipe_daily_etl(t) -> DataFrame:
    """All facts arrive in one run, one per order line; the last day is aggregated."""
    spark = t["orders"].sparkSession
    root = scratch_path(spark, "daily")
    columns = ["sale_date", "product_key", "store_key", "transaction_id", "customer_id", "quantity", "total_amount"]
    lines = sales_facts(t).withColumn("transaction_id", F.col("transaction_id") * 8 + F.col("l_linenumber"))
    facts = lines.select(*columns, ntz("sale_date").alias("transaction_ts"), F.date_format("sale_date", "yyyy-MM").alias("sale_month"))
    ledger = Ledger(spark, f"{root}/tables")
    start = ledger.begin()
    start.replace("products_staging", _products_source(t))
    start.replace("products", _products_dim(t))
    start.replace("control", spark.createDataFrame([], "table_name string, last_load_timestamp timestamp_ntz, rows_loaded bigint, status string"))
    start.commit("setup")
    return pipelines.pipe_daily_etl(spark, pipelines.Warehouse(ledger, facts, f"{root}/log", part="sale_month"), datetime(2001, 7, 31), date(2001, 7, 31))
