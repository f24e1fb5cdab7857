"""Registered quality queries over staged text made from the line items, with faults at fixed keys."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import money, on
from tidemark.functions.scratch import scratch_path
from tidemark.operators import quality as dq
from tidemark.plans.pipelines import load_checked
from tidemark.registry import registered
from tidemark.sources.ledger import Ledger

_STAGE_SQL = r"""
    WITH raw AS (SELECT
        CASE WHEN l_orderkey % 40 = 0 THEN 'x' || l_orderkey WHEN l_orderkey % 40 = 1 THEN NULL ELSE l_orderkey::varchar END AS order_id,
        l_suppkey::varchar AS customer_id, l_partkey::varchar AS product_id,
        CASE WHEN l_partkey % 50 = 3 THEN strftime(l_shipdate, '%d.%m.%Y') WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
             ELSE strftime(l_shipdate, '%m/%d/%Y') END AS order_date,
        CASE l_partkey % 30 WHEN 5 THEN '0' WHEN 6 THEN '-1' ELSE l_quantity::integer::varchar END AS quantity,
        CASE l_suppkey % 20 WHEN 3 THEN 'abc' WHEN 4 THEN l_linenumber || '.' ELSE l_extendedprice::decimal(12,2)::varchar END AS price,
        '  ' || lower(l_returnflag) || ' ' AS status FROM lineitem),
    clean AS (SELECT CASE WHEN regexp_full_match(order_id, '\d+') THEN order_id::integer END AS order_id,
        customer_id::integer AS customer_id, product_id::integer AS product_id,
        CASE WHEN regexp_full_match(order_date, '\d{4}-\d{2}-\d{2}') THEN order_date::date
             WHEN regexp_full_match(order_date, '\d{2}/\d{2}/\d{4}') THEN strptime(order_date, '%m/%d/%Y')::date END AS order_date,
        CASE WHEN regexp_full_match(quantity, '\d+') AND quantity::integer > 0 THEN quantity::integer END AS quantity,
        CASE WHEN regexp_full_match(price, '\d+\.?\d*') THEN rtrim(price, '.')::decimal(10,2)::double END AS price,
        upper(trim(status)) AS status FROM raw),
    marked AS (SELECT *, CASE WHEN order_id IS NULL OR customer_id IS NULL OR product_id IS NULL OR order_date IS NULL
        OR quantity IS NULL OR price IS NULL THEN 'INVALID' ELSE 'VALID' END AS validation_status FROM clean)
"""


def staged_sales(t) -> DataFrame:
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    text = lambda c: c.cast("string")
    dates = (
        F.when(part % 50 == 3, F.date_format("l_shipdate", "dd.MM.yyyy"))
        .when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
    )
    lines = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    return lines.select(
        F.when(order % 40 == 0, F.concat(F.lit("x"), text(order))).when(order % 40 != 1, text(order)).alias("order_id"),
        text(supplier).alias("customer_id"),
        text(part).alias("product_id"),
        dates.alias("order_date"),
        F.when(part % 30 == 5, "0").when(part % 30 == 6, "-1").otherwise(text(F.col("l_quantity").cast("int"))).alias("quantity"),
        F.when(supplier % 20 == 3, "abc")
        .when(supplier % 20 == 4, F.concat(text(F.col("l_linenumber")), F.lit(".")))
        .otherwise(text(money("l_extendedprice")))
        .alias("price"),
        F.concat(F.lit("  "), F.lower("l_returnflag"), F.lit(" ")).alias("status"),
    )


@registered(_STAGE_SQL + "SELECT * FROM marked")
def dq_validate_clean(t) -> DataFrame:
    return dq.dq_validate_clean(staged_sales(t)).drop("raw_data").withColumn("price", F.col("price").cast("double"))


@registered(_STAGE_SQL.replace("WITH raw AS (SELECT", "WITH raw AS (SELECT l_linenumber,").replace("clean AS (SELECT", "clean AS (SELECT order_id AS raw_order, price AS raw_price,") + """
    SELECT 'fact' AS target, order_id, customer_id, product_id, order_date, quantity, price, status, NULL::varchar AS raw_order, NULL::varchar AS raw_price, NULL::varchar AS error_message
    FROM marked WHERE validation_status = 'VALID'
    UNION ALL SELECT 'errors', NULL, NULL, NULL, NULL, NULL, NULL, NULL, raw_order, raw_price, 'Validation failed' FROM marked WHERE validation_status = 'INVALID'
""")
def dq_route_valid_invalid(t) -> DataFrame:
    valid, errors = dq.dq_route_valid_invalid(dq.dq_validate_clean(staged_sales(t)))
    facts = valid.select(F.lit("fact").alias("target"), "*").withColumn("price", F.col("price").cast("double"))
    raw = lambda name: F.get_json_object("raw_data", f"$.{name}")
    failed = errors.select(F.lit("errors").alias("target"), raw("order_id").alias("raw_order"), raw("price").alias("raw_price"), "error_message")
    return facts.unionByName(failed, allowMissingColumns=True)


@registered(_STAGE_SQL + """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE order_id IS NULL) AS null_order_id,
           count(*) FILTER (WHERE order_date IS NULL) AS null_order_date, count(*) FILTER (WHERE price IS NULL) AS null_price FROM clean
""")
def dq_null_counts(t) -> DataFrame:
    return dq.dq_null_counts(dq.dq_validate_clean(staged_sales(t)), ["order_id", "order_date", "price"])


@registered("""
    SELECT count(*) FILTER (WHERE c_acctbal < 0) AS negative_amount, count(*) FILTER (WHERE c_acctbal > 9000) AS suspiciously_high_amount,
           0::bigint AS old_dates, 0::bigint AS future_dates, 'customer' AS table_name FROM customer
    UNION ALL
    SELECT count(*) FILTER (WHERE o_totalprice < 0), count(*) FILTER (WHERE o_totalprice > 10000),
           count(*) FILTER (WHERE o_orderdate < date '1996-01-01'), count(*) FILTER (WHERE o_orderdate > date '2001-07-01'), 'orders' FROM orders
""")
def dq_range_checks(t, oldest=date(1996, 1, 1), today=date(2001, 7, 1)) -> DataFrame:
    never = F.lit(False)
    balances = dq.dq_range_checks(
        t["customer"],
        {
            "negative_amount": F.col("c_acctbal") < 0, "suspiciously_high_amount": F.col("c_acctbal") > 9000,
            "old_dates": never, "future_dates": never,
        },
    )
    orders = dq.dq_range_checks(
        t["orders"],
        {
            "negative_amount": F.col("o_totalprice") < 0, "suspiciously_high_amount": F.col("o_totalprice") > 10_000,
            "old_dates": F.col("o_orderdate") < on(oldest), "future_dates": F.col("o_orderdate") > on(today),
        },
    )
    return balances.withColumn("table_name", F.lit("customer")).unionByName(orders.withColumn("table_name", F.lit("orders")))


@registered(_STAGE_SQL + """
    SELECT 'Total Rows' AS check_name, count(*)::varchar AS result FROM clean
    UNION ALL SELECT 'NULL order_id', (count(*) FILTER (WHERE order_id IS NULL))::varchar FROM clean
    UNION ALL SELECT 'NULL price', (count(*) FILTER (WHERE price IS NULL))::varchar FROM clean
    UNION ALL SELECT 'Low prices', (count(*) FILTER (WHERE price < 1000))::varchar FROM clean
    UNION ALL SELECT 'Duplicates', count(*)::varchar FROM (SELECT order_id, product_id FROM clean GROUP BY 1, 2 HAVING count(*) > 1)
""")
def dq_report(t) -> DataFrame:
    checks = {"NULL order_id": F.col("order_id").isNull(), "NULL price": F.col("price").isNull(), "Low prices": F.col("price") < 1000}
    return dq.dq_report(dq.dq_validate_clean(staged_sales(t)), checks, ["order_id", "product_id"])


_RULES = [
    ("big discount", "l_discount > 0.09", "WARNING", "rows with a large discount"),
    ("missing key", "l_orderkey IS NULL OR l_partkey IS NULL", "FAIL", "rows without keys"),
    ("price positive", "l_extendedprice <= 0", "FAIL", "rows with no price"),
    ("quantity positive", "NOT l_quantity > 1", "FAIL", "rows with too little"),
]


@registered("""
    SELECT 'lineitem' AS table_name, check_name, CASE WHEN n = 0 THEN 'PASS' ELSE severity END AS check_result, n AS issue_count,
           'Found ' || n || ' ' || txt AS check_details FROM (
      SELECT 'big discount' AS check_name, 'WARNING' AS severity, count(*) FILTER (WHERE l_discount > 0.09) AS n, 'rows with a large discount' AS txt FROM lineitem
      UNION ALL SELECT 'missing key', 'FAIL', count(*) FILTER (WHERE l_orderkey IS NULL OR l_partkey IS NULL), 'rows without keys' FROM lineitem
      UNION ALL SELECT 'price positive', 'FAIL', count(*) FILTER (WHERE l_extendedprice <= 0), 'rows with no price' FROM lineitem
      UNION ALL SELECT 'quantity positive', 'FAIL', count(*) FILTER (WHERE NOT l_quantity > 1), 'rows with too little' FROM lineitem)
""")
def dq_rule_engine(t) -> DataFrame:
    lines = t["lineitem"]
    rules = lines.sparkSession.createDataFrame(_RULES, "check_name string, bad string, severity string, details string")
    return dq.dq_rule_engine(lines, rules, "lineitem")


@registered("""
    WITH logs AS (SELECT event_id // 2 * 2 + CASE WHEN event_id % 100 = 1 THEN 0 ELSE event_id % 2 END AS log_id,
        CASE WHEN user_id % 50 <> 0 THEN ts END AS timestamp, 100 + (user_id * 7) % 520 AS response_code,
        (value * 100)::decimal(12,2)::bigint - 100 AS response_time_ms FROM events)
    SELECT 'web_logs' AS table_name, check_name, CASE WHEN n = 0 THEN 'PASS' ELSE severity END AS check_result, n AS issue_count,
           'Found ' || n || ' ' || txt AS check_details FROM (
      SELECT 'time or code is missing' AS check_name, 'FAIL' AS severity, count(*) FILTER (WHERE timestamp IS NULL OR response_code IS NULL) AS n, 'rows without time or code' AS txt FROM logs
      UNION ALL SELECT 'HTTP code out of range', 'FAIL', count(*) FILTER (WHERE response_code NOT BETWEEN 100 AND 599), 'rows with an impossible code' FROM logs
      UNION ALL SELECT 'Negative response time', 'FAIL', count(*) FILTER (WHERE response_time_ms < 0), 'rows with a negative time' FROM logs
      UNION ALL SELECT 'Slow response', 'WARNING', count(*) FILTER (WHERE response_time_ms > 10000), 'rows slower than ten seconds' FROM logs
      UNION ALL SELECT 'Duplicate log_id', 'FAIL', count(*), 'keys occur more than once' FROM (SELECT log_id FROM logs GROUP BY 1 HAVING count(*) > 1))
""")
def dq_web_log_checks(t) -> DataFrame:
    return dq.dq_web_log_checks(web_logs(t))


def web_logs(t) -> DataFrame:
    event = F.col("event_id")
    return t["events"].select(
        (event - event % 2 + F.when(event % 100 == 1, 0).otherwise(event % 2)).alias("log_id"),
        F.when(F.col("user_id") % 50 != 0, F.col("ts")).alias("timestamp"),
        (100 + (F.col("user_id") * 7) % 520).alias("response_code"),
        (F.round(F.col("value") * 100).cast("bigint") - 100).alias("response_time_ms"),
    )


def _promoted_logs(t) -> Ledger:
    """The first half of the month is promoted in one run, the whole month in a second."""
    logs = web_logs(t).withColumn("day", F.col("timestamp").cast("date"))
    ledger = Ledger(t["events"].sparkSession, scratch_path(t["events"].sparkSession, "web-logs"))
    for run_at, rows in ((datetime(2024, 1, 16), logs.filter(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp_ntz"))), (datetime(2024, 2, 1), logs)):
        load_checked(ledger, rows, dq.WEB_LOG_RULES, ["log_id"], run_at, "web_logs", part="day")
    return ledger


_LOGS_SQL = """
    WITH logs AS (SELECT event_id // 2 * 2 + CASE WHEN event_id % 100 = 1 THEN 0 ELSE event_id % 2 END AS log_id,
        CASE WHEN user_id % 50 <> 0 THEN ts END AS timestamp, 100 + (user_id * 7) % 520 AS response_code,
        (value * 100)::decimal(12,2)::bigint - 100 AS response_time_ms FROM events),
    flagged AS (SELECT *, timestamp IS NULL OR response_code IS NULL AS b0, response_code NOT BETWEEN 100 AND 599 AS b1,
        response_time_ms < 0 AS b2, response_time_ms > 10000 AS b3 FROM logs),
    runs AS (SELECT 1 AS run, * FROM flagged WHERE timestamp < timestamp '2024-01-16 00:00:00' UNION ALL SELECT 2, * FROM flagged),
    valid AS (SELECT *, row_number() OVER (PARTITION BY run, log_id ORDER BY timestamp, response_code, response_time_ms) AS nth FROM runs
              WHERE NOT (b0 OR b1 OR b2))
"""


@registered(_LOGS_SQL + """
    SELECT 'promoted' AS outcome, log_id, timestamp, response_code, response_time_ms, NULL AS broken_rules FROM valid v WHERE nth = 1
        AND (run = 1 OR NOT EXISTS (SELECT 1 FROM valid w WHERE w.run = 1 AND w.log_id = v.log_id))
    UNION ALL
    SELECT 'rejected', log_id, timestamp, response_code, response_time_ms, concat_ws('; ', CASE WHEN b0 THEN 'time or code is missing' END,
        CASE WHEN b1 THEN 'HTTP code out of range' END, CASE WHEN b2 THEN 'Negative response time' END, CASE WHEN b3 THEN 'Slow response' END)
    FROM runs WHERE b0 OR b1 OR b2
""")
def load_web_logs(t) -> DataFrame:
    """Web logs promoted by day with insert-ignore, and the rows each run kept back."""
    ledger = _promoted_logs(t)
    columns = ["log_id", "timestamp", "response_code", "response_time_ms"]
    promoted = ledger.rows("web_logs").select(F.lit("promoted").alias("outcome"), *columns, F.lit(None).cast("string").alias("broken_rules"))
    rejected = ledger.rows("web_logs_rejected")
    return promoted.unionByName(rejected.select(F.lit("rejected").alias("outcome"), *columns, F.array_join("broken_rules", "; ").alias("broken_rules")))


@registered(_LOGS_SQL + """
    , counted AS (SELECT run, 'time or code is missing' AS check_name, 'FAIL' AS severity, count(*) FILTER (WHERE b0) AS n, 'rows without time or code' AS txt FROM runs GROUP BY 1
      UNION ALL SELECT run, 'HTTP code out of range', 'FAIL', count(*) FILTER (WHERE b1), 'rows with an impossible code' FROM runs GROUP BY 1
      UNION ALL SELECT run, 'Negative response time', 'FAIL', count(*) FILTER (WHERE b2), 'rows with a negative time' FROM runs GROUP BY 1
      UNION ALL SELECT run, 'Slow response', 'WARNING', count(*) FILTER (WHERE b3), 'rows slower than ten seconds' FROM runs GROUP BY 1
      UNION ALL SELECT r.run, 'Duplicate log_id', 'FAIL', (SELECT count(*) FROM valid v WHERE v.run = r.run AND nth = 2), 'keys occur more than once' FROM (SELECT DISTINCT run FROM runs) r)
    SELECT CASE run WHEN 1 THEN timestamp '2024-01-16 00:00:00' ELSE timestamp '2024-02-01 00:00:00' END AS run_at, 'web_logs' AS table_name, check_name,
           CASE WHEN n = 0 THEN 'PASS' ELSE severity END AS check_result, n AS issue_count, 'Found ' || n || ' ' || txt AS check_details FROM counted
""")
def dq_history(t) -> DataFrame:
    """What every check of every run found."""
    return _promoted_logs(t).rows("dq_history")


@registered("""
    WITH f AS (SELECT l_orderkey, l_partkey FROM lineitem)
    SELECT 'l_orderkey' AS foreign_key, count(DISTINCT l_orderkey) AS orphan_keys, count(*) AS orphan_rows FROM f
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderdate < date '2001-06-01')
    UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey), count(*) FROM f
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 49)
""")
def dq_referential(t, until=date(2001, 6, 1)) -> DataFrame:
    orders = t["orders"].filter(F.col("o_orderdate") < on(until))
    parts = t["part"].filter(F.col("p_size") < 49)
    return dq.dq_referential(t["lineitem"], {"l_orderkey": (orders, "o_orderkey"), "l_partkey": (parts, "p_partkey")})


@registered("SELECT o_orderkey, o_custkey FROM orders")
def dq_gate(t) -> DataFrame:
    rows = t["orders"].select("o_orderkey", "o_custkey")
    return dq.dq_gate(rows, F.col("o_orderkey").isNull() | F.col("o_custkey").isNull())


@registered("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer WHERE NOT c_nationkey % 5 = 0
""")
def dq_cleanse(t) -> DataFrame:
    """A nation key divisible by five stands for a missing key; negative balances become zero."""
    balance = F.col("c_acctbal")
    rows = t["customer"].select("c_custkey", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("nation"), "c_acctbal")
    fixes = {"c_acctbal": F.when(balance < 0, 0.0).otherwise(balance)}
    return dq.dq_cleanse(rows, F.col("nation").isNull(), fixes).drop("nation")
