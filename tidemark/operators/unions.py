"""UNION ALL reports: labelled counts, load status, check rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import EVENTS_AS_OF, ORDERS_AS_OF, day, ntz, on
from tidemark.registry import registered

Tables = Mapping[str, DataFrame]


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@registered("""
    SELECT 'Products' AS entity, count(*) AS row_count FROM part
    UNION ALL SELECT 'Customers', count(*) FROM customer
    UNION ALL SELECT 'Orders', count(*) FROM orders
    UNION ALL SELECT 'Order Items', count(*) FROM lineitem
""")
def union_entity_counts(t: Tables) -> DataFrame:
    labels = {"Products": "part", "Customers": "customer", "Orders": "orders", "Order Items": "lineitem"}
    return stacked(
        [t[name].agg(F.count("*").alias("row_count")).select(F.lit(label).alias("entity"), "row_count")
         for label, name in labels.items()]
    )


@registered("""
    SELECT 'Orders' AS table_name, count(*) AS total_rows,
           count(*) FILTER (WHERE cast(o_orderdate AS date) = date '2001-08-01') AS loaded_today,
           max(o_orderdate) AS last_load_time, cast(NULL AS timestamp) AS latest_data_timestamp FROM orders
    UNION ALL
    SELECT 'Order Items', count(*), count(*) FILTER (WHERE cast(l_shipdate AS date) = date '2001-08-01'),
           max(l_shipdate), cast(NULL AS timestamp) FROM lineitem
    UNION ALL
    SELECT 'Web Events', count(*), count(*) FILTER (WHERE cast(ts AS date) = date '2024-01-30'), max(ts),
           max(ts) FILTER (WHERE event_type = 'purchase') FROM events
""")
def union_load_status(t: Tables, orders_day: date = ORDERS_AS_OF, events_day: date = EVENTS_AS_OF - timedelta(days=1)):
    def status(df: DataFrame, label: str, ts: str, today: date, latest=None) -> DataFrame:
        return df.agg(
            F.count("*").alias("total_rows"),
            F.count_if(day(ts) == on(today)).alias("loaded_today"),
            F.max(ts).alias("last_load_time"),
            (F.lit(None).cast("timestamp_ntz") if latest is None else latest).alias("latest_data_timestamp"),
        ).withColumn("table_name", F.lit(label))

    bought = ntz(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))))
    return stacked(
        [
            status(t["orders"], "Orders", "o_orderdate", orders_day),
            status(t["lineitem"], "Order Items", "l_shipdate", orders_day),
            status(t["events"], "Web Events", "ts", events_day, bought),
        ]
    )


@registered("""
    SELECT 'Pending Orders' AS check_name,
           CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'WARNING' ELSE 'OK' END AS status,
           (count(*) FILTER (WHERE o_orderstatus = 'P')) || '/' || count(*) || ' orders pending' AS details FROM orders
    UNION ALL
    SELECT 'Customers In Debt', CASE WHEN count(*) FILTER (WHERE c_acctbal < 0) > 10 THEN 'CRITICAL'
           WHEN count(*) FILTER (WHERE c_acctbal < 0) > 0 THEN 'INFO' ELSE 'OK' END,
           (count(*) FILTER (WHERE c_acctbal < 0)) || ' of ' || count(*) || ' customers below zero' FROM customer
    UNION ALL
    SELECT 'Error Events', CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'WARNING' ELSE 'OK' END,
           (count(*) FILTER (WHERE event_type = 'error')) || ' error events' FROM events
""")
def union_check_rows(t: Tables, many: int = 10) -> DataFrame:
    def check(df: DataFrame, bad, name: str, status, text: str) -> DataFrame:
        counted = df.agg(F.count_if(bad).alias("bad"), F.count("*").alias("rows"))
        return counted.select(
            F.lit(name).alias("check_name"), status.alias("status"), F.format_string(text, "bad", "rows").alias("details")
        )

    bad = F.col("bad")
    warn = F.when(bad > 0, "WARNING").otherwise("OK")
    graded = F.when(bad > many, "CRITICAL").when(bad > 0, "INFO").otherwise("OK")
    return stacked(
        [
            check(t["orders"], F.col("o_orderstatus") == "P", "Pending Orders", warn, "%d/%d orders pending"),
            check(t["customer"], F.col("c_acctbal") < 0, "Customers In Debt", graded, "%d of %d customers below zero"),
            check(t["events"], F.col("event_type") == "error", "Error Events", warn, "%d error events"),
        ]
    )
