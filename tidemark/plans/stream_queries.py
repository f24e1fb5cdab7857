"""Registered streaming queries: the given tables read as streams until nothing is left."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import money, on
from tidemark.functions.scratch import scratch_path
from tidemark.operators import loads
from tidemark.registry import registered
from tidemark.sources.writers import KeyedTable, VersionedTable
from tidemark.streaming import streams, toplist
from tidemark.streaming.hotkeys import mark_hot

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _events(t) -> DataFrame:
    return streams.file_stream(t.spark, t.path, EVENTS, glob="events.parquet")


def _root(t, name: str) -> str:
    return scratch_path(t.spark, name)


@registered("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def st_file_ingest(t) -> DataFrame:
    """Two runs over the same checkpoint; the second finds no new file."""
    root = _root(t, "ingest")
    for _ in range(2):
        streams.st_file_ingest(_events(t), f"{root}/data", f"{root}/checkpoint")
    return t.spark.read.schema(EVENTS).parquet(f"{root}/data")


@registered("""
    WITH w AS (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start, * FROM events)
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS event_count,
           sum(value::decimal(12,2))::double AS amount, max(value) AS largest FROM w
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2, 3
""")
def st_window_metrics(t) -> DataFrame:
    """Hourly windows every half hour; the windows still open at the end of the data are not emitted."""
    root = _root(t, "windows")
    measures = {
        "event_count": F.count("*"), "amount": F.sum(money("value")).cast("double"), "largest": F.max("value"),
    }
    metrics = streams.st_window_metrics(_events(t), "ts", ["event_type"], measures, "1 hour", "30 minutes")
    streams.drain(metrics, f"{root}/data", f"{root}/checkpoint")
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, event_type string, event_count bigint, amount double, largest double"
    return t.spark.read.schema(schema).parquet(f"{root}/data")


@registered("""
    SELECT event_id, user_id, event_type, CASE WHEN event_id % 50 = 0 AND ts < timestamp '2024-01-21 00:00:00'
      AND ts < (SELECT max(ts) - INTERVAL 1 DAY FROM events WHERE NOT (event_id % 50 = 0 AND ts < timestamp '2024-01-21 00:00:00')) THEN 'late' ELSE 'on time' END AS arrival
    FROM events
""")
def st_late_data(t) -> DataFrame:
    """Three arrivals: the first twenty days, the rest, and some rows of the first days again late."""
    root, edge = _root(t, "late"), F.lit("2024-01-21 00:00:00").cast("timestamp_ntz")
    early, held = F.col("ts") < edge, F.col("event_id") % 50 == 0
    for wave in (early & ~held, ~early, early & held):
        t["events"].filter(wave).write.mode("append").parquet(f"{root}/in")
        stream = streams.file_stream(t.spark, f"{root}/in", EVENTS)
        streams.st_late_data(stream, "ts", timedelta(days=1), f"{root}/out", f"{root}/checkpoint")
    part = lambda late, label: streams.late_rows(t.spark, f"{root}/out", EVENTS, late).select(
        "event_id", "user_id", "event_type", F.lit(label).alias("arrival")
    )
    return part(False, "on time").unionByName(part(True, "late"))


@registered("SELECT event_id, ts, user_id, event_type, value FROM events")
def st_dedup(t) -> DataFrame:
    """Every event arrives twice."""
    root = _root(t, "dedup")
    doubled = _events(t).union(_events(t))
    streams.drain(streams.st_dedup(doubled, "event_id", "ts", "1 hour"), f"{root}/data", f"{root}/checkpoint")
    rows = t.spark.read.parquet(f"{root}/data")
    return rows.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


@registered("""
    SELECT e.user_id, e.event_id, p.event_id AS purchase_id, p.value AS amount FROM events e JOIN events p ON e.user_id = p.user_id
      AND p.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts + INTERVAL 1 HOUR
    WHERE e.event_type = 'click' AND p.event_type = 'purchase'
""")
def st_interval_join(t) -> DataFrame:
    """Two arrivals; after the first, users with more than a hundredth of its rows are dealt to several tasks."""
    root, spark, kind = _root(t, "join"), t.spark, F.col("event_type")
    hot = VersionedTable(spark, f"{root}/hot")
    hot.publish(spark.createDataFrame([], "user_id bigint, salts int, from_slot bigint"))
    edge = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for wave in (F.col("ts") < edge, F.col("ts") >= edge):
        t["events"].filter(wave).write.mode("append").parquet(f"{root}/in")
        events = streams.file_stream(spark, f"{root}/in", EVENTS)
        clicks = events.filter(kind == "click").select("user_id", "event_id", F.col("ts").alias("event_ts"))
        bought = events.filter(kind == "purchase").select(
            "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"), F.col("value").alias("amount")
        )
        joined = streams.st_interval_join(clicks, bought, "user_id", "event_ts", "purchase_ts", 3600, "1 hour", hot.current())
        streams.drain(joined.select("user_id", "event_id", "purchase_id", "amount"), f"{root}/data", f"{root}/checkpoint")
        mark_hot(hot, spark.read.schema(EVENTS).parquet(f"{root}/in"), "user_id", "ts", 3600, 3600)
    return spark.read.schema("user_id bigint, event_id bigint, purchase_id bigint, amount double").parquet(f"{root}/data")


@registered("""
    WITH s AS (SELECT date_trunc('day', ts) AS d, user_id, sum(value::decimal(12,2))::double AS amount FROM events
      WHERE user_id IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY amount DESC, user_id) AS rank FROM s)
    SELECT (d + INTERVAL 1 DAY)::timestamp AS window_end, cast(rank AS integer) AS rank, user_id AS item, amount FROM r
    WHERE rank <= 10 AND d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def st_top_of_day(t, k: int = 10) -> DataFrame:
    """The users with the largest sums of every closed day, over two arrivals that split a day."""
    root, spark = _root(t, "top"), toplist.state_session(t.spark)
    edge = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    for wave in (F.col("ts") < edge, F.col("ts") >= edge):
        t["events"].filter(wave).write.mode("append").parquet(f"{root}/in")
        stream = streams.file_stream(spark, f"{root}/in", EVENTS)
        lists = toplist.st_top_lists(stream, "ts", "user_id", money("value"), k)
        streams.drain(lists, f"{root}/data", f"{root}/checkpoint")
    stored = t.spark.read.schema("window_end bigint, bucket int, item bigint, amount double").parquet(f"{root}/data")
    return toplist.top_of_window(stored, k)


@registered("""
    SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def st_upsert(t) -> DataFrame:
    """The latest event per user, kept by two runs over two arrivals."""
    root, spark = _root(t, "upsert"), t.spark
    table = KeyedTable(spark, f"{root}/table", ["user_id"])
    columns = ["user_id", "ts", "event_id", "event_type", "value"]
    edge = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for wave in (F.col("ts") < edge, F.col("ts") >= edge):
        t["events"].filter(wave).write.mode("append").parquet(f"{root}/in")
        stream = streams.file_stream(spark, f"{root}/in", EVENTS).select(*columns)
        streams.st_upsert(stream, table, ["ts", "event_id"], f"{root}/checkpoint")
    return table.current().drop("ts")


@registered("""
    SELECT p_partkey AS product_id, p_type AS category, p_retailprice AS price, date '2024-01-01' AS valid_from,
           CASE WHEN p_partkey % 3 = 0 THEN date '2025-01-01' ELSE date '9999-12-31' END AS valid_to, p_partkey % 3 <> 0 AS is_current
    FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT p_partkey, p_type, p_retailprice + 2, date '2025-01-01', date '9999-12-31', true FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT p_partkey, p_type, p_retailprice, date '2025-01-01', date '9999-12-31', true FROM part WHERE p_partkey % 2 <> 0 AND p_partkey % 3 <> 0
""")
def st_cdc_scd2(t) -> DataFrame:
    """Even products are known.  Products divisible by three change their price twice; the unknown ones appear."""
    root, spark = _root(t, "cdc"), t.spark
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    columns = [key.alias("product_id"), F.col("p_type").alias("category"), price.alias("price")]
    table = KeyedTable(spark, f"{root}/dim", ["product_id"])
    table.publish(
        t["part"].filter(key % 2 == 0).select(
            *columns, on("2024-01-01").alias("valid_from"), on(loads.END_OF_TIME).alias("valid_to"), F.lit(True).alias("is_current")
        )
    )
    steps = F.when(key % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    changes = t["part"].filter((key % 3 == 0) | (key % 2 != 0)).select(*columns, F.explode(steps).alias("seq"))
    changes.withColumn("price", F.col("price") + F.col("seq")).write.parquet(f"{root}/feed")
    stream = streams.file_stream(spark, f"{root}/feed", "product_id bigint, category string, price double, seq int")
    streams.st_cdc_scd2(
        stream, table, ["category", "price"], ["seq"], lambda batch: date(2025, 1, 1) + timedelta(days=batch), f"{root}/checkpoint"
    )
    return table.current()
