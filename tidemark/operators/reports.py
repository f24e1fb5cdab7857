"""Reports over load and run logs."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import EVENTS_AS_OF, back, mean, micros, money, on, total
from tidemark.operators.unions import stacked
from tidemark.registry import registered

Tables = Mapping[str, DataFrame]

# The run log the reports are registered over: one event is one run.
_LOG_SQL = """
    WITH log AS (SELECT event_id AS run_id, event_type AS table_name, 'step_' || (user_id % 4) AS step_name,
        CASE WHEN cast(json_extract_string(props, '$.k') AS bigint) % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        cast(json_extract_string(props, '$.k') AS bigint) * 100 AS rows_loaded, user_id % 7 AS rows_rejected,
        ts AS load_start, cast(floor(value) AS bigint) AS seconds,
        ts + to_seconds(floor(value)) AS load_end,
        CASE WHEN cast(json_extract_string(props, '$.k') AS bigint) % 10 = 0
             THEN 'code ' || json_extract_string(props, '$.k') END AS error_message
      FROM events)
"""


def event_log(t: Tables) -> DataFrame:
    """Events read as rows of a run log, in the columns that the pipelines write."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    failed = k % 10 == 0
    seconds = F.floor("value").cast("bigint")
    return t["events"].select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("process_name"),
        F.concat(F.lit("step_"), (F.col("user_id") % 4).cast("string")).alias("step_name"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        (k * 100).alias("rows_affected"),
        (F.col("user_id") % 7).alias("rows_rejected"),
        F.when(failed, F.concat(F.lit("code "), k.cast("string"))).alias("error_message"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=seconds)).cast("timestamp_ntz").alias("end_time"),
        seconds.alias("duration_seconds"),
    )


def run_log(t: Tables) -> DataFrame:
    """The log the reports read: the table ``run_log``, as pipelines write it, or else the events.

    A log without ``run_id`` gets one made of what tells its rows apart.
    """
    log = t["run_log"] if "run_log" in t else event_log(t)
    run_id = F.col("run_id") if "run_id" in log.columns else F.xxhash64("process_name", "step_name", "start_time")
    return log.select(
        run_id.alias("run_id"),
        F.col("process_name").alias("table_name"),
        "step_name",
        "status",
        F.col("rows_affected").alias("rows_loaded"),
        "rows_rejected",
        F.col("start_time").cast("timestamp_ntz").alias("load_start"),
        F.col("duration_seconds").alias("seconds"),
        F.col("end_time").cast("timestamp_ntz").alias("load_end"),
        "error_message",
    )


@registered(
    _LOG_SQL
    + """
    SELECT table_name, count(*) AS total_loads, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_loads,
           count(*) FILTER (WHERE status = 'FAILED') AS failed_loads, sum(rows_loaded)::bigint AS total_rows_loaded,
           sum(rows_rejected)::bigint AS total_rows_rejected, cast(sum(seconds) AS double) / count(*) AS avg_load_seconds,
           max(load_end) AS last_load_time
    FROM log WHERE load_start >= date '2024-01-24' GROUP BY 1
    """
)
def rpt_load_dashboard(t: Tables, as_of: date = EVENTS_AS_OF, days: int = 7) -> DataFrame:
    return (
        run_log(t)
        .filter(F.col("load_start") >= on(back(as_of, days)))
        .groupBy("table_name")
        .agg(
            F.count("*").alias("total_loads"),
            F.count_if(F.col("status") == "SUCCESS").alias("successful_loads"),
            F.count_if(F.col("status") == "FAILED").alias("failed_loads"),
            F.sum("rows_loaded").alias("total_rows_loaded"),
            F.sum("rows_rejected").alias("total_rows_rejected"),
            mean(F.col("seconds")).alias("avg_load_seconds"),
            F.max("load_end").alias("last_load_time"),
        )
    )


@registered(
    _LOG_SQL
    + """
    SELECT table_name AS process_name, step_name, status, count(*) AS execution_count,
           cast(sum(seconds) AS double) / count(*) AS avg_duration_sec, max(seconds) AS max_duration_sec,
           min(seconds) AS min_duration_sec, count(*) FILTER (WHERE status = 'FAILED') AS error_count
    FROM log WHERE load_start >= date '2024-01-24' GROUP BY 1, 2, 3
    """
)
def rpt_etl_history(t: Tables, as_of: date = EVENTS_AS_OF, days: int = 7) -> DataFrame:
    return (
        run_log(t)
        .filter(F.col("load_start") >= on(back(as_of, days)))
        .groupBy(F.col("table_name").alias("process_name"), "step_name", "status")
        .agg(
            F.count("*").alias("execution_count"),
            mean(F.col("seconds")).alias("avg_duration_sec"),
            F.max("seconds").alias("max_duration_sec"),
            F.min("seconds").alias("min_duration_sec"),
            F.count_if(F.col("status") == "FAILED").alias("error_count"),
        )
    )


@registered(
    _LOG_SQL
    + """
    SELECT run_id, table_name AS process_name, step_name, error_message, load_start AS start_time, seconds
    FROM log WHERE status = 'FAILED' AND load_start >= date '2024-01-29'
    ORDER BY load_start DESC, run_id LIMIT 20
    """,
    days=2,
)
def rpt_etl_errors(t: Tables, as_of: date = EVENTS_AS_OF, days: int = 1, top: int = 20) -> DataFrame:
    return (
        run_log(t)
        .filter((F.col("status") == "FAILED") & (F.col("load_start") >= on(back(as_of, days))))
        .orderBy(F.desc("load_start"), "run_id")
        .limit(top)
        .select(
            "run_id", F.col("table_name").alias("process_name"), "step_name", "error_message",
            F.col("load_start").alias("start_time"), "seconds",
        )
    )


@registered(
    _LOG_SQL
    + """
    SELECT table_name AS process_name, step_name,
           cast(sum(cast(round(rows_loaded::double / nullif(seconds, 0), 6) AS decimal(18,6))) AS double)
             / nullif(count(nullif(seconds, 0)), 0) AS rows_per_second,
           cast(sum(seconds) AS double) / count(*) AS avg_duration, count(*) AS run_count
    FROM log WHERE status = 'SUCCESS' AND load_start >= date '2024-01-01' GROUP BY 1, 2
    """
)
def rpt_etl_throughput(t: Tables, as_of: date = EVENTS_AS_OF, days: int = 30) -> DataFrame:
    """Mean rows per second over runs that took at least a second."""
    seconds = F.nullif(F.col("seconds"), F.lit(0))
    rate = F.round(F.col("rows_loaded").cast("double") / seconds, 6).cast("decimal(18,6)")
    return (
        run_log(t)
        .filter((F.col("status") == "SUCCESS") & (F.col("load_start") >= on(back(as_of, days))))
        .groupBy(F.col("table_name").alias("process_name"), "step_name")
        .agg(
            (total(rate) / F.nullif(F.count(seconds), F.lit(0))).alias("rows_per_second"),
            mean(F.col("seconds")).alias("avg_duration"),
            F.count("*").alias("run_count"),
        )
    )


@registered(
    _LOG_SQL
    + """
    SELECT table_name, max(load_end) AS last_load_timestamp,
           date_diff('microsecond', max(load_end), timestamp '2024-01-31 00:00:00') // 3600000000 AS hours_since_update
    FROM log WHERE status = 'SUCCESS' AND load_end <= timestamp '2024-01-31 00:00:00' GROUP BY 1
    """
)
def rpt_etl_freshness(t: Tables, as_of: date = EVENTS_AS_OF) -> DataFrame:
    now = on(as_of).cast("timestamp_ntz")
    return (
        run_log(t)
        .filter((F.col("status") == "SUCCESS") & (F.col("load_end") <= now))
        .groupBy("table_name")
        .agg(F.max("load_end").alias("last_load_timestamp"))
        .withColumn("hours_since_update", F.floor((micros(now) - micros("last_load_timestamp")) / F.lit(3_600_000_000)))
    )


@registered(
    _LOG_SQL
    + """
    SELECT (SELECT count(*) FROM orders WHERE cast(o_orderdate AS date) = date '2001-08-01') AS todays_orders,
           (SELECT cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) FROM orders
            WHERE cast(o_orderdate AS date) = date '2001-08-01') AS todays_revenue,
           (SELECT count(*) FROM log WHERE load_start >= date '2024-01-30' AND status = 'SUCCESS') AS successful_24h,
           (SELECT count(*) FROM log WHERE load_start >= date '2024-01-30' AND status = 'FAILED') AS failed_24h,
           (SELECT cast(sum(seconds) AS double) / count(*) FROM log WHERE load_start >= date '2024-01-30') AS avg_duration_24h,
           (SELECT max(load_end) FROM log WHERE status = 'SUCCESS') AS last_successful_run
    """
)
def rpt_monitor_row(t: Tables, orders_day=date(2001, 8, 1), as_of: date = EVENTS_AS_OF) -> DataFrame:
    """One row of figures: one pass over the log, one over the day's orders."""
    recent = F.col("load_start") >= on(back(as_of, 1))
    ok = F.col("status") == "SUCCESS"
    today = t["orders"].filter(F.col("o_orderdate").cast("date") == on(orders_day)).agg(
        F.count("*").alias("todays_orders"), total(money("o_totalprice")).alias("todays_revenue")
    )
    return run_log(t).agg(
        F.count_if(recent & ok).alias("successful_24h"),
        F.count_if(recent & ~ok).alias("failed_24h"),
        mean(F.when(recent, F.col("seconds"))).alias("avg_duration_24h"),
        F.max(F.when(ok, F.col("load_end"))).alias("last_successful_run"),
    ).select(*[today.select(c).scalar().alias(c) for c in today.columns], "*")


@registered(
    _LOG_SQL
    + """
    , expected AS (SELECT * FROM (VALUES ('click'), ('purchase'), ('refund')) v(table_name)),
    s AS (SELECT table_name, max(load_end) AS last_end, sum(rows_rejected) AS rejected, sum(rows_loaded) AS loaded,
                 count(*) AS runs, sum(seconds) AS seconds, arg_max(seconds, struct_pack(load_start, run_id)) AS last_seconds
          FROM log GROUP BY 1)
    SELECT 'MISSING_LOAD' AS alert_type, e.table_name,
           CASE WHEN s.last_end IS NULL THEN 'never loaded'
                ELSE 'last load at ' || strftime(s.last_end, '%Y-%m-%d %H:%M:%S') END AS issue
    FROM expected e LEFT JOIN s ON e.table_name = s.table_name
    WHERE s.last_end < timestamp '2024-01-30 00:00:00' OR s.last_end IS NULL
    UNION ALL
    SELECT 'HIGH_REJECTS', table_name, rejected || ' of ' || (rejected + loaded) || ' rows rejected' FROM s
    WHERE rejected::double / (rejected + loaded) > 0.0005::double
    UNION ALL
    SELECT 'SLOW_LOAD', table_name, 'last run took ' || last_seconds || ' s' FROM s
    WHERE runs > 1 AND last_seconds > 1.2::double * (seconds - last_seconds) / (runs - 1)
    """,
    reject_share=0.0005,
    slow_factor=1.2,
)
def rpt_load_anomalies(
    t: Tables,
    expected=("click", "purchase", "refund"),
    as_of: date = EVENTS_AS_OF,
    hours: int = 24,
    reject_share: float = 0.05,
    slow_factor: float = 2.0,
) -> DataFrame:
    """Three alerts from one row per table: no recent load, many rejects, last run slower than those before."""
    log = run_log(t)
    stats = log.groupBy("table_name").agg(
        F.max("load_end").alias("last_end"),
        F.sum("rows_rejected").alias("rejected"),
        F.sum("rows_loaded").alias("loaded"),
        F.count("*").alias("runs"),
        F.sum("seconds").alias("seconds"),
        F.max_by("seconds", F.struct("load_start", "run_id")).alias("last_seconds"),
    )
    names = log.sparkSession.createDataFrame([(n,) for n in expected], "table_name string")
    limit = on(as_of).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    missing = (
        names.join(stats, "table_name", "left")
        .filter((F.col("last_end") < limit) | F.col("last_end").isNull())
        .select(
            F.lit("MISSING_LOAD").alias("alert_type"),
            "table_name",
            F.coalesce(
                F.concat(F.lit("last load at "), F.date_format("last_end", "yyyy-MM-dd HH:mm:ss")), F.lit("never loaded")
            ).alias("issue"),
        )
    )
    offered = F.col("rejected") + F.col("loaded")
    rejects = stats.filter(F.col("rejected") / offered > reject_share).select(
        F.lit("HIGH_REJECTS").alias("alert_type"),
        "table_name",
        F.concat_ws(" ", F.col("rejected").cast("string"), F.lit("of"), offered.cast("string"), F.lit("rows rejected")).alias("issue"),
    )
    before = (F.col("seconds") - F.col("last_seconds")) / (F.col("runs") - 1)
    slow = stats.filter((F.col("runs") > 1) & (F.col("last_seconds") > slow_factor * before)).select(
        F.lit("SLOW_LOAD").alias("alert_type"),
        "table_name",
        F.concat_ws(" ", F.lit("last run took"), F.col("last_seconds").cast("string"), F.lit("s")).alias("issue"),
    )
    return stacked([missing, rejects, slow])
