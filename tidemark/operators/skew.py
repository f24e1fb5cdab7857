"""How evenly a partition column spreads rows over the directories of a stored table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import share
from tidemark.registry import registered
from tidemark.sources.footers import stored_counts

Tables = Mapping[str, DataFrame]


def _all():
    """All rows; used over at most one row per segment."""
    return W.partitionBy()


@registered("""
    WITH s AS (SELECT cast(strftime(o_orderdate, '%Y') AS integer) AS segment_id, count(*) AS row_count FROM orders GROUP BY 1)
    SELECT segment_id, row_count, round(1e2 * row_count / sum(row_count) OVER (), 2) AS percentage,
           round(1e2 * (row_count - avg(row_count) OVER ()) / avg(row_count) OVER (), 2) AS deviation_from_avg FROM s
""")
def skew_segments(t: Tables) -> DataFrame:
    average = F.avg("row_count").over(_all())
    return (
        stored_counts(t["orders"], F.year("o_orderdate"))
        .withColumn("percentage", share(F.col("row_count"), F.sum("row_count").over(_all())))
        .withColumn("deviation_from_avg", share(F.col("row_count") - average, average))
    )


@registered("""
    WITH s AS (SELECT o_orderstatus AS segment, count(*) AS row_count FROM orders GROUP BY 1),
    p AS (SELECT cast(ascii(segment) AS integer) AS segment_id, sum(row_count)::bigint AS row_count FROM s GROUP BY 1)
    SELECT segment_id, row_count, round(1e2 * row_count / sum(row_count) OVER (), 2) AS percentage,
           CASE WHEN round(1e2 * row_count / sum(row_count) OVER (), 2) > 150.0 / count(*) OVER ()
                THEN 'SKEW DETECTED' ELSE 'OK' END AS skew_status FROM p
""")
def skew_flag_150(t: Tables) -> DataFrame:
    """A key with few values fills few directories; flagged above one and a half times the fair share."""
    percentage = share(F.col("row_count"), F.sum("row_count").over(_all()))
    limit = F.lit(150.0) / F.count("*").over(_all())
    return (
        stored_counts(t["orders"], F.ascii("o_orderstatus"))
        .withColumn("percentage", percentage)
        .withColumn("skew_status", F.when(F.col("percentage") > limit, "SKEW DETECTED").otherwise("OK"))
    )


@registered("""
    WITH s AS (SELECT cast(strftime(l_shipdate, '%Y') AS integer) AS segment_id, count(*) AS row_count FROM lineitem GROUP BY 1)
    SELECT segment_id, row_count, round(1e2 * row_count / sum(row_count) OVER (), 2) AS percentage,
           CASE WHEN abs(row_count - avg(row_count) OVER ()) / avg(row_count) OVER () < 0.1::double THEN 'Balanced'
                WHEN abs(row_count - avg(row_count) OVER ()) / avg(row_count) OVER () < 0.2::double THEN 'Minor skew'
                ELSE 'Significant skew' END AS status FROM s
""")
def skew_bands(t: Tables) -> DataFrame:
    average = F.avg("row_count").over(_all())
    off = F.abs(F.col("row_count") - average) / average
    # Below 10 % off the average is balanced, below 20 % minor.
    return (
        stored_counts(t["lineitem"], F.year("l_shipdate"))
        .withColumn("percentage", share(F.col("row_count"), F.sum("row_count").over(_all())))
        .withColumn("status", F.when(off < 0.1, "Balanced").when(off < 0.2, "Minor skew").otherwise("Significant skew"))
    )


@registered("""
    WITH s AS (SELECT strftime(l_shipdate, '%Y') AS segment_id, count(*) AS row_count FROM lineitem GROUP BY 1)
    SELECT max(row_count) AS max_rows, min(row_count) AS min_rows, sum(row_count)::double / count(*) AS avg_rows,
           round(1e2 * (max(row_count) - min(row_count)) / (sum(row_count)::double / count(*)), 2) AS skew_percentage,
           round(1e2 * (max(row_count) - min(row_count)) / (sum(row_count)::double / count(*)), 2) < 10 AS ideal
    FROM s
""")
def skew_coefficient(t: Tables, target: float = 10.0) -> DataFrame:
    average = F.sum("row_count").cast("double") / F.count("*")
    return (
        stored_counts(t["lineitem"], F.year("l_shipdate"))
        .agg(
            F.max("row_count").alias("max_rows"),
            F.min("row_count").alias("min_rows"),
            average.alias("avg_rows"),
            share(F.max("row_count") - F.min("row_count"), average).alias("skew_percentage"),
        )
        .withColumn("ideal", F.col("skew_percentage") < target)
    )


@registered("""
    SELECT cast(strftime(o_orderdate, '%Y') AS integer) AS segment_id, count(*) AS row_count, min(o_custkey) AS min_cust,
           max(o_custkey) AS max_cust FROM orders GROUP BY 1
""")
def skew_key_range(t: Tables) -> DataFrame:
    counts = stored_counts(t["orders"], F.year("o_orderdate"), "o_custkey")
    return counts.withColumnsRenamed({"min_o_custkey": "min_cust", "max_o_custkey": "max_cust"})
