"""Physical layouts: hash buckets, random spread, replicated dimensions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scratch import scratch_path

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` as rows in memory: one distributed aggregate over the actual data."""
    fixed, varying = 16, []
    for field in df.schema.fields:
        fixed += 8
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            varying.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
        elif not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            varying.append(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)))
    width = F.lit(fixed).cast("bigint")
    for size in varying:
        width = width + size
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def replicated(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A dimension copied to every executor, if its measured size allows it.

    A larger one is returned as it is: its joins shuffle, and AQE splits skewed keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def layout_random(df: DataFrame, n: int | None = None) -> DataFrame:
    """Rows spread evenly over ``n`` partitions, by default the session's, whatever their values."""
    return df.repartition(n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hottest_share(df: DataFrame, key: str) -> float:
    """Share of all rows that the most frequent value of ``key`` holds."""
    row = df.groupBy(key).count().agg(F.max("count").alias("top"), F.sum("count").alias("rows")).first()
    return (row["top"] or 0) / row["rows"] if row["rows"] else 0.0


class HotKey(ValueError):
    """One value of the key holds more rows than a bucket should."""


def layout_hash(
    df: DataFrame, key: str, n: int | None = None, name: str | None = None, path: str | None = None, max_share: float | None = None
) -> DataFrame:
    """Store ``df`` in ``n`` buckets of ``key``, sorted by it, and return the stored table.

    One task writes, and later reads, each bucket; by default there are as many as the
    session has shuffle partitions.  A value with a large part of all rows does not suit
    buckets: with ``max_share`` the keys are counted first, and one above it raises ``HotKey``.
    Only a table that was given a ``name`` stays in the catalog; the returned one knows its buckets without.
    """
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if max_share is not None and (share := hottest_share(df, key)) > max_share:
        raise HotKey(f"one value of {key} holds {share:.0%} of the rows; shuffle instead, so that it can be split")
    passing = name is None
    name = name or f"tidemark_{uuid.uuid4().hex}"
    (
        df.repartition(n, key).write.bucketBy(n, key)
        .sortBy(key)
        .option("path", path or scratch_path(spark, name))
        .saveAsTable(name)
    )
    stored = spark.table(name)
    if passing:
        spark.sql(f"DROP TABLE {name}")  # stored under a path, so its files stay
    return stored


def colocated_pair(
    facts: DataFrame, fact_key: str, dims: DataFrame, dim_key: str, n: int | None = None, max_share: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both tables bucketed alike on the join key."""
    n = n or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return layout_hash(facts, fact_key, n, max_share=max_share), layout_hash(dims, dim_key, n)
