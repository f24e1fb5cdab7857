"""Counts and bounds out of Parquet footers, without reading a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scratch import scratch_path
from tidemark.sources.writers import write_partitioned

# Spark answers COUNT, MIN and MAX from footers, per directory too, in its second Parquet reader.
_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.parquet.filterPushdown": "true",
}
_sessions: dict[int, SparkSession] = {}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which Parquet aggregates are pushed down; ``spark`` keeps its settings."""
    held = _sessions.get(id(spark.sparkContext))
    if held is None:
        held = _sessions[id(spark.sparkContext)] = spark.newSession()
        for key, value in _SETTINGS.items():
            held.conf.set(key, value)
    held.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return held


def footer_counts(spark: SparkSession, path: str, schema: str | StructType | None = None, parts: tuple[str, ...] = (), **bounds: str) -> DataFrame:
    """``row_count`` per partition directory of a stored table, and MIN and MAX of columns.

    ``low="min:price"`` and ``high="max:price"`` ask for bounds.  Footers hold the bounds of numbers
    and dates; asking for those of other columns, which are cut there, fails, and so does a row group
    without statistics.  Spark finds a column in a footer by its place, so a ``schema`` must be the
    whole one of the files, in their order, with the partition columns after it.
    """
    reader = footer_session(spark).read
    table = (reader.schema(schema) if schema else reader).parquet(path)
    kinds = dict(table.dtypes)
    columns: list[Column] = []
    for name, asked in bounds.items():
        what, _, column = asked.partition(":")
        if not kinds[column].startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean")):
            raise TypeError(f"{column}: footers hold no exact bounds of {kinds[column]}")
        columns.append({"min": F.min, "max": F.max}[what](column).alias(name))
    return table.groupBy(*parts).agg(F.count("*").alias("row_count"), *columns)


def placement(spark: SparkSession, path: str, part: str, schema: StructType | None = None, **bounds: str) -> DataFrame:
    """``part``, ``row_count`` and bounds per directory of a stored table, from its file footers.

    Nothing but footers is read, so the report costs the same however wide or long the rows are.
    There is at most one row per directory, small enough for a window over all of them.
    """
    return footer_counts(spark, path, schema, (part,), **bounds)


def stored_counts(df: DataFrame, part: Column, *ranged: str) -> DataFrame:
    """``df`` stored in directories by ``part``, and the placement report of that table.

    ``df`` should be a stored table: its rows are counted first, from its footers.
    """
    path = scratch_path(df.sparkSession, "placed")
    columns = [F.col(c) for c in ranged] or [F.lit(True).alias("present")]
    placed = df.select(*columns, part.cast("int").alias("segment_id"))
    write_partitioned(placed, path, "segment_id", rows=df.count())
    bounds = {f"{name}_{c}": f"{name}:{c}" for c in ranged for name in ("min", "max")}
    return placement(df.sparkSession, path, "segment_id", placed.schema, **bounds)
