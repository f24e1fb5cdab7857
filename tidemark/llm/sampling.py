"""Bounded samples of labelled rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most about ``most`` of ``rows``, chosen by a hash of ``keys``, the same ones each time.

    Never more than ``most``: a draw that comes out larger is cut, in the order of the draw.
    """
    n = rows.count()
    draw = F.pmod(F.xxhash64(*keys, F.lit("labelled sample")), F.lit(1_000_000_007))
    if n > most:
        rows = rows.withColumn("_draw", draw).filter(F.col("_draw") < int(1_000_000_007 * most / n))
        rows = rows.orderBy("_draw").limit(most).drop("_draw")
    return rows


def labelled(rows: DataFrame, labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """``rows`` with a 0/1 column ``label``; labels that are NULL or neither 0 nor 1 are left out.

    A document labelled twice learns from each label.
    """
    marks = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1))
    return rows.join(marks, rows[key] == marks["_key"]).drop("_key")


def to_pandas(rows: DataFrame) -> pd.DataFrame:
    """A bounded sample, in an order that does not depend on how it was stored."""
    frame = rows.toPandas()
    return frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)
