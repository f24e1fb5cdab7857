"""The best items of every time window of a stream, kept as a bounded list in state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.streams import timed

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams may keep state of their own; ``spark`` keeps its settings."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return session


class TopList(StatefulProcessor):
    """At most ``k`` items per key, emitted by a timer when the key's window has closed.

    The grouping key is (end of the window in milliseconds, bucket).
    """

    def __init__(self, k: int, item_type: str):
        self.k, self.item_type = k, item_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"item {self.item_type}, amount double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = list(self.best.get()) if self.best.exists() else []
        if not held:
            self.handle.registerTimer(int(key[0]))
        best = pd.DataFrame(held, columns=["item", "amount"])
        for batch in rows:
            both = pd.concat([best, batch[["item", "amount"]]]) if len(best) else batch[["item", "amount"]]
            best = both.sort_values(["amount", "item"], ascending=[False, True]).head(self.k)
        self.best.put([tuple(row) for row in best.astype(object).itertuples(index=False)])
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame(list(self.best.get()), columns=["item", "amount"])
        self.best.clear()
        yield best.assign(window_end=int(key[0]), bucket=int(key[1]))[["window_end", "bucket", "item", "amount"]]

    def close(self) -> None:
        pass


def st_top_lists(
    stream: DataFrame, ts: str, item: str, amount: Column, k: int, window: str = "1 day", delay: str = "10 minutes", buckets: int = 8
) -> DataFrame:
    """The ``k`` items with the largest sum of ``amount`` per window and bucket of items, once a window has closed.

    Sums per item are Spark's streaming aggregate, combined before the shuffle.  Only then does a list
    of ``k`` items per (window, bucket) follow, so no task sees all items of a window and a hot item is one
    row.  ``top_of_window`` reads the result.  Rows without an item, a time or an amount are left out.
    """
    item_type = dict(stream.dtypes)[item]
    rows = timed(stream.withColumn("_amount", amount), ts, delay)
    rows = rows.filter(F.col(item).isNotNull() & F.col("_amount").isNotNull() & F.col(ts).isNotNull())
    sums = rows.groupBy(F.window(ts, window), F.col(item).alias("item")).agg(F.sum("_amount").cast("double").alias("amount"))
    parts = sums.select(
        F.window_time("window").alias("_at"),  # carries the watermark
        F.unix_millis("window.end").alias("window_end"),
        F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int").alias("bucket"),
        "item",
        "amount",
    )
    return parts.groupBy("window_end", "bucket").transformWithStateInPandas(
        statefulProcessor=TopList(k, item_type),
        outputStructType=f"window_end bigint, bucket int, item {item_type}, amount double",
        outputMode="Append",
        timeMode="EventTime",
    )


def top_of_window(lists: DataFrame, k: int) -> DataFrame:
    """``window_end``, ``rank``, ``item`` and ``amount``: the best ``k`` of the buckets' lists, at most ``k`` rows a bucket."""
    order = Window.partitionBy("window_end").orderBy(F.desc("amount"), "item")
    end = F.timestamp_millis("window_end").cast("timestamp_ntz").alias("window_end")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(end, "rank", "item", "amount")
