"""Keys that hold a large part of a stream's rows, and how their rows are dealt to several tasks.

Streams have no adaptive split of a skewed join, and rows already in state cannot be dealt again.  So
a key gets more salts only from a time slot on that no row read so far has reached: for every
(key, slot) the number of salts is the same in all runs, and rows of both sides keep meeting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.writers import VersionedTable


def slot_of(ts: str | Column, seconds: int) -> Column:
    """The number of the slot of ``seconds`` that a time falls in."""
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts) / F.lit(seconds))


def hot_keys(recent: DataFrame, key: str, share: float, max_salts: int) -> DataFrame:
    """``key`` and its ``salts`` for the keys with more than ``share`` of all rows: at most 1 / share rows."""
    counts = recent.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    parts = F.least(F.ceil(F.col("n") / F.lit(max(share * total, 1.0))), F.lit(max_salts)).cast("int")
    return counts.filter(F.col("n") > share * total).select(key, parts.alias("salts")).filter("salts > 1")


def mark_hot(
    table: VersionedTable, recent: DataFrame, key: str, ts: str, seconds: int, delay_seconds: int, share: float = 0.01, max_salts: int = 16
) -> None:
    """Publish which keys are hot, with the first slot that this holds for.

    ``recent`` has ``key`` and ``ts`` of the rows of both sides, and must reach the newest time that the join
    has read.  Call it between two runs of the join.  An entry is kept while rows of its slots may be in state or
    still arrive (``delay_seconds`` of watermark and a slot to each side), so the table stays small: the
    keys that are hot now and those that were when the oldest open slot began.
    """
    newest = recent.agg(F.max(slot_of(ts, seconds))).first()[0]
    if newest is None:
        return
    start = newest + 2  # a row of the newest slot is also kept for the one after it
    closed = newest - delay_seconds // seconds - 3
    found = hot_keys(recent, key, share, max_salts).withColumn("from_slot", F.lit(start).cast("bigint"))
    stored = table.current()
    entries = found
    if stored is not None:
        ended = stored.select(key).distinct().join(found, key, "left_anti").select(key, F.lit(1).alias("salts"), F.lit(start).cast("bigint").alias("from_slot"))
        earlier = stored.filter(F.col("from_slot") < start)  # marked twice without a row in between: the later counts
        entries = earlier.unionByName(found).unionByName(ended)
    # Of the entries for closed slots only the last one of a key still says something.
    spans = entries.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("from_slot", "salts"))).alias("e"))
    last_closed = F.coalesce(F.array_max(F.transform(F.filter("e", lambda x: x["from_slot"] <= closed), lambda x: x["from_slot"])), F.lit(0))
    open_ones = F.filter("e", lambda x: x["from_slot"] >= last_closed)
    open_ones = F.when(F.exists(open_ones, lambda x: x["salts"] > 1), open_ones)  # NULL: the key is an ordinary one again
    table.publish(spans.select(key, F.explode(open_ones).alias("x")).select(key, "x.salts", "x.from_slot").coalesce(1))


def salted(df: DataFrame, key: str, slot: str, hot: DataFrame) -> DataFrame:
    """``df`` with ``_salts``, the number of salts of its row's (key, slot)."""
    spans = hot.groupBy(F.col(key).alias("_hot_key")).agg(F.sort_array(F.collect_list(F.struct("from_slot", "salts"))).alias("_spans"))
    known = df.join(F.broadcast(spans), F.col(key) == F.col("_hot_key"), "left")  # bounded by ``mark_hot``
    valid = F.aggregate(
        F.coalesce("_spans", F.array().cast("array<struct<from_slot:bigint,salts:int>>")),
        F.lit(1),
        lambda salts, x: F.when(x["from_slot"] <= F.col(slot), x["salts"]).otherwise(salts),
    )
    return known.withColumn("_salts", valid).drop("_hot_key", "_spans")


def deal(df: DataFrame, key: str, slot: str, hot: DataFrame, by: list[str]) -> DataFrame:
    """Every row gets one of its key's salts, as a function of the columns ``by``: the same when a task is run again."""
    return salted(df, key, slot, hot).withColumn("_salt", F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int")).drop("_salts")


def replicate(df: DataFrame, key: str, slot: str, hot: DataFrame) -> DataFrame:
    """Every row comes once for each salt of its key."""
    every = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    return salted(df, key, slot, hot).withColumn("_salt", every).drop("_salts")
