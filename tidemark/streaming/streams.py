"""Structured Streaming versions of ingest, windows, deduplication, joins and keyed loads."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import loads
from tidemark.sources.writers import KeyedTable
from tidemark.streaming.hotkeys import deal, replicate, slot_of


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None, **options) -> DataFrame:
    """Files that appear under ``path``; a checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a zoned timestamp (watermarks refuse wall-clock ones), with its watermark."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def drain(stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process what is there, append it to files, stop."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("path", target)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_batches(stream: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    """Process what is there, one ``handle(batch, batch_id)`` per micro-batch, stop."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def st_file_ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Copy new files' rows exactly once; a second run without new files adds nothing."""
    return drain(stream, target, checkpoint)


def st_window_metrics(
    stream: DataFrame, ts: str, keys: list[str], measures: dict[str, Column], window: str, slide: str | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Tumbling or sliding window aggregates, emitted when the watermark closes a window."""
    frame = F.window(ts, window, slide) if slide else F.window(ts, window)
    rows = timed(stream, ts, delay).groupBy(frame, *keys).agg(*[m.alias(n) for n, m in measures.items()])
    wall = lambda edge: F.col(f"window.{edge}").cast("timestamp_ntz").alias(f"window_{edge}")
    return rows.select(wall("start"), wall("end"), *keys, *measures)


def st_late_data(stream: DataFrame, ts: str, delay: timedelta, target: str, checkpoint: str) -> StreamingQuery:
    """Divert rows older than ``delay`` before the newest time of all earlier batches.

    A batch is computed once: one write deals its rows to ``target``'s directories by batch and ``late``,
    and the newest time is observed in that write.  It is left beside the batch together with that of
    all batches before, so the next one reads a single row.  A repeated batch overwrites its own.
    """
    newest = lambda batch_id: f"{target}/_newest/batch={batch_id}"
    kind = stream.schema[ts].dataType.simpleString()

    def split(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = session.read.schema("newest string").parquet(newest(batch_id - 1)).first()[0] if batch_id else None
        edge = F.lit(before).cast(kind) - F.lit(delay)
        seen = Observation()
        dealt = batch.withColumn("late", F.coalesce(F.col(ts) < edge, F.lit(False)))
        dealt = dealt.observe(seen, F.max(F.col(ts)).cast("string").alias("newest"))
        dealt.write.mode("overwrite").partitionBy("late").parquet(f"{target}/batch={batch_id}")
        known = [x for x in (before, seen.get["newest"]) if x is not None]  # times as text sort like times
        last = session.createDataFrame([(max(known, default=None),)], "newest string")
        last.coalesce(1).write.mode("overwrite").parquet(newest(batch_id))

    return drain_batches(stream, split, checkpoint)


def late_rows(spark: SparkSession, target: str, schema: str, late: bool) -> DataFrame:
    """What ``st_late_data`` stored: the rows that came late, or those that came on time."""
    stored = spark.read.schema(f"{schema}, late boolean, batch bigint").parquet(target)
    return stored.filter(F.col("late") if late else ~F.col("late")).drop("late", "batch")


def st_dedup(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """The first row of every key among copies that arrive within ``delay`` of each other."""
    return timed(stream, ts, delay).dropDuplicatesWithinWatermark([key])


def st_interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int, delay: str, hot: DataFrame | None = None
) -> DataFrame:
    """Rows of two streams with an equal key and at most ``seconds`` between them.

    The time bound lets Spark drop state that can no longer match.  As in the batch
    form, the state is keyed by (key, time slot), so a busy key spreads over tasks.  With ``hot``, what
    ``hotkeys.mark_hot`` has stored, a busy slot of a hot key does too: its left rows are
    dealt to salts, its right rows are replicated to each.
    """
    span = f"interval {seconds} seconds"
    l, r = interval_sides(timed(left, left_ts, delay), timed(right, right_ts, delay), key, left_ts, right_ts, seconds, hot)
    r = r.withColumnsRenamed({key: f"_{key}", "_slot": "_slot_r", "_salt": "_salt_r"})
    near = (
        (F.col(key) == F.col(f"_{key}"))
        & (F.col("_slot") == F.col("_slot_r"))
        & (F.col(right_ts) >= F.col(left_ts) - F.expr(span))
        & (F.col(right_ts) <= F.col(left_ts) + F.expr(span))
    )
    if hot is not None:
        near = near & (F.col("_salt") == F.col("_salt_r"))
    return l.join(r, near).drop("_slot", "_slot_r", "_salt", "_salt_r", f"_{key}")


def interval_sides(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int, hot: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the slot, and the salt if keys may be ``hot``, at which their rows meet."""
    slot = slot_of(right_ts, seconds)
    l = left.withColumn("_slot", slot_of(left_ts, seconds))
    r = right.withColumn("_slot", F.explode(F.sequence(slot - 1, slot + 1)))
    if hot is None:
        return l, r
    return deal(l, key, "_slot", hot, left.columns), replicate(r, key, "_slot", hot)


def st_upsert(
    stream: DataFrame, table: KeyedTable, order_by: list[str], checkpoint: str, compact_every: int = 100
) -> StreamingQuery:
    """Upsert every micro-batch into a keyed table.

    A batch writes one row per key it holds and nothing else.  Its directory is named
    after the batch, so a batch repeated after a failure finds it and does nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.append(loads.dedup_keep_latest(batch, table.keys, order_by), f"batch-{batch_id:08d}")
        if (batch_id + 1) % compact_every == 0:
            table.compact(f"compact-{batch_id:08d}")

    return drain_batches(stream, merge, checkpoint)


def st_cdc_scd2(
    stream: DataFrame, table: KeyedTable, tracked: list[str], order_by: list[str], as_of, checkpoint: str, compact_every: int = 100
) -> StreamingQuery:
    """Apply a change feed to a versioned dimension; the last change of a key in a batch counts.

    Only the versions of keys in the batch are read against it and written again.
    ``as_of(batch_id)`` gives the validity start of the versions a batch creates.
    """
    (key,) = table.keys

    def apply(batch: DataFrame, batch_id: int) -> None:
        latest = loads.dedup_keep_latest(batch.select(key, *tracked, *order_by), [key], order_by)
        affected = table.current().join(latest.select(key), key, "left_semi")
        state = loads.load_scd2_bulk(affected, latest, key, tracked, as_of(batch_id), close_missing=False)
        table.append(state, f"batch-{batch_id:08d}")
        if (batch_id + 1) % compact_every == 0:
            table.compact(f"compact-{batch_id:08d}")

    return drain_batches(stream, apply, checkpoint)
