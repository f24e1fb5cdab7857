"""Streams: exactly once, late rows, repeated batches."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.scratch import scratch_path
from tidemark.sources.writers import KeyedTable, VersionedTable
from tidemark.streaming import streams, toplist
from tidemark.streaming.hotkeys import mark_hot

SCHEMA = "k int, ts timestamp_ntz, v string"


def _add(spark, root, *data):
    spark.createDataFrame([(k, datetime(2025, 1, d), v) for k, d, v in data], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return streams.file_stream(spark, f"{root}/in", SCHEMA)


def test_only_new_files_are_read(spark):
    root = scratch_path(spark, "st-ingest")
    for wave in ([(1, 1, "a"), (2, 2, "b")], [(3, 3, "c")]):
        streams.st_file_ingest(_add(spark, root, *wave), f"{root}/out", f"{root}/cp")
    streams.st_file_ingest(streams.file_stream(spark, f"{root}/in", SCHEMA), f"{root}/out", f"{root}/cp")
    assert rows(spark.read.schema(SCHEMA).parquet(f"{root}/out"), "k") == [(1,), (2,), (3,)]


def test_late_rows_are_diverted(spark):
    root = scratch_path(spark, "st-late")
    for wave in ([(1, 1, "a"), (2, 10, "b")], [(3, 2, "late"), (4, 9, "edge"), (5, 11, "c")], [(6, 10, "ok")], [(7, 9, "late"), (8, None, "no time")]):
        data = [(k, d and datetime(2025, 1, d), v) for k, d, v in wave]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        streams.st_late_data(streams.file_stream(spark, f"{root}/in", SCHEMA), "ts", timedelta(days=1), f"{root}/out", f"{root}/cp")
    read = lambda late: rows(streams.late_rows(spark, f"{root}/out", SCHEMA, late), "k")
    assert (read(True), read(False)) == ([(3,), (7,)], [(1,), (2,), (4,), (5,), (6,), (8,)])


def test_a_late_batch_is_computed_once(spark):
    """Every batch costs one job over its rows and one row of state, however many came before."""
    root = scratch_path(spark, "st-late-once")
    jobs = []
    for k in range(4):
        tracker = spark.sparkContext.statusTracker()
        before = set(tracker.getJobIdsForGroup(None))
        streams.st_late_data(_add(spark, root, (k, k + 1, "x")), "ts", timedelta(days=1), f"{root}/out", f"{root}/cp")
        jobs.append(len(set(tracker.getJobIdsForGroup(None)) - before))
    assert len(set(jobs[1:])) == 1


def test_upsert_and_repeated_batch(spark):
    root = scratch_path(spark, "st-upsert")
    table = KeyedTable(spark, f"{root}/t", ["k"])
    for wave in ([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], [(2, 5, "C"), (3, 5, "d")]):
        streams.st_upsert(_add(spark, root, *wave), table, ["ts"], f"{root}/cp", compact_every=2)
    want = [(1, "b"), (2, "C"), (3, "d")]
    assert rows(table.current(), "k", "v") == want
    # the checkpoint is lost and every batch comes again: the first finds its name taken
    names = table.versions()
    table.append(spark.createDataFrame([(9, datetime(2025, 1, 1), "x")], SCHEMA), "batch-00000000")
    assert table.versions() == names and rows(table.current(), "k", "v") == want


def test_change_feed_to_versions(spark):
    root = scratch_path(spark, "st-cdc")
    table = KeyedTable(spark, f"{root}/dim", ["k"])
    opened = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").select(
        "*", F.lit("2024-01-01").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit(True).alias("is_current")
    )
    table.publish(opened)
    for wave in ([(1, 1, "x"), (1, 2, "A")], [(1, 3, "A"), (2, 3, "B"), (3, 3, "c")]):
        streams.st_cdc_scd2(
            _add(spark, root, *wave), table, ["v"], ["ts"], lambda batch: date(2025, 1, 1) + timedelta(days=batch), f"{root}/cp"
        )
    got = rows(table.current(), "k", "v", "is_current")
    assert got == [(1, "A", True), (1, "a", False), (2, "B", True), (2, "b", False), (3, "c", True)]


def test_windows_close_with_the_watermark(spark):
    root = scratch_path(spark, "st-window")
    stream = _add(spark, root, (1, 1, "a"), (1, 1, "b"), (1, 9, "c"))
    metrics = streams.st_window_metrics(stream, "ts", ["k"], {"n": F.count("*")}, "1 day")
    streams.drain(metrics, f"{root}/out", f"{root}/cp")
    assert rows(spark.read.parquet(f"{root}/out"), "n") == [(2,)]


SIDES = "k int, n int, ts timestamp_ntz"


def _interval_waves(spark, root, waves, salts, seconds=3600):
    """Two streams joined over several arrivals, with hot keys marked after each; returns the pairs."""
    hot = VersionedTable(spark, f"{root}/hot")
    hot.publish(spark.createDataFrame([], "k int, salts int, from_slot bigint"))
    for wave in waves:
        for name, data in zip(("l", "r"), wave):
            spark.createDataFrame(data, SIDES).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        l = streams.file_stream(spark, f"{root}/l", SIDES).withColumnsRenamed({"ts": "lts", "n": "ln"})
        r = streams.file_stream(spark, f"{root}/r", SIDES).withColumnsRenamed({"ts": "rts", "n": "rn"})
        joined = streams.st_interval_join(l, r, "k", "lts", "rts", seconds, "1 hour", hot.current())
        streams.drain(joined.select("k", "ln", "rn"), f"{root}/out", f"{root}/cp")
        seen = spark.read.schema(SIDES).parquet(f"{root}/l", f"{root}/r")
        mark_hot(hot, seen, "k", "ts", seconds, 3600, share=0.1, max_salts=salts)
    return spark.read.schema("k int, ln int, rn int").parquet(f"{root}/out"), hot


def _busy(start: datetime, n: int, salt: int):
    """Half of the rows belong to key 0, and all of its rows to one hour or the next."""
    at = lambda i: start + timedelta(minutes=(i * 7) % 100)
    return [(0 if i % 2 else 1 + i % 9, i + salt, at(i)) for i in range(n)] + [(None, -1, start), (3, -2, None)]


def test_hot_keys_of_a_join_meet_in_several_tasks(spark):
    day = datetime(2025, 1, 1)
    waves = [(_busy(day + timedelta(hours=h), 120, 1000 * h), _busy(day + timedelta(hours=h), 60, 5000 + 1000 * h)) for h in (0, 2, 4)]
    got, hot = _interval_waves(spark, scratch_path(spark, "st-hot"), waves, salts=8)
    lefts, rights = ([row for wave in waves for row in wave[side]] for side in (0, 1))
    near = lambda a, b: a[0] is not None and a[0] == b[0] and a[2] and b[2] and abs((a[2] - b[2]).total_seconds()) <= 3600
    assert rows(got) == sorted(((a[0], a[1], b[1]) for a in lefts for b in rights if near(a, b)), key=repr)
    table = rows(hot.current(), "k", "salts")
    assert {k for k, _ in table} == {0} and max(s for _, s in table) > 2

    # once marked, no group of rows that meets in a task is as large as the key's slot
    later = day + timedelta(days=2)
    l = spark.createDataFrame(_busy(later, 400, 0), SIDES).withColumnsRenamed({"ts": "lts", "n": "ln"})
    r = spark.createDataFrame(_busy(later, 40, 0), SIDES).withColumnsRenamed({"ts": "rts", "n": "rn"})
    largest = lambda df, by: df.groupBy(*by).count().agg(F.max("count")).first()[0]
    plain, _ = streams.interval_sides(l, r, "k", "lts", "rts", 3600)
    dealt, copied = streams.interval_sides(l, r, "k", "lts", "rts", 3600, hot.current())
    assert largest(dealt, ["k", "_slot", "_salt"]) < largest(plain, ["k", "_slot"]) / 2
    assert dealt.count() == l.count() and copied.filter("k <> 0").count() == 3 * r.filter("k <> 0 AND rts IS NOT NULL").count()


def test_a_key_becomes_ordinary_again(spark):
    day = datetime(2025, 1, 1)
    quiet = [(i % 20, i, day + timedelta(days=3, minutes=i)) for i in range(400)]
    root = scratch_path(spark, "st-cool")
    waves = [(_busy(day, 40, 0), _busy(day, 40, 0)), (quiet, quiet)]
    _, hot = _interval_waves(spark, root, waves, salts=4)
    # the entry that ended lasts from the slot after the newest one; slots before keep their salts
    assert rows(hot.current(), "salts")[0] == (1,) and {k for (k,) in rows(hot.current(), "k")} == {0}
    much_later = spark.createDataFrame([(i % 20, i, day + timedelta(days=9, minutes=i)) for i in range(40)], SIDES)
    for _ in range(2):
        mark_hot(hot, much_later, "k", "ts", 3600, 3600, share=0.1)
    assert hot.current().count() == 0
    mark_hot(hot, much_later.limit(0), "k", "ts", 3600, 3600)
    assert hot.current().count() == 0


def test_top_lists_survive_a_restart(spark):
    """A day split over three runs; ties go to the smaller item, late rows and rows without item or amount are left out."""
    root, session = scratch_path(spark, "st-top"), toplist.state_session(spark)
    schema = "item int, ts timestamp_ntz, amount double"
    at = lambda d, h: datetime(2025, 1, d, h)
    waves = [
        [(1, at(1, 1), 5.0), (2, at(1, 2), 7.0), (3, at(1, 3), 7.0), (None, at(1, 4), 99.0), (4, at(1, 4), None), (4, None, 9.0)],
        [(1, at(1, 20), 4.0), (5, at(1, 21), 1.0), (6, at(1, 22), 2.5)],
        [(9, at(2, 12), 3.0), (8, at(2, 13), 3.0)],
        [(7, at(1, 5), 1000.0), (8, at(4, 0), 1.0)],
    ]
    for wave in waves:
        spark.createDataFrame(wave, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = streams.file_stream(session, f"{root}/in", schema)
        lists = toplist.st_top_lists(stream, "ts", "item", F.col("amount"), 3, delay="1 hour", buckets=2)
        streams.drain(lists, f"{root}/out", f"{root}/cp")
    stored = spark.read.schema("window_end bigint, bucket int, item int, amount double").parquet(f"{root}/out")
    got = rows(toplist.top_of_window(stored, 3))
    assert got == [
        (at(2, 0), 1, 1, 9.0), (at(2, 0), 2, 2, 7.0), (at(2, 0), 3, 3, 7.0), (at(3, 0), 1, 8, 3.0), (at(3, 0), 2, 9, 3.0),
    ]
