"""Properties of keyed loads and of the tables that store them."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.scratch import scratch_path
from tidemark.operators import loads
from tidemark.plans import pipelines
from tidemark.sources import writers
from tidemark.sources.writers import KeyedTable, VersionedTable

PRODUCT = "product_id int, product_name string, price double"
TRACKED = ["product_name", "price"]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], PRODUCT)


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(2, "B", None), (4, "d", 4.0)], PRODUCT)


def test_upsert_twice_is_once(target, source):
    once = loads.load_upsert(target, source, ["product_id"])
    assert rows(once) == [(1, "a", 1.0), (2, "B", None), (3, "c", 3.0), (4, "d", 4.0)]
    assert rows(loads.load_upsert(once, source, ["product_id"])) == rows(once)


def test_upsert_needs_unique_keys_or_an_order(spark, target):
    twice = spark.createDataFrame([(2, "x", 5.0), (2, "y", 6.0)], PRODUCT)
    for load in (loads.load_upsert, lambda t, s, k: loads.load_upsert_partial(t, s, k, ["price"])):
        with pytest.raises(Exception, match="several source rows"):
            load(target, twice, ["product_id"]).collect()
    assert (2, "y", 6.0) in rows(loads.load_upsert(target, twice, ["product_id"], order_by=["price"]))


def test_partial_upsert_writes_nulls_and_leaves_other_columns(target, source):
    got = rows(loads.load_upsert_partial(target, source, ["product_id"], ["price"]))
    assert got == [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", 4.0)]


def test_insert_ignore(spark, target):
    more = spark.createDataFrame([(3, "z", 9.0), (5, "y", 2.0), (5, "x", 1.0)], PRODUCT)
    assert rows(loads.load_insert_ignore(target, more, ["product_id"]))[3:] == [(5, "x", 1.0)]


def _dim(spark, data):
    df = spark.createDataFrame(data, PRODUCT)
    return df.select(
        "*", F.lit("2024-01-01").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit(True).alias("is_current")
    )


def test_scd2(spark):
    dim = _dim(spark, [(1, "same", 1.0), (2, "changed", 2.0), (3, "gone", 3.0), (4, None, 4.0), (5, "to null", 5.0)])
    new = spark.createDataFrame([(1, "same", 1.0), (2, "changed", 2.5), (4, "from null", 4.0), (5, None, 5.0), (6, "new", 6.0)], PRODUCT)
    first = loads.load_scd2_bulk(dim, new, "product_id", TRACKED, date(2025, 1, 1))
    live = rows(first.filter("is_current"), "product_id", "product_name", "price")
    assert live == [(1, "same", 1.0), (2, "changed", 2.5), (4, "from null", 4.0), (5, None, 5.0), (6, "new", 6.0)]
    assert rows(first.filter("NOT is_current"), "product_id") == [(2,), (3,), (4,), (5,)]
    # a second run with the same source changes nothing, not even on another day
    again = loads.load_scd2_bulk(first, new, "product_id", TRACKED, date(2025, 2, 1))
    assert rows(again) == rows(first)
    # validity ranges of a key do not overlap
    overlap = first.alias("a").join(
        first.alias("b"),
        (F.col("a.product_id") == F.col("b.product_id")) & (F.col("a.valid_from") < F.col("b.valid_from")) & (F.col("b.valid_from") < F.col("a.valid_to")),
    )
    assert overlap.count() == 0
    kept = loads.load_scd2_one(dim, new.filter("product_id = 2"), "product_id", TRACKED, date(2025, 1, 1))
    assert kept.filter("is_current").count() == 5 and kept.count() == 6


def test_dedup(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d"), (None, 5, "e"), (None, 6, "f")], "k int, ts int, v string")
    assert rows(loads.dedup_keep_latest(df, ["k"], ["ts"])) == [(1, 2, "c"), (2, None, "d"), (None, 6, "f")]
    assert rows(loads.dedup_delete_older(df, ["k"], "ts")) == [(1, 2, "b"), (1, 2, "c"), (2, None, "d"), (None, 6, "f")]


def test_cdc(target, source):
    assert rows(loads.cdc_capture(target, source, ["product_id"]), "product_id", "change_type") == [
        (1, "delete"), (2, "update"), (3, "delete"), (4, "insert"),
    ]
    assert loads.cdc_capture(target, target, ["product_id"]).count() == 0


def test_refresh_twice_is_once(spark):
    day = date(2025, 1, 1)
    data = [(day, 1, 1, 10, 7, 2, 5.0), (day, 1, 1, 11, 7, 1, 3.0), (date(2025, 1, 2), 1, 1, 12, 8, 1, 1.0)]
    fact = spark.createDataFrame(data, "sale_date date, product_key int, store_key int, transaction_id int, customer_id int, quantity bigint, total_amount double")
    stored = loads.daily_sales(fact.filter("transaction_id <> 11"))
    once = loads.agg_refresh_daily(stored, fact, day)
    assert rows(once) == rows(loads.daily_sales(fact)) == rows(loads.agg_refresh_daily(once, fact, day))


def test_retention(spark):
    months = spark.createDataFrame([("2022-12",), ("2023-01",), ("outliers",), (None,)], "m string")
    assert rows(loads.part_drop_old(months, "m", 24, date(2025, 1, 15))) == [("2023-01",), ("outliers",), (None,)]


def test_versioned_table(spark):
    table = VersionedTable(spark, scratch_path(spark, "versions"))
    assert table.current() is None
    table.publish(spark.range(3), "first")
    table.append(spark.range(3, 5), "more")
    table.append(spark.range(100), "more")  # the name is taken: a retry adds nothing
    assert rows(table.current()) == [(i,) for i in range(5)]
    table.publish(table.current().filter("id > 3"))  # reads the state it replaces
    assert rows(table.current()) == [(4,)] and len(table.versions()) == 3


def test_keyed_table_replaces_whole_keys(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"])
    table.publish(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"))
    table.append(spark.createDataFrame([(1, "A"), (3, "d")], "k int, v string"))
    want = [(1, "A"), (2, "c"), (3, "d")]
    assert rows(table.current()) == want
    table.compact()
    assert rows(table.current()) == want and len(table.paths()) == 1


def test_rewrite_partitions_touches_only_what_it_must(spark):
    path = scratch_path(spark, "parts")
    base = spark.range(90).select("id", F.lit(0).alias("v"), F.concat(F.lit("2024-0"), F.col("id") % 3 + 1).alias("month"))
    writers.write_partitioned(base, path, "month")
    before = {f for f in spark.read.parquet(path).inputFiles() if "2024-01" not in f}
    change = spark.createDataFrame([(3, 7, "2024-01"), (900, 8, "2024-01")], "id bigint, v int, month string")
    touched = writers.rewrite_partitions(spark, path, "month", change, lambda old, new: loads.load_upsert(old, new, ["id"]))
    assert touched == ["2024-01"]
    after = spark.read.parquet(path)
    assert {f for f in after.inputFiles() if "2024-01" not in f} == before
    assert rows(after.filter("v > 0"), "id", "v") == [(3, 7), (900, 8)] and after.count() == 91


def test_pipeline_logs_and_clears_staging_last(spark):
    root = scratch_path(spark, "pipeline")
    staging, production = VersionedTable(spark, f"{root}/s"), VersionedTable(spark, f"{root}/p")
    staging.publish(spark.createDataFrame([(1, -5.0), (2, 3.0), (None, 1.0)], "id int, amount double"))
    production.publish(spark.createDataFrame([(2, 99.0)], "id int, amount double"))
    bad, fixes = F.col("id").isNull(), {"amount": F.greatest("amount", F.lit(0.0))}
    with pytest.raises(Exception, match="bad rows"):
        pipelines.pipe_staging_to_prod(staging, production, ["id"], f"{root}/log", bad, fixes, max_bad=0)
    assert rows(production.current()) == [(2, 99.0)] and staging.current().count() == 3
    done = pipelines.pipe_staging_to_prod(staging, production, ["id"], f"{root}/log", bad, fixes, max_bad=1)
    assert rows(done) == [(1, 0.0), (2, 99.0)] and staging.current().count() == 0
    log = spark.read.schema(pipelines.LOG_SCHEMA).parquet(f"{root}/log")
    assert rows(log, "step_name", "status", "rows_affected", "rows_rejected") == [
        ("clear staging", "SUCCESS", 0, 0), ("promote", "SUCCESS", 1, 1), ("quality gate", "FAILED", None, None), ("quality gate", "SUCCESS", None, 0),
    ]


def test_refreshed_day_is_the_only_partition_rewritten(spark):
    days = [date(2025, 1, 1), date(2025, 1, 2)]
    schema = "sale_date date, product_key int, store_key int, transaction_id int, customer_id int, quantity bigint, total_amount double"
    fact = spark.createDataFrame([(d, 1, s, 10 * s, 7, 2, 5.0) for d in days for s in (1, 2, 3)], schema)
    path = scratch_path(spark, "daily")
    writers.write_partitioned(loads.daily_sales(fact.filter("store_key < 3")), path, "sale_date")
    read = lambda: spark.read.parquet(path)
    other = {f for f in read().inputFiles() if "sale_date=2025-01-01" in f}
    for _ in range(2):
        day = loads.daily_sales(fact.filter(F.col("sale_date") == F.lit(days[1])))
        writers.write_partitioned(day, path, "sale_date", mode="overwrite")
        assert rows(read().groupBy("sale_date").count()) == [(days[0], 2), (days[1], 3)]
        assert {f for f in read().inputFiles() if "sale_date=2025-01-01" in f} == other


def test_late_facts_reach_only_their_days(spark):
    schema = "sale_date date, product_key int, store_key int, transaction_id int, customer_id int, quantity bigint, total_amount double"
    fact = spark.createDataFrame([(date(2025, 1, d), 1, 1, d, 7, 1, 1.0) for d in (1, 2)], schema)
    late = spark.createDataFrame([(date(2025, 1, 2), 1, 1, 9, 8, 4, 2.0), (date(2024, 12, 31), 1, 1, 8, 8, 1, 1.0)], schema)
    wrong_but_untouched = loads.daily_sales(fact).withColumn("total_quantity", F.lit(50).cast("bigint"))
    every, agg = loads.load_late_facts(wrong_but_untouched, fact, late)
    assert every.count() == 4
    assert rows(agg, "sale_date", "total_quantity") == [(date(2024, 12, 31), 1), (date(2025, 1, 1), 50), (date(2025, 1, 2), 5)]


def test_a_repeated_scd2_key_fails(spark):
    dim = _dim(spark, [(1, "a", 1.0)])
    twice = spark.createDataFrame([(1, "b", 1.0), (1, "c", 1.0)], PRODUCT)
    with pytest.raises(Exception, match="several source rows"):
        loads.load_scd2_bulk(dim, twice, "product_id", TRACKED, date(2025, 1, 1)).collect()


def test_a_repeated_natural_key_gets_one_surrogate(spark):
    dim = spark.createDataFrame([(1, "a", 10)], "id int, name string, sk int")
    new = spark.createDataFrame([(2, "y"), (2, "x"), (3, "z"), (1, "q")], "id int, name string")
    assert rows(loads.dim_surrogate_key(dim, new, "id", "sk")) == [(1, "a", 10), (2, "x", 11), (3, "z", 12)]


def test_null_partitions_are_merged(spark):
    path = scratch_path(spark, "nulls")
    schema = "id int, v string, part string"
    writers.write_partitioned(spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", None)], schema), path, "part")
    source = spark.createDataFrame([(2, "B", None)], schema)
    writers.rewrite_partitions(spark, path, "part", source, lambda stored, fresh: loads.load_upsert(stored, fresh, ["id"]))
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "a", "x"), (2, "B", None), (3, "c", None)]


def test_null_keys_stay_after_an_append(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed-null"), ["id"])
    table.publish(spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string"))
    table.append(spark.createDataFrame([(1, "B")], "id int, v string"))
    assert rows(table.current()) == rows(spark.createDataFrame([(None, "a"), (1, "B")], "id int, v string"))
    table.append(spark.createDataFrame([(None, "A")], "id int, v string"))
    assert rows(table.current(), "v") == [("A",), ("B",)]


def test_untouched_partitions_keep_their_files(spark):
    path = scratch_path(spark, "touch")
    schema = "id int, part string"
    writers.write_partitioned(spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], schema), path, "part")
    files = lambda: {f.rsplit("/", 2)[1]: f for f in spark.read.parquet(path).inputFiles()}
    before = files()
    writers.rewrite_partitions(spark, path, "part", spark.createDataFrame([(4, "y")], schema), lambda stored, fresh: stored.unionByName(fresh))
    after = files()
    assert {p for p in before if before[p] != after[p]} == {"part=y"}
    assert writers.drop_partitions(path, "part", lambda v: v < "y") == ["x"]
    assert rows(spark.read.schema(schema).parquet(path)) == [(2, "y"), (3, "z"), (4, "y")]


def test_reports_read_the_log_a_pipeline_wrote(spark):
    from datetime import timedelta

    from tidemark.operators import reports

    root = scratch_path(spark, "logged")
    staging, production = VersionedTable(spark, f"{root}/s"), VersionedTable(spark, f"{root}/p")
    staging.publish(spark.createDataFrame([(1, 5.0), (2, None)], "id int, price double"))
    pipelines.pipe_staging_to_prod(staging, production, ["id"], f"{root}/log", drop_if=F.col("price").isNull())
    t = {"run_log": spark.read.parquet(f"{root}/log")}
    tomorrow = date.today() + timedelta(days=1)
    history = {r.step_name: r for r in reports.rpt_etl_history(t, as_of=tomorrow).collect()}
    assert set(history) == {"promote", "clear staging"} and all(r.status == "SUCCESS" for r in history.values())
    (board,) = reports.rpt_load_dashboard(t, as_of=tomorrow).collect()
    assert (board.total_loads, board.failed_loads, board.total_rows_loaded, board.total_rows_rejected) == (2, 0, 1, 1)
    assert reports.rpt_load_anomalies(t, expected=("staging to production", "other"), as_of=tomorrow, hours=48).filter("alert_type = 'MISSING_LOAD'").count() == 1


def test_a_step_that_is_not_required_lets_the_run_go_on(spark):
    log = pipelines.RunLog(spark, "p")
    long = "x" * 5000

    def fails():
        raise ValueError(long)

    assert log.step("optional", fails, required=False) is False and log.step("next", lambda: 3) is True
    assert [(r.step_name, r.status, r.rows_affected) for r in log.frame().collect()] == [("optional", "FAILED", None), ("next", "SUCCESS", 3)]
    assert long in log.frame().first().error_message
