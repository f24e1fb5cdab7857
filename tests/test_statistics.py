"""Statistics after a load: they follow the table and change the order of joins."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.scratch import scratch_path
from tidemark.plans import pipelines
from tidemark.sources import statistics
from tidemark.sources.writers import VersionedTable


@pytest.fixture
def names(spark):
    """Catalog names that are gone after the test."""
    used = ["stat_facts", "stat_stores", "stat_days"]
    yield used
    for name in used:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def order_of_tables(df, names) -> list[str]:
    """The tables in the order in which the optimized plan joins them."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    columns = {"amount": names[0], "store_name": names[1], "label": names[2]}
    leaves = [line for line in text.splitlines() if "Relation" in line]
    return [next(t for c, t in columns.items() if re.search(rf"\b{c}#", line)) for line in leaves]


def test_join_order_changes_after_statistics(spark, names):
    """Ten stores per group multiply the facts; one day in a hundred reduces them.  Written in the worse order."""
    root = scratch_path(spark, "order")
    frames = [
        spark.range(20_000).selectExpr("id % 100 AS day_id", "id % 50 AS grp", "double(id) AS amount"),
        spark.range(500).selectExpr("id % 50 AS store_grp", "concat('s', id) AS store_name"),
        spark.range(100).selectExpr("id AS day_key", "concat('d', id) AS label"),
    ]
    tables = [VersionedTable(spark, f"{root}/{n}") for n in names]
    for table, frame, name in zip(tables, frames, names):
        table.append(frame)
        statistics.catalog_table(table, name)

    def question():
        session = statistics.cost_based(spark)
        facts, stores, days = (session.table(n).drop("_version") for n in names)
        joined = facts.join(stores, F.col("grp") == F.col("store_grp")).join(days, F.col("day_id") == F.col("day_key"))
        return joined.filter("day_key = 7").groupBy("store_name").agg(F.sum("amount").alias("amount"), F.max("label").alias("label"))

    before = question()
    assert order_of_tables(before, names) == names
    known = rows(before)
    for table, name, columns in zip(tables, names, (["day_id", "grp"], ["store_grp"], ["day_key"])):
        statistics.analyze(table, name, columns)
    after = question()
    order = order_of_tables(after, names)
    assert order[2] == names[1] and rows(after) == known


def test_the_name_follows_the_table(spark, names):
    table = VersionedTable(spark, scratch_path(spark, "followed"))
    with pytest.raises(ValueError):
        statistics.analyze(table, names[0], ["k"])
    low_high = lambda: rows(statistics.column_statistics(spark, names[0], ["k", "v"]), "column_name", "low", "high", "null_count")
    table.append(spark.createDataFrame([(1, "a"), (2, None)], "k int, v string"))
    assert statistics.analyze(table, names[0], ["k", "v"]) == 2
    assert low_high() == [("k", "1", "2", 0), ("v", None, None, 1)]
    table.append(spark.createDataFrame([(9, None)], "k int, v string"))
    assert statistics.analyze(table, names[0], ["k", "v"]) == 3
    assert low_high() == [("k", "1", "9", 0), ("v", None, None, 2)]
    table.publish(spark.createDataFrame([(5, "z")], "k int, v string"))  # replaces both
    assert statistics.analyze(table, names[0], ["k", "v"]) == 1 and low_high()[0] == ("k", "5", "5", 0)
    table.publish(spark.createDataFrame([(5, "z", True)], "k int, v string, more boolean"))
    assert statistics.analyze(table, names[0], ["more"]) == 1
    assert rows(statistics.catalog_table(table, names[0])) == [(5, "z", True)]
    table.publish(spark.createDataFrame([], "k int, v string, more boolean"))
    assert statistics.analyze(table, names[0], []) == 0


def test_statistics_are_a_step_that_holds_nothing_up(spark, names):
    root = scratch_path(spark, "step")
    staging, production = VersionedTable(spark, f"{root}/s"), VersionedTable(spark, f"{root}/p")
    for name, column, status in ((names[0], "id", "SUCCESS"), (names[1], "no_such_column", "FAILED")):
        staging.publish(spark.createDataFrame([(1, 5.0), (2, None)], "id int, price double"))
        log = f"{root}/log-{status}"
        pipelines.pipe_staging_to_prod(staging, production, ["id"], log, F.lit(False), statistics=(name, [column]))
        steps = {r.step_name: r.status for r in spark.read.schema(pipelines.LOG_SCHEMA).parquet(log).collect()}
        assert steps == {"promote": "SUCCESS", "statistics": status, "clear staging": "SUCCESS"}
    assert rows(production.current(), "id") == [(1,), (2,)]
