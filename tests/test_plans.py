"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scratch import scratch_path
from tidemark.operators import filters, joins
from tidemark.registry import catalog
from tidemark.sources import layouts, writers

ENTRIES = catalog()
LAZY = sorted(n for n in ENTRIES if n.split("_")[0] in {"flt", "prj", "join", "sub", "agg", "win", "top", "sort", "limit", "union", "mart", "skew", "rpt", "dq", "json", "xml"})


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products_and_no_python_in_the_plan(name, tables):
    text = plan(ENTRIES[name].run(tables))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert unwanted not in text


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(filters.flt_date_between_daily(tables))
    assert "GreaterThanOrEqual(o_orderdate,2001-06-01T00:00)" in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_bucketed_join_and_aggregate_do_not_shuffle(spark, tables):
    facts = layouts.layout_hash(tables["orders"], "o_custkey", 4)
    dims = layouts.layout_hash(tables["customer"], "c_custkey", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.amounts_by_customer(facts).join(dims, F.col("o_custkey") == F.col("c_custkey"))
        assert "Exchange" not in plan(joined)
        plain = joins.amounts_by_customer(tables["orders"]).join(tables["customer"], F.col("o_custkey") == F.col("c_custkey"))
        assert plan(plain).count("Exchange") > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert facts.count() == tables["orders"].count() and [x for x in spark.catalog.listTables() if x.name.startswith("tidemark_")] == []
    named = layouts.layout_hash(tables["customer"], "c_custkey", 4, name="kept_buckets")
    try:
        assert spark.catalog.tableExists("kept_buckets") and named.count() == tables["customer"].count()
    finally:
        spark.sql("DROP TABLE kept_buckets")


def test_partition_pruning_by_month(spark, tables):
    path = scratch_path(spark, "months")
    part = writers.month_partition("o_orderdate", date(1995, 1, 1), date(2002, 1, 1))
    writers.write_partitioned(tables["orders"].withColumn("part", part), path, "part")
    lo, hi = date(2000, 6, 1), date(2000, 7, 1)
    wanted = writers.read_months(spark, path, "o_orderdate", lo, hi)
    text = plan(wanted)
    assert "PartitionFilters: [" in text and "2000-06" in text.split("PartitionFilters: [")[1].split("]")[0]
    same = tables["orders"].filter(F.col("o_orderdate").between("2000-06-01", "2000-06-30"))
    assert wanted.count() == same.count()


def test_latest_row_is_aggregated_before_the_shuffle(tables):
    text = plan(ENTRIES["win_latest_per_key"].run(tables))
    assert "Window" not in text and "partial_max_by" in text


def test_top_k_is_not_a_global_sort(tables):
    assert "TakeOrderedAndProject" in plan(ENTRIES["top_hot_keys"].run(tables))


@pytest.mark.parametrize(("name", "scans"), [("dq_report", 1), ("dq_web_log_checks", 1), ("join_self_using", 1), ("json_contains", 3), ("json_shred_relational", 3), ("mart_funnel", 1), ("xml_wellformed_split", 1), ("xml_header_detail_join", 1)])
def test_tables_are_read_once(name, scans, tables):
    assert plan(ENTRIES[name].run(tables)).count("Location: ") == scans


@pytest.mark.parametrize("name", ["skew_segments", "skew_flag_150", "skew_bands", "skew_coefficient", "skew_key_range", "agg_stddev_skew", "win_band_vs_avg"])
def test_placement_is_read_from_footers(name, tables):
    text = ENTRIES[name].run(tables)._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)") == text.count("PushedGroupBy: [segment_id]") == text.count("BatchScan") == 1
