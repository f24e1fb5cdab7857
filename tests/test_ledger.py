"""Tables that change together: crashes, concurrent writers, untouched files, views and footers."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.scratch import scratch_path
from tidemark.operators import loads
from tidemark.plans import pipelines
from tidemark.sources import writers
from tidemark.sources.footers import footer_counts
from tidemark.sources.ledger import Conflict, Ledger
from tidemark.sources.views import Question, SummaryView

CONTROL = "table_name string, last_load_timestamp timestamp_ntz, rows_loaded bigint, status string"
FACT = "sale_date date, product_key int, store_key int, transaction_id bigint, customer_id int, quantity bigint, total_amount decimal(12,2), transaction_ts timestamp_ntz"
PRODUCTS = "product_id int, product_name string, category string, price double, valid_from date, valid_to date, is_current boolean"


def ledger(spark, name="ledger"):
    return Ledger(spark, scratch_path(spark, name))


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def test_tables_change_together_and_readers_see_one_state(spark):
    store = ledger(spark)
    assert store.latest().number == -1 and store.rows("a") is None
    change = store.begin()
    assert change.replace("a", ids(spark, 1, 2), key="id") == 2
    change.replace("b", ids(spark))
    assert store.rows("a") is None and rows(change.rows("a")) == [(1,), (2,)]
    first = change.commit("first")
    change = store.begin()
    change.append("a", ids(spark, 3))
    change.replace("b", ids(spark, 9))
    change.commit("second")
    assert rows(store.rows("a")) == [(1,), (2,), (3,)] and rows(store.rows("b")) == [(9,)]
    assert rows(store.rows("a", entry=first)) == [(1,), (2,)] and store.rows("b", entry=first).count() == 0
    assert [e.name for e in store.history()] == ["first", "second"]
    assert [(d.rows, d.low, d.high) for d in first.tables["a"]] == [(2, 1, 2)]


def test_of_two_writers_one_fails(spark):
    store = ledger(spark)
    a, b = store.begin(), store.begin()
    a.replace("t", ids(spark, 1))
    b.replace("t", ids(spark, 2))
    b.commit()
    with pytest.raises(Conflict):
        a.commit()
    assert rows(store.rows("t")) == [(2,)] and len(store.history()) == 1


def test_parts_keep_their_files(spark):
    store = ledger(spark)
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z/ä"), (4, None)], "id bigint, p string")
    change = store.begin()
    change.replace("t", df, part="p", key="id")
    before = {d.part: d for d in change.commit().tables["t"]}
    assert {p: (d.rows, d.low, d.high) for p, d in before.items()} == {"x": (1, 1, 1), "y": (1, 2, 2), "z/ä": (1, 3, 3), None: (1, 4, 4)}
    change = store.begin()
    change.replace_parts("t", spark.createDataFrame([(7, "y"), (8, "new")], "id bigint, p string"), "p", ["y", "new", "x"])
    change.drop_parts("t", lambda p: p is None)
    after = {d.part: d.path for d in change.commit().tables["t"]}
    assert set(after) == {"y", "new", "z/ä"} and after["z/ä"] == before["z/ä"].path and after["y"] != before["y"].path
    assert rows(store.rows("t")) == [(3, "z/ä"), (7, "y"), (8, "new")]
    store.sweep()  # one old directory still holds a live part
    assert rows(store.rows("t")) == [(3, "z/ä"), (7, "y"), (8, "new")]


def facts(spark, *items):
    """(id, day of January 2025, version) as fact rows."""
    return spark.createDataFrame(
        [(date(2025, 1, d), 1, 1, i, 7, v, i + v / 100, datetime(2025, 1, d, v)) for i, d, v in items],
        FACT.replace("decimal(12,2)", "double"),
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)"))


def warehouse(spark, source):
    store = ledger(spark, "warehouse")
    start = store.begin()
    product = spark.createDataFrame([(1, "a", "c", 1.0)], "product_id int, product_name string, category string, price double")
    start.replace("products_staging", product)
    start.replace("products", spark.createDataFrame([], PRODUCTS))
    start.replace("control", spark.createDataFrame([], CONTROL))
    start.commit("setup")
    return pipelines.Warehouse(store, source, scratch_path(spark, "log"))


def test_daily_run_is_one_commit_and_touches_one_day(spark):
    w = warehouse(spark, facts(spark, (1, 1, 0), (2, 1, 0), (3, 2, 0)))
    pipelines.pipe_daily_etl(spark, w, datetime(2025, 1, 20), date(2025, 1, 2))
    assert [e.number for e in w.ledger.history()] == [0, 1]
    first = {d.part: d.path for d in w.ledger.latest().tables["facts"]}
    w.transactions = facts(spark, (1, 1, 0), (2, 1, 0), (3, 2, 0), (4, 3, 0), (5, 3, 0))
    daily = pipelines.pipe_daily_etl(spark, w, datetime(2025, 1, 20), date(2025, 1, 3))
    second = {d.part: d.path for d in w.ledger.latest().tables["facts"]}
    assert {p: second[p] for p in first} == first and set(second) - set(first) == {"2025-01-03"}
    assert rows(daily, "sale_date", "transaction_count") == [(date(2025, 1, 2), 1), (date(2025, 1, 3), 2)]
    assert rows(w.ledger.rows("control"), "table_name", "last_load_timestamp", "rows_loaded") == [("fact_transactions", datetime(2025, 1, 3), 2)]
    assert w.ledger.rows("products").filter("is_current").count() == 1 and w.ledger.rows("products_staging").count() == 0
    assert rows(w.ledger.rows("facts"), "transaction_id") == [(i,) for i in range(1, 6)]
    pipelines.pipe_daily_etl(spark, w, datetime(2025, 1, 20), date(2027, 2, 1), retention_months=24)
    assert {d.part for d in w.ledger.latest().tables["facts"]} == set()


@pytest.mark.parametrize("step", ["append", "replace", "replace_parts", "drop_parts", "commit"])
def test_a_lost_run_changes_nothing_and_can_be_repeated(spark, monkeypatch, step):
    from tidemark.sources import ledger as module

    w = warehouse(spark, facts(spark, (1, 1, 0), (2, 2, 0)))
    before = w.ledger.latest()
    with monkeypatch.context() as lost:
        lost.setattr(module.Change, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pipelines.pipe_daily_etl(spark, w, datetime(2025, 1, 20), date(2025, 1, 2))
    assert w.ledger.latest() == before and w.ledger.rows("facts") is None
    pipelines.pipe_daily_etl(spark, w, datetime(2025, 1, 20), date(2025, 1, 2))
    assert rows(w.ledger.rows("facts"), "transaction_id") == [(1,), (2,)]
    log = spark.read.schema(pipelines.LOG_SCHEMA).parquet(w.log_path)
    assert log.filter("status = 'FAILED'").count() == 1


def test_repeated_keys_are_found_in_the_directories_that_may_hold_them(spark):
    store = ledger(spark)
    change = store.begin()
    change.append("facts", facts(spark, (1, 1, 0), (2, 1, 0), (30, 2, 0), (40, 2, 0), (50, 3, 0)), part="sale_date", key="transaction_id")
    change.commit()
    # No repeats: no stored directory is so much as opened.
    change = store.begin()
    new = change.append("facts", facts(spark, (60, 4, 0), (61, 4, 0)), part="sale_date", key="transaction_id")
    opened = []
    read = change.ledger._read
    change.ledger._read = lambda entry, name, where: opened.append([d.path for d in entry.tables[name] if where is None or where(d)]) or read(entry, name, where)
    assert pipelines.deduplicate_new(change, new) == 0
    assert {p for paths in opened for p in paths} == {d.path for d in new}
    change.commit()
    # A later version of 2, and 70 twice: only the directory that holds 2 is rewritten.
    change = store.begin()
    before = {d.part: d.path for d in change.directories("facts")}
    new = change.append("facts", facts(spark, (2, 5, 3), (70, 5, 0), (70, 5, 1), (3, 5, 0)), part="sale_date", key="transaction_id")
    assert pipelines.deduplicate_new(change, new) == 2
    after = {d.part: d.path for d in change.commit().tables["facts"]}
    assert {p for p in before if before[p] != after.get(p)} == {"2025-01-01"}
    assert rows(store.rows("facts"), "transaction_id", "quantity") == [(1, 0), (2, 3), (3, 0), (30, 0), (40, 0), (50, 0), (60, 0), (61, 0), (70, 1)]


def test_incremental_run_looks_keys_up(spark):
    store = ledger(spark)
    start = store.begin()
    start.replace("products", spark.createDataFrame([(1, 11, True), (1, 10, False), (2, 12, True)], "product_id int, product_key int, is_current boolean"))
    start.replace("stores", spark.createDataFrame([(5, 50)], "store_id int, store_key int"))
    start.replace("control", spark.createDataFrame([], CONTROL))
    start.commit()
    schema = "transaction_id bigint, customer_id int, product_id int, store_id int, quantity decimal(6,0), unit_price decimal(12,2), discount_percent decimal(5,2), transaction_ts timestamp_ntz"
    make = lambda *items: spark.createDataFrame([(i, 7, p, s, 2.0, 5.0, 10.0, at) for i, p, s, at in items], schema.replace("decimal(6,0)", "double").replace("decimal(12,2)", "double").replace("decimal(5,2)", "double")).selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]})" for c in schema.split(", ")])
    source = make((1, 1, 5, datetime(2025, 1, 1)), (2, 9, 5, datetime(2025, 1, 2)), (3, 2, 5, datetime(2025, 2, 3)))
    assert pipelines.load_transactions(store, source, datetime(2025, 1, 31)) == 1
    assert pipelines.load_transactions(store, source, datetime(2025, 3, 1)) == 1
    assert pipelines.load_transactions(store, source, datetime(2025, 3, 1)) == 0
    got = rows(store.rows("facts"), "transaction_id", "product_key", "store_key", "date_key", "total_amount")
    assert [(a, b, c, d, float(e)) for a, b, c, d, e in got] == [(1, 11, 50, 20250101, 9.0), (3, 12, 50, 20250203, 9.0)]


SALES = "month date, country string, category string, customer_id int, amount decimal(12,2)"


def sales(spark, *items):
    made = spark.createDataFrame([(date(2025, m, 1), c, k, u, float(a)) for m, c, k, u, a in items], SALES.replace("decimal(12,2)", "double"))
    return made.withColumn("amount", F.col("amount").cast("decimal(12,2)"))


def test_view_follows_appended_and_replaced_months(spark):
    store = ledger(spark)
    view = SummaryView(store, "sales", "month", ["country", "category"], "amount", "customer_id")
    change = store.begin()
    change.append("sales", sales(spark, (1, "a", "x", 1, 5), (1, "a", "x", 1, 7), (2, "b", "x", 2, 1), (2, None, "y", 3, 2)), part="month")
    change.commit()
    everything, coarse = Question(("month", "country", "category")), Question(("country",), ("members", "amount"))
    assert not view.covers(everything) and view.refresh() == ["2025-01-01", "2025-02-01"] and view.covers(everything)
    files = lambda: {d.part: d.path for name in (view.sums, view.sets) for d in store.latest().tables[name]}
    before = files()
    change = store.begin()
    change.append("sales", sales(spark, (2, "b", "x", 2, 4), (2, "b", "x", 9, 4), (3, "a", "x", 1, 1)), part="month")
    change.commit()
    # The stale summary is not used where it misses rows, and is where it does not.
    january = Question(("country",), ("amount",), until=date(2025, 2, 1))
    assert not view.covers(coarse) and view.covers(january)
    assert rows(view.answer(coarse)) == rows(view.from_fact(coarse)) == [("a", 1, 13.0), ("b", 2, 9.0), (None, 1, 2.0)]
    assert rows(view.answer(january)) == [("a", 12.0)]
    assert view.refresh() == ["2025-02-01", "2025-03-01"] and view.refresh() == []
    assert files()["2025-01-01"] == before["2025-01-01"] and files()["2025-02-01"] != before["2025-02-01"]
    for q in (everything, coarse, january, Question((), ("members", "average")), Question(("month",), ("rows",), since=date(2025, 2, 1))):
        assert view.covers(q) and rows(view.from_summary(q)) == rows(view.from_fact(q))
    # A month whose rows were taken back is computed anew.
    change = store.begin()
    change.replace_parts("sales", sales(spark, (2, "b", "z", 4, 8)), "month", ["2025-02-01"])
    change.drop_parts("sales", lambda p: p == "2025-03-01")
    change.commit()
    assert view.stale() == ["2025-02-01", "2025-03-01"] and view.refresh() == ["2025-02-01", "2025-03-01"]
    assert rows(view.from_summary(everything)) == rows(view.from_fact(everything))
    assert not view.covers(Question(("customer_id",))) and not view.covers(Question(("month",), ("median",)))


def test_footers_tell_counts_and_bounds_without_data(spark, tables):
    path = scratch_path(spark, "footers")
    writers.write_partitioned(tables["orders"].select("o_custkey", "o_orderkey", "o_orderstatus"), path, "o_orderstatus")
    counts = footer_counts(spark, path, "o_custkey bigint, o_orderkey bigint, o_orderstatus string", ("o_orderstatus",), low="min:o_orderkey", high="max:o_orderkey")
    want = tables["orders"].groupBy("o_orderstatus").agg(F.count("*"), F.min("o_orderkey"), F.max("o_orderkey"))
    assert rows(counts) == rows(want)
    text = counts._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(o_orderkey), MAX(o_orderkey)]" in text and "PushedGroupBy: [o_orderstatus]" in text
    with pytest.raises(TypeError):
        footer_counts(spark, path, None, (), low="min:o_orderstatus")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_checks_are_made_while_rows_are_written(spark, monkeypatch):
    from tidemark.operators.quality import Rule
    from tidemark.plans.pipelines import load_checked

    store = ledger(spark, "checked")
    rules = [Rule("no value", "v IS NULL"), Rule("large", "v > 10", "WARNING")]
    make = lambda *items: spark.createDataFrame([(k, v, date(2025, 1, d)) for k, v, d in items], "k int, v int, day date")
    first = make((1, 5, 1), (1, 4, 1), (2, None, 1), (2, None, 1), (3, 20, 2), (None, 7, 2), (None, 8, 2))
    load_checked(store, first, rules, ["k"], datetime(2025, 1, 1), "t", part="day")
    assert rows(store.rows("t"), "k", "v") == sorted([(1, 4), (3, 20), (None, 7)], key=repr)
    assert rows(store.rows("t_rejected"), "k", "v", "broken_rules") == [(2, None, ["no value"])] * 2
    files = {d.part: d.path for d in store.latest().tables["t"]}
    load_checked(store, make((1, 1, 3), (4, 11, 3), (None, 1, 3)), rules, ["k"], datetime(2025, 1, 2), "t", part="day")
    assert rows(store.rows("t"), "k", "v") == sorted([(1, 4), (3, 20), (4, 11), (None, 7)], key=repr)
    assert {p: d for p, d in ((d.part, d.path) for d in store.latest().tables["t"]) if p in files} == files
    history = rows(store.rows("dq_history"), "run_at", "check_name", "check_result", "issue_count")
    assert history == sorted([
        (datetime(2025, 1, 1), "no value", "FAIL", 2), (datetime(2025, 1, 1), "large", "WARNING", 1), (datetime(2025, 1, 1), "Duplicate k", "FAIL", 2),
        (datetime(2025, 1, 2), "no value", "PASS", 0), (datetime(2025, 1, 2), "large", "WARNING", 1), (datetime(2025, 1, 2), "Duplicate k", "PASS", 0),
    ], key=repr)
    assert len(store.history()) == 2


def test_the_routed_source_is_read_once(spark, tables):
    from tidemark.operators import quality as dq
    from tidemark.plans.quality_queries import staged_sales, web_logs

    known = tables["events"].select(F.col("event_id").alias("log_id"))
    routed = dq.routed_by_rules(web_logs(tables), dq.WEB_LOG_RULES, ["log_id"], known)
    text = routed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 2  # the logs, and the stored keys
    valid, errors = dq.dq_route_valid_invalid(dq.dq_validate_clean(staged_sales(tables)))
    for df in (valid, errors):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1 and "lineitem" not in text and "PartitionFilters: [isnotnull(validation_status" in text
