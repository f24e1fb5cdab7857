"""Operators agree with brute force when one key holds a third or more of all rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import ordering
from tidemark.functions.ordering import global_row_number, lead_in_blocks
from tidemark.operators import joins, marts, subqueries, windows
from tidemark.operators.windows import rfm_scores
from tidemark.sources import layouts

ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
HOT = 7


@pytest.fixture(scope="module")
def shop(spark, tables):
    """Orders of which customer 7 has 40 %, many on one day, with payments that follow them."""
    rnd = random.Random(3)
    orders, lines = [], []
    for key in range(600):
        hot = key % 5 < 2
        customer = HOT if hot else rnd.randrange(40)
        day = datetime(2001, 7, 15) if hot and key % 3 == 0 else datetime(2001, 1, 1) + timedelta(days=rnd.randrange(212))
        orders.append((key, customer, rnd.choice("FOP"), float(rnd.randrange(1, 50)), day, "1-URGENT"))
        for number in range(rnd.randrange(0, 4)):
            lines.append((key, rnd.randrange(30), 1, number, 1.0, float(rnd.randrange(1, 99)), 0.05, 0.0, rnd.choice("RNA"), rnd.choice("FO"), day))
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    own = {"orders": spark.createDataFrame(orders, ORDER), "lineitem": spark.createDataFrame(lines, line)}
    return {**{n: tables[n] for n in ("customer", "nation", "region", "part")}, **own}, orders, lines


def test_later_larger(shop):
    t, orders, _ = shop
    want = sorted((o[0],) for o in orders if any(p[1] == o[1] and p[4] > o[4] and p[3] > o[3] for p in orders))
    assert sorted(tuple(r) for r in joins.join_semi_later_larger(t).select("order_id").collect()) == want
    assert sorted(tuple(r) for r in joins.join_semi_later_larger_window(t).select("order_id").collect()) == want


def test_balance_is_the_fanned_out_one(shop):
    t, orders, lines = shop
    owner = {o[0]: o[1] for o in orders}
    pairs = defaultdict(list)
    for o in orders:
        for p in lines:
            if owner[p[0]] == o[1]:
                pairs[o[1]].append((o, p))
    want = {
        c: (len({o[0] for o, _ in v}), len({(p[0], p[3]) for _, p in v}), sum(o[3] for o, _ in v), sum(p[5] for _, p in v)) for c, v in pairs.items()
    }
    got = joins.join_fact_fact_balance(t, days=365, more_than=0)
    assert {r.customer_id: (r.order_count, r.payment_count, r.total_orders, r.total_payments) for r in got.collect()} == want


def test_self_join_count(shop):
    t, _, lines = shop
    want = sum(1 for a in lines for b in lines if a[1] == b[1])
    assert joins.join_self_using(t).first()[0] == want


@pytest.mark.parametrize("block", [1, 7, 10_000_000])
def test_lead_in_blocks(shop, block):
    t, _, _ = shop
    orders = t["orders"].withColumn("d", F.col("o_orderdate").cast("date"))
    plain = orders.withColumn("n", F.lead("o_totalprice").over(W.partitionBy("o_custkey").orderBy("d", "o_orderkey")))
    cut = lead_in_blocks(
        orders, "o_custkey", ["d", "o_orderkey"], {"_d": F.col("d"), "_b": F.floor(F.col("o_orderkey") / block)}, "o_totalprice", "n"
    )
    assert rows(cut, "o_orderkey", "n") == rows(plain, "o_orderkey", "n")


def test_lead_growth_block_size_does_not_matter(shop):
    t, _, _ = shop
    assert rows(windows.win_lead_growth(t, keys_per_block=5)) == rows(windows.win_lead_growth(t))


def test_positions_from_ranges_equal_positions_in_one_task(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("v"))  # three values: every range boundary falls into a tie
    orders = [("a", [F.asc("v"), F.asc("id")]), ("b", [F.desc("v"), F.desc("id")])]
    ranged = global_row_number(df, *orders)
    single = df.select("*", *[F.row_number().over(W.orderBy(*by)).alias(name) for name, by in orders])
    assert rows(ranged) == rows(single)
    assert [r[0] for r in rows(ranged, "a")] == sorted(range(1, 1001), key=repr)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 23, 400])
@pytest.mark.parametrize("few, ranges", [(10_000, 4096), (1, 2), (3, 5)])
def test_tiles_are_ntile(spark, monkeypatch, n, few, ranges):
    """Ties, NULL, negative and distant values, whatever the number of histograms."""
    if n in (4, 5, 7) and few == 3:
        return
    monkeypatch.setattr(ordering, "FEW", few)
    monkeypatch.setattr(ordering, "RANGES", ranges)
    key = (F.col("id") * 7 - 50).alias("key")
    amount = F.when(F.col("id") % 11 != 3, (F.col("id") % 4 * 1000 - F.col("id") % 3).cast("decimal(20,2)") / 7).cast("decimal(20,2)").alias("amount")
    df = spark.range(n).select(key, amount, F.when(F.col("id") % 9 != 8, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 5).cast("int"))).alias("at"))
    got = ordering.with_tiles(df, "key", 5, a=("amount", False), d=("at", True))
    want = df.withColumn("a", F.ntile(5).over(W.orderBy("amount", "key"))).withColumn("d", F.ntile(5).over(W.orderBy(F.desc("at"), "key")))
    assert rows(got, *df.columns, "a", "d") == rows(want)


def test_tiles_take_few_looks_and_no_sort(spark, monkeypatch):
    looks = []
    monkeypatch.setattr(ordering, "_narrow", lambda *a, f=ordering._narrow: looks.append(a) or f(*a))
    df = spark.range(60_000).select(F.col("id").alias("key"), (F.col("id") * 7919 % 100_003).alias("v"), (F.col("id") % 3).alias("ties"))
    got = ordering.with_tiles(df, "key", 5, a=("v", False), b=("ties", False))
    assert len(looks) <= 2 and "Sort" not in got._jdf.queryExecution().toString() and "Window" not in got._jdf.queryExecution().toString()
    assert [r[1] for r in rows(got.groupBy("a").count())] == [12_000] * 5
    assert got.filter("b != floor((ties * 20000 + floor(key / 3)) / 12000) + 1").count() == 0


def test_tiles_of_null_keys_and_other_types(spark):
    df = spark.createDataFrame([(None, 5), (2, 5), (1, 5)], "key bigint, v bigint")
    assert rows(ordering.with_tiles(df, "key", 3, t=("v", False)), "key", "t") == [(1, 2), (2, 3), (None, 1)]
    with pytest.raises(TypeError):
        ordering.with_tiles(spark.createDataFrame([(1, 1.5)], "key bigint, v double"), "key", 5, t=("v", False))


def test_rfm_scores_equal_ntile(shop):
    t, _, _ = shop
    got = rfm_scores(t["orders"])
    base = got.select("customer_id", "last_order", "frequency", F.col("monetary").cast("decimal(22,2)").alias("monetary"))
    orders = (("r_score", [F.desc("last_order")]), ("f_score", [F.asc("frequency")]), ("m_score", [F.asc("monetary")]))
    want = base.select("customer_id", *[F.ntile(5).over(W.orderBy(*by, "customer_id")).alias(name) for name, by in orders])
    assert rows(got, "customer_id", "r_score", "f_score", "m_score") == rows(want)


def test_lead_in_blocks_with_null_keys_and_dates(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 5.0), (7, None, 2.0), (7, 1, 3.0), (7, 2, 4.0), (7, None, 6.0)], "k int, d int, v double")
    df = df.withColumn("i", F.monotonically_increasing_id()).cache()
    plain = df.withColumn("n", F.lead("v").over(W.partitionBy("k").orderBy("d", "i")))
    cut = lead_in_blocks(df, "k", ["d", "i"], {"_d": F.col("d")}, "v", "n")
    assert rows(cut, "k", "d", "v", "n") == rows(plain, "k", "d", "v", "n")


@pytest.fixture(scope="module")
def busy(spark):
    """Events of which user 7 has half, in bursts within single hours."""
    rnd = random.Random(5)
    data = []
    for i in range(500):
        user = HOT if i % 2 else rnd.randrange(6)
        at = datetime(2024, 1, 1) + timedelta(hours=rnd.randrange(40), minutes=rnd.randrange(60), microseconds=rnd.randrange(1_000_000))
        if i % 25 == 0:
            at = datetime(2024, 1, 1) + timedelta(hours=i // 25)  # exact hour edges
        data.append((i, at, user, rnd.choice(["view", "click", "purchase", "error"]), float(rnd.randrange(1, 90)), '{"k": %d}' % rnd.randrange(9)))
    return {"events": spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")}, data


def _near(a, b):
    return a[2] == b[2] and abs(a[1] - b[1]) <= timedelta(hours=1)


def test_interval_join(busy):
    t, data = busy
    want = sorted((c[0], p[0]) for c in data for p in data if c[3] == "click" and p[3] == "purchase" and _near(c, p))
    assert sorted(tuple(r) for r in joins.join_interval_events(t).select("event_id", "purchase_id").collect()) == want


def test_campaign_counts_a_purchase_once(busy):
    t, data = busy
    hits = {(int(e[5][6:-1]) % 5, p[0], p[4]) for e in data for p in data if e[3] in ("view", "click") and p[3] == "purchase" and _near(e, p)}
    want = defaultdict(lambda: [0, 0.0])
    for campaign, _, amount in hits:
        want[f"CAMP{campaign}"][0] += 1
        want[f"CAMP{campaign}"][1] += amount
    got = {r.campaign_id: [r.purchases, r.revenue] for r in marts.mart_campaign_roi(t).collect()}
    assert got == dict(want)


def test_funnel(busy):
    t, data = busy
    users = {e[2] for e in data}
    def first(user, kind, after):
        times = [e[1] for e in data if e[2] == user and e[3] == kind and (after is None or e[1] > after)]
        return min(times, default=None)
    counts = [0, 0, 0]
    for user in users:
        after = None
        for i, kind in enumerate(("view", "click", "purchase")):
            after = first(user, kind, after)
            if after is None:
                break
            counts[i] += 1
    assert [r.users for r in marts.mart_funnel(t).orderBy("step").collect()] == counts


@pytest.mark.parametrize("inner", [[1, 2], [1, None], []])
def test_not_in_follows_null_rules(spark, inner):
    outer = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    sub = spark.createDataFrame([(i,) for i in inner], "s int")
    outer.createOrReplaceTempView("outer_rows")
    sub.createOrReplaceTempView("inner_rows")
    want = spark.sql("SELECT * FROM outer_rows WHERE k NOT IN (SELECT s FROM inner_rows)")
    assert rows(subqueries.not_in(outer, "k", sub, "s")) == rows(want)


def test_hot_keys_are_refused_when_asked(shop):
    t, _, _ = shop
    facts, dims = t["orders"], t["customer"]
    assert layouts.hottest_share(facts, "o_custkey") > 0.4
    with pytest.raises(layouts.HotKey):
        layouts.colocated_pair(facts, "o_custkey", dims, "c_custkey", 8, max_share=0.25)
    assert rows(joins.join_colocated_hash(t)) == rows(joins.join_colocated_hash(t, buckets=2))


def test_large_dimensions_are_not_broadcast(spark, tables):
    def plan(df):
        return df._jdf.queryExecution().analyzed().toString()

    customers = tables["customer"]
    assert layouts.measured_bytes(customers) > 50 * customers.count()
    assert "broadcast" in plan(layouts.replicated(customers))
    assert "broadcast" not in plan(layouts.replicated(customers, max_bytes=1000))


def test_a_hot_customer_is_summed_up_before_it_is_bucketed(shop, monkeypatch):
    t, _, _ = shop
    stored = []
    monkeypatch.setattr(joins, "colocated_pair", lambda *a: stored.append(layouts.colocated_pair(*a)) or stored[-1])
    joins.join_colocated_hash(t, days=10_000).collect()
    facts, _ = stored[0]
    assert facts.count() == t["orders"].select("o_custkey").distinct().count() < t["orders"].count()
    assert layouts.hottest_share(facts, "o_custkey") < 0.1
