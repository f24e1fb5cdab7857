"""Small inline data sets with results worked out by hand."""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import jsondoc
from tidemark.functions.scratch import scratch_path
from tidemark.operators import documents, loads
from tidemark.operators import quality as dq
from tidemark.sources import files

# One bakery on one day: item, buyer and branch are chosen so that a branch wins by little.
STAGED = [
    (1, 7, 31, 12, "0.50", "0.00", "harbour"), (2, 7, 32, 1, "18.00", "12.50", "harbour"), (3, 8, 31, 40, "0.50", "25.00", "mill"),
    (4, 9, 33, 3, "4.20", "0.00", "mill"), (5, 9, 33, 1, "4.20", "50.00", "station"),
]


@pytest.fixture(scope="module")
def staged(spark):
    data = [(o, c, p, q, Decimal(u), Decimal(d), date(2023, 6, 3), r) for o, c, p, q, u, d, r in STAGED]
    schema = "order_id bigint, customer_id int, product_id int, quantity int, unit_price decimal(10,2), discount_percent decimal(5,2), order_date date, region string"
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def enriched(staged):
    return loads.load_fact_enrich(staged, {})


def test_line_amounts(enriched):
    got = rows(enriched, "order_id", "discount_amount", "total_amount")
    # 12 x 0.50; 18 less an eighth; 20 less a quarter; 3 x 4.20; half of 4.20
    want = [(1, "0.00", "6.00"), (2, "2.25", "15.75"), (3, "5.00", "15.00"), (4, "0.00", "12.60"), (5, "2.10", "2.10")]
    assert [(o, str(round(d, 2)), str(round(t, 2))) for o, d, t in got] == want


def test_daily_summary(enriched):
    (row,) = loads.summarize_day(enriched, date(2023, 6, 3)).collect()
    # mill has 15.00 + 12.60, harbour 6.00 + 15.75
    assert (row.total_orders, row.unique_customers, row.unique_products, row.top_region) == (5, 3, 3, "mill")
    assert row.total_revenue == pytest.approx(51.45) and row.total_discount == pytest.approx(9.35)
    assert row.avg_order_value == pytest.approx(10.29)


def test_daily_summary_of_an_empty_day_is_no_row(enriched):
    day = date(2023, 6, 4)
    assert loads.summarize_day(enriched, day).count() == 0
    stored = loads.summarize_day(enriched, date(2023, 6, 3)).withColumn("summary_date", F.lit(day))
    assert rows(loads.agg_daily_summary(stored, enriched, day)) == rows(stored)


@pytest.fixture(scope="module")
def api(spark):
    account = {"user_id": 5, "name": "Zoë", "email": None, "settings": {"theme": "sepia", "notifications": False}}
    basket = {"order_id": 90, "customer_id": 5, "items": [{"id": 4, "name": "rye loaf", "qty": 3}], "total": 12.6}
    empty = {"order_id": 91, "customer_id": 6, "items": [], "total": 0}
    rows_ = [("/accounts", account), ("/baskets", basket), ("/baskets", empty), ("/find", {"query": "rye", "results": 0}), ("/ping", {})]
    return spark.createDataFrame([(where, json.dumps(what)) for where, what in rows_], "endpoint string, body string")


def test_json_key_filters(api):
    assert documents.json_key_filter(api, "body", ["order_id"]).count() == 2
    assert documents.json_key_filter(api, "body", ["order_id", "user_id"], "any").count() == 3
    assert documents.json_key_filter(api, "body", ["query", "results"]).count() == 1


def test_json_shredding(spark, api):
    shaped = api.withColumn("endpoint", F.regexp_replace(F.regexp_replace("endpoint", "/accounts", "/api/users/1"), "/baskets", "/api/orders/1"))
    out = documents.json_shred_relational(shaped, "body", "endpoint")
    assert rows(out["users"]) == [(5, "Zoë", None, "sepia", False)]
    assert rows(out["orders"]) == [(90, 5, Decimal("12.60")), (91, 6, Decimal("0.00"))]
    assert rows(out["order_details"]) == [(90, 4, "rye loaf", 3)]


@pytest.mark.parametrize(
    ("document", "literal", "expected"),
    [
        ('{"a": 1, "b": 2}', {"a": 1}, True),
        ('{"a": "1"}', {"a": 1}, False),
        ('{"a": 1.0}', {"a": 1}, True),
        ('{"a": {"b": [1, 2, {"c": 3}]}}', {"a": {"b": [{"c": 3}, 1]}}, True),
        ('{"a": [1, 2]}', {"a": [3]}, False),
        ('{"a": true}', {"a": True}, True),
        ('{"a": true}', {"a": 1}, False),
        ('{"a": null}', {"a": None}, True),
        ("{}", {"a": None}, False),
        ("[1]", {}, False),
        ('{"a b": "x"}', {"a b": "x"}, True),
        ("not json", {"a": 1}, False),
    ],
)
def test_json_containment(spark, document, literal, expected):
    df = spark.createDataFrame([(document,)], "d string")
    assert df.select(jsondoc.contains(F.try_parse_json("d"), literal)).first()[0] is expected


def test_ndjson_lines(spark):
    path = scratch_path(spark, "lines")
    lines = ['{"timestamp": "2022-03-01T23:59:59", "user_id": 4, "event_type": "open", "door": 2}', "", "null", '{"user_id": 6, "event_type": "bake", "trays": [1, 2]}', "{broken"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    typed = {"user_id": "int", "event_type": "string", "timestamp": "timestamp_ntz"}
    got = documents.json_events_normalize(files.read_ndjson(spark, path), "json_line", typed)
    assert rows(got, "user_id", "event_type", "properties") == [
        (4, "open", '{"door":2}'),
        (6, "bake", '{"trays":[1,2]}'),
    ]


DELIVERY = """<delivery><number>D7</number><to><id>8</id><name>Mill &lt;north&gt;</name></to><day>2023-06-03</day><weight>12.25</weight>
<crates><crate><what>rye</what><count>40</count><kilos>0.25</kilos></crate><crate><what>spelt</what><count>9</count><kilos>0.25</kilos></crate>
<crate><what>salt</what></crate></crates></delivery>"""
DELIVERY_SCHEMA = (
    "number string, to struct<id: int, name: string>, day date, weight decimal(10,2), "
    "crates struct<crate: array<struct<what: string, count: int, kilos: decimal(10,2)>>>"
)


def test_delivery_xml(spark):
    df = spark.createDataFrame([(1, DELIVERY), (2, "<delivery><number>D8"), (3, None)], "doc int, x string")
    good, bad = documents.xml_wellformed_split(df, "x", DELIVERY_SCHEMA)
    assert (rows(good, "doc"), rows(bad, "doc")) == ([(1,)], [(2,), (3,)])
    header = documents.xml_header_extract(good, "x", DELIVERY_SCHEMA, {"id": "number", "to": "to.name", "day": "day", "weight": "weight"})
    assert rows(header) == [("D7", "Mill <north>", date(2023, 6, 3), Decimal("12.25"))]
    crates = documents.xml_items_explode(good, "x", DELIVERY_SCHEMA, "crates.crate", {"id": "number"})
    assert rows(crates) == [("D7", "rye", 40, Decimal("0.25")), ("D7", "salt", None, None), ("D7", "spelt", 9, Decimal("0.25"))]
    counted = documents.xml_text_and_count(good, "x", DELIVERY_SCHEMA, "crates.crate", ["doc"]).first()
    assert counted.items_count == 3 and "spelt" in counted.text_nodes


BAD_SALES = """sale_id,product_id,customer_id,quantity,amount,sale_date
4001,7,88,3,19.90,2023-06-30
4002,8,NULL,12,240.00,2023-07-01

4003,9,91,two,5.00,2023-07-02
4004,9,92,1
4005,10,93,1,free,2023-07-04
4006,11,94,4,8.80,2023-07-05
4007,11,95,1,2.20,05/07/2023
"""
SALES = "sale_id int, product_id int, customer_id int, quantity int, amount decimal(10,2), sale_date date"


@pytest.fixture(scope="module")
def bad_sales(spark):
    path = scratch_path(spark, "bad-sales")
    spark.createDataFrame([(BAD_SALES.rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    return path


def test_rejects(spark, bad_sales):
    good, rejects = files.read_csv_reject(spark, bad_sales, SALES, null="NULL")
    assert rows(good, "sale_id", "customer_id", "quantity") == [(4001, 88, 3), (4002, None, 12), (4006, 94, 4)]
    assert rows(rejects, "line_number", "record_key", "reason") == [
        (5, "4003", "quantity: not a int"), (6, "4004", "malformed row"), (7, "4005", "amount: not a decimal(10,2)"), (9, "4007", "sale_date: not a date"),
    ]
    assert rows(files.reject_summary(rejects), "reason", "error_count", "first_line", "last_line")[1] == ("malformed row", 1, 6, 6)


def test_reject_limit(spark, bad_sales):
    files.read_csv_reject(spark, bad_sales, SALES, null="NULL", limit=4)
    with pytest.raises(files.RejectLimitExceeded):
        files.read_csv_reject(spark, bad_sales, SALES, null="NULL", limit=3)


@pytest.mark.parametrize(
    ("values", "clean", "strict", "reference"),
    [
        (("12", "1", "2", "2025-01-31", "3", "9.995", " new "), (12, 1, 2, date(2025, 1, 31), 3, Decimal("10.00"), "NEW"), "VALID", "VALID"),
        (("x", "1", "2", "01/31/2025", "3", "10.", "A"), (None, 1, 2, date(2025, 1, 31), 3, Decimal("10.00"), "A"), "INVALID", "VALID"),
        (("12", None, "2", "31.01.2025", "0", "-1", "A"), (12, None, 2, None, None, None, "A"), "INVALID", "INVALID"),
        (("99999999999", "1", "2", "2025-02-30", "3", "1", "A"), (None, 1, 2, None, 3, Decimal("1.00"), "A"), "INVALID", "VALID"),
    ],
)
def test_validation(spark, values, clean, strict, reference):
    raw = spark.createDataFrame([values], "order_id string, customer_id string, product_id string, order_date string, quantity string, price string, status string")
    got = dq.dq_validate_clean(raw).first()
    assert tuple(got[:7]) == clean and got.validation_status == strict
    assert dq.dq_validate_clean(raw, mode="reference").first().validation_status == reference


def test_gate(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    with pytest.raises(dq.QualityGateError):
        dq.dq_gate(df, F.col("id").isNull())
    assert dq.dq_gate(df, F.col("id").isNull(), max_bad=1).count() == 2


def test_incremental_keeps_the_latest_loaded_time(spark):
    source = spark.createDataFrame([(i, datetime(2025, 1, i)) for i in range(1, 8)], "id int, ts timestamp_ntz")
    control = spark.createDataFrame([], "table_name string, last_load_timestamp timestamp_ntz, rows_loaded bigint, status string")
    target, control = loads.load_incremental(source.limit(0), source.filter("id < 4"), control, "f", "ts", datetime(2025, 1, 20))
    assert rows(control) == [("f", datetime(2025, 1, 3), 3, "SUCCESS")]
    target, control = loads.load_incremental(target, source, control, "f", "ts", datetime(2025, 1, 6))
    assert rows(target, "id") == [(i,) for i in range(1, 7)]
    target, control = loads.load_incremental(target, source.filter("id < 7"), control, "f", "ts", datetime(2025, 1, 6))
    assert rows(control, "last_load_timestamp", "rows_loaded") == [(datetime(2025, 1, 6), 0)]
