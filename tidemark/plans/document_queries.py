"""Registered queries over JSON and XML documents made from the tables, one document per row.

The documents are built inside the row they describe, so no task gathers a group; the
SQL over the flat tables states what shredding them must give back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import jsondoc
from tidemark.functions.exprs import money
from tidemark.operators import documents as docs
from tidemark.operators.unions import stacked
from tidemark.registry import registered


def user_documents(t) -> DataFrame:
    key = F.col("c_custkey")
    settings = F.struct(
        F.when(key % 2 == 0, "dark").otherwise("light").alias("theme"), (key % 3 == 0).alias("notifications")
    )
    body = F.struct(
        key.alias("user_id"), F.col("c_name").alias("name"),
        F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"), settings.alias("settings"),
    )
    return t["customer"].select(F.concat(F.lit("/api/users/"), key.cast("string")).alias("endpoint"), F.to_json(body).alias("body"))


def order_documents(t) -> DataFrame:
    item = lambda key, qty, label: F.struct(
        F.col(key).alias("id"), F.concat(F.lit(label), F.col(key).cast("string")).alias("name"), F.col(qty).cast("int").alias("qty")
    )
    body = F.struct(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("customer_id"),
        F.array(item("l_partkey", "l_quantity", "part "), item("l_suppkey", "l_linenumber", "service ")).alias("items"),
        money("l_extendedprice").alias("total"),
    )
    endpoint = F.concat(F.lit("/api/orders/"), F.col("l_orderkey").cast("string"))
    lines = t["lineitem"].select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity", "l_linenumber", "l_extendedprice")
    return lines.select(endpoint.alias("endpoint"), F.to_json(body).alias("body"))


def search_documents(t) -> DataFrame:
    filters = F.struct(
        F.col("p_size").alias("price_min"), (F.col("p_size") + 100).alias("price_max"),
        F.array(F.col("p_brand"), F.lit("Brand#0")).alias("brands"),
    )
    body = F.struct(F.col("p_type").alias("query"), F.col("p_size").alias("results"), filters.alias("filters"))
    endpoint = F.concat(F.lit("/api/search/"), F.col("p_partkey").cast("string"))
    return t["part"].select(endpoint.alias("endpoint"), F.to_json(body).alias("body"))


def api_documents(t) -> DataFrame:
    return stacked([user_documents(t), order_documents(t), search_documents(t)])


@registered("""
    SELECT '/api/users/' || c_custkey AS endpoint, c_custkey::varchar AS user_id_text, c_custkey AS user_id, c_name AS user_name,
           CASE WHEN c_custkey % 2 = 0 THEN 'dark' ELSE 'light' END AS theme, c_custkey % 3 = 0 AS notifications FROM customer
""")
def json_extract_typed(t) -> DataFrame:
    spec = {
        "user_id_text": ("$.user_id", "string"), "user_id": ("$.user_id", "bigint"), "user_name": ("$.name", "string"),
        "theme": ("$.settings.theme", "string"), "notifications": ("$.settings.notifications", "boolean"),
    }
    return docs.json_extract_typed(user_documents(t), "body", spec, ["endpoint"])


@registered("""
    SELECT '/api/users/' || c_custkey AS endpoint, 'no order' AS order_flag, true AS any_key, false AS all_keys FROM customer
    UNION ALL SELECT '/api/orders/' || l_orderkey, 'has order', true, false FROM lineitem
    UNION ALL SELECT '/api/search/' || p_partkey, 'no order', false, true FROM part
""")
def json_key_filter(t) -> DataFrame:
    flag = F.when(jsondoc.has_key("body", "order_id"), "has order").otherwise("no order")
    return api_documents(t).select(
        "endpoint",
        flag.alias("order_flag"),
        jsondoc.has_any_key("body", ["order_id", "user_id"]).alias("any_key"),
        jsondoc.has_all_keys("body", ["query", "results"]).alias("all_keys"),
    )


@registered("""
    SELECT 'dark theme' AS question, '/api/users/' || c_custkey AS endpoint FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT 'item 7', '/api/orders/' || l_orderkey FROM lineitem WHERE l_partkey = 7 OR l_suppkey = 7
    UNION ALL SELECT 'brand 2', '/api/search/' || p_partkey FROM part WHERE p_brand = 'Brand#2'
""")
def json_contains(t) -> DataFrame:
    questions = {
        "dark theme": {"settings": {"theme": "dark"}},
        "item 7": {"items": [{"id": 7}]},
        "brand 2": {"filters": {"brands": ["Brand#2"]}},
    }
    """Each document is read and parsed once and answers every question."""
    parsed = api_documents(t).select("endpoint", F.try_parse_json("body").alias("doc"))
    answers = F.array_compact(F.array(*[F.when(jsondoc.contains(F.col("doc"), literal), F.lit(name)) for name, literal in questions.items()]))
    return parsed.select(F.explode(answers).alias("question"), "endpoint")


@registered("SELECT '/api/search/' || p_partkey AS endpoint, p_size AS results FROM part WHERE p_type = 'PROMO'")
def json_value_filter(t) -> DataFrame:
    found = docs.json_value_filter(api_documents(t), "body", "$.query", "PROMO")
    return found.select("endpoint", F.get_json_object("body", "$.results").cast("int").alias("results"))


@registered("""
    SELECT '/api/orders/' || l_orderkey AS endpoint, l_partkey AS item_id, 'part ' || l_partkey AS item, l_quantity::integer AS quantity FROM lineitem
    UNION ALL SELECT '/api/orders/' || l_orderkey, l_suppkey, 'service ' || l_suppkey, l_linenumber FROM lineitem
    UNION ALL SELECT '/api/search/' || p_partkey, NULL, p_brand, NULL FROM part
    UNION ALL SELECT '/api/search/' || p_partkey, NULL, 'Brand#0', NULL FROM part
""")
def json_explode_items(t) -> DataFrame:
    items = docs.json_explode_items(order_documents(t), "body", "$.items", "struct<id bigint, name string, qty int>", ["endpoint"])
    brands = docs.json_explode_items(search_documents(t), "body", "$.filters.brands", "string", ["endpoint"])
    objects = items.select("endpoint", F.col("id").alias("item_id"), F.col("name").alias("item"), F.col("qty").alias("quantity"))
    return objects.unionByName(brands, allowMissingColumns=True)


@registered("""
    SELECT 'users' AS table_name, c_custkey AS id, NULL::bigint AS ref, c_name || '|user' || c_custkey || '@example.com|'
           || CASE WHEN c_custkey % 2 = 0 THEN 'dark' ELSE 'light' END || '|' || (c_custkey % 3 = 0) AS label, NULL::double AS amount FROM customer
    UNION ALL SELECT 'orders', l_orderkey, l_suppkey, NULL, l_extendedprice::decimal(12,2)::double FROM lineitem
    UNION ALL SELECT 'order_details', l_orderkey, l_partkey, 'part ' || l_partkey, l_quantity::integer::double FROM lineitem
    UNION ALL SELECT 'order_details', l_orderkey, l_suppkey, 'service ' || l_suppkey, l_linenumber::double FROM lineitem
""")
def json_shred_relational(t) -> DataFrame:
    rows = docs.json_shred_rows(api_documents(t), "body", "endpoint")
    label = F.concat_ws("|", "users.name", "users.email", "users.theme", F.col("users.notifications").cast("string"))
    return rows.select(
        "table_name",
        F.coalesce("users.user_id", "orders.order_id", "order_details.order_id").alias("id"),
        F.coalesce("orders.customer_id", "order_details.product_id").alias("ref"),
        F.when(F.col("users").isNotNull(), label).otherwise(F.col("order_details.product_name")).alias("label"),
        F.coalesce(F.col("orders.total").cast("double"), F.col("order_details.quantity").cast("double")).alias("amount"),
    )


@registered("""
    SELECT user_id, event_type, ts AS "timestamp",
           '{"duration":' || floor(value)::bigint || ',"page":{"k":' || json_extract_string(props, '$.k') || '}}' AS properties
    FROM events
""")
def json_events_normalize(t) -> DataFrame:
    body = F.struct(
        F.floor("value").cast("bigint").alias("duration"), F.from_json("props", "k bigint").alias("page"), "user_id", "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    raw = t["events"].select(F.to_json(body).alias("event_data"))
    return docs.json_events_normalize(raw, "event_data", {"user_id": "bigint", "event_type": "string", "timestamp": "timestamp_ntz"})


@registered("""
    SELECT 'evt_' || event_id AS event_id, user_id, event_type, ts AS event_ts,
           CASE WHEN event_id % 7 = 0 THEN 'old' WHEN user_id % 2 = 0 THEN 'iOS' ELSE 'Android' END AS platform,
           (user_id % 5)::varchar AS device_version, 'model ' || (user_id % 9) AS device_model,
           '{"screen_name":"' || event_type || '","time_spent":' || floor(value)::bigint || '}' AS properties
    FROM events
""")
def json_device_shred(t) -> DataFrame:
    """Every fifth document arrives twice; every seventh id is stored already and must stay as it is."""
    user, event = F.col("user_id"), F.concat(F.lit("evt_"), F.col("event_id").cast("string"))
    platform = F.when(user % 2 == 0, "iOS").otherwise("Android")
    version, model = (user % 5).cast("string"), F.concat(F.lit("model "), (user % 9).cast("string"))
    properties = F.struct(F.col("event_type").alias("screen_name"), F.floor("value").cast("bigint").alias("time_spent"))
    body = F.struct(
        event.alias("event_id"), "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(platform.alias("platform"), version.alias("version"), model.alias("model")).alias("device"),
        properties.alias("properties"),
    )
    times = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    incoming = t["events"].select(F.to_json(body).alias("event_json"), F.explode(times))
    stored = t["events"].filter(F.col("event_id") % 7 == 0).select(
        event.alias("event_id"), "user_id", "event_type", F.col("ts").alias("event_ts"), F.lit("old").alias("platform"),
        version.alias("device_version"), model.alias("device_model"), F.to_json(properties).alias("properties"),
    )
    return docs.json_device_shred(stored, incoming, "event_json")


ORDER_XML = (
    "order_id bigint, customer_id bigint, order_date date, total decimal(12,2), status string, "
    "items struct<item: array<struct<product_name: string, quantity: int>>>"
)


def xml_documents(t) -> DataFrame:
    item = lambda label, qty: F.struct(label.alias("product_name"), qty.cast("int").alias("quantity"))
    key = F.col("o_orderkey")
    first = item(F.concat(F.lit("Tom & "), F.col("o_orderpriority")), key % 5 + 1)
    second = item(F.concat(F.lit("gift <"), (key % 7).cast("string"), F.lit(">")), key % 3 + 1)
    items = F.when(key % 4 == 0, F.array(first)).otherwise(F.array(first, second))
    body = F.struct(
        key.alias("order_id"), F.col("o_custkey").alias("customer_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        money("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status"), F.struct(items.alias("item")).alias("items"),
    )
    return t["orders"].select(key.alias("doc_id"), F.to_xml(body, {"rowTag": "order", "indent": ""}).alias("xml_content"))


_ITEMS_SQL = """
    SELECT o_orderkey AS order_id, 'Tom & ' || o_orderpriority AS product_name, (o_orderkey % 5 + 1)::integer AS quantity FROM orders
    UNION ALL SELECT o_orderkey, 'gift <' || (o_orderkey % 7) || '>', (o_orderkey % 3 + 1)::integer FROM orders WHERE o_orderkey % 4 <> 0
"""
_HEADER = {"order_id": "order_id", "customer_id": "customer_id", "order_date": "order_date", "total": "total", "status": "status"}


@registered("""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, cast(o_orderdate AS date) AS order_date,
           o_totalprice::decimal(12,2)::double AS total, o_orderstatus AS status FROM orders
""")
def xml_header_extract(t) -> DataFrame:
    rows = docs.xml_header_extract(xml_documents(t), "xml_content", ORDER_XML, _HEADER)
    return rows.withColumn("total", F.col("total").cast("double"))


@registered(_ITEMS_SQL)
def xml_items_explode(t) -> DataFrame:
    return docs.xml_items_explode(xml_documents(t), "xml_content", ORDER_XML, "items.item", {"order_id": "order_id"})


@registered("SELECT o_orderkey AS doc_id, o_orderkey % 10 <> 0 AS is_valid_xml FROM orders")
def xml_wellformed_split(t) -> DataFrame:
    """Every tenth document has lost its end."""
    cut = F.expr("left(xml_content, length(xml_content) - 12)")
    broken = xml_documents(t).withColumn("xml_content", F.when(F.col("doc_id") % 10 == 0, cut).otherwise(F.col("xml_content")))
    return docs.xml_wellformed_flag(broken, "xml_content", ORDER_XML).select("doc_id", "is_valid_xml")


@registered("""
    SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 2 END::integer AS items_count,
           o_orderkey || '|' || o_custkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || o_totalprice::decimal(12,2) || '|' || o_orderstatus
           || '|Tom & ' || o_orderpriority || '|' || (o_orderkey % 5 + 1)
           || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '|gift <' || (o_orderkey % 7) || '>|' || (o_orderkey % 3 + 1) END AS texts
    FROM orders
""")
def xml_text_and_count(t) -> DataFrame:
    rows = docs.xml_text_and_count(xml_documents(t), "xml_content", ORDER_XML, "items.item", ["doc_id"])
    return rows.select("doc_id", "items_count", F.array_join("text_nodes", "|").alias("texts"))


@registered(f"""
    WITH items AS ({_ITEMS_SQL})
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, cast(o_orderdate AS date) AS order_date,
           o_totalprice::decimal(12,2)::double AS total, o_orderstatus AS status, product_name, quantity
    FROM orders JOIN items ON o_orderkey = order_id
""")
def xml_header_detail_join(t) -> DataFrame:
    """Header columns beside every item; both come out of one parse."""
    rows = docs.xml_items_explode(xml_documents(t), "xml_content", ORDER_XML, "items.item", _HEADER)
    return rows.withColumn("total", F.col("total").cast("double"))
