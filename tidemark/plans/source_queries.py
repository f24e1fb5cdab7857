"""Registered queries for sources, sinks, layouts and generators.

Each writes the given tables out in the format in question and reads them back, so
the SQL over the original tables states the result.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import day, money, on, total
from tidemark.functions.scratch import scratch_path
from tidemark.operators.joins import amounts_by_customer
from tidemark.registry import registered
from tidemark.sources import files, generate, layouts, writers


def _path(t, name: str) -> str:
    return scratch_path(t.spark, name)


@registered("""
    SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice AS amount,
           cast(o_orderdate AS date) AS order_date, o_orderpriority || ' | "as said"' AS note
    FROM orders
""")
def src_csv_typed(t) -> DataFrame:
    path = _path(t, "csv")
    rows = t["orders"].select(
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.col("o_totalprice").alias("amount"),
        day("o_orderdate").alias("order_date"),
        F.concat("o_orderpriority", F.lit(' | "as said"')).alias("note"),
    )
    writers.export_csv(rows, path, sep="|", null="N/A")
    schema = "o_orderkey bigint, o_custkey bigint, status string, amount double, order_date date, note string"
    return files.read_csv(t.spark, path, schema, sep="|", null="N/A")


_BAD_ROWS = """
    WITH raw AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'x' || o_orderkey ELSE o_orderkey::varchar END AS sale_id,
        CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE o_custkey::varchar END AS customer_id,
        CASE WHEN o_orderkey % 50 = 1 THEN 'INVALID_DATE' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sale_date,
        o_orderkey % 50 = 0 AS bad_id, o_orderkey % 50 = 1 AS bad_date, strftime(o_orderdate, '%Y-%m') AS month,
        1 + row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) AS line_number FROM orders)
"""
_SALES = "sale_id bigint, customer_id bigint, sale_date date"


def _load_with_rejects(t, limit: int | None = None):
    """Orders as text, a file per month, with letters in some keys, an invalid date in some rows, a NULL token in others."""
    kind, path = F.col("o_orderkey") % 50, _path(t, "csv-bad")
    rows = t["orders"].select(
        F.when(kind == 0, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string")).alias("sale_id"),
        F.when(kind != 7, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(kind == 1, "INVALID_DATE").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("sale_date"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey",
    )
    # A month's file is in key order, so that the SQL can tell its lines.
    laid = rows.repartition("month").sortWithinPartitions("month", "o_orderkey").drop("o_orderkey")
    laid.write.partitionBy("month").options(header=True, nullValue="NULL", emptyValue='""', quote='"', escape='"').csv(path)
    good, rejects = files.read_csv_reject(t.spark, f"{path}/month=*", _SALES, limit=limit, null="NULL")
    return good, rejects.withColumn("source_file", F.regexp_extract("source_file", "month=([^/]*)/", 1))


@registered(_BAD_ROWS + """
    SELECT 'loaded' AS outcome, sale_id AS record_key, sale_id::bigint AS sale_id, customer_id::bigint AS customer_id,
           sale_date::date AS sale_date, NULL::varchar AS reason, NULL::varchar AS source_file, NULL::bigint AS line_number
    FROM raw WHERE NOT bad_id AND NOT bad_date
    UNION ALL
    SELECT 'rejected', sale_id, NULL, NULL, NULL, CASE WHEN bad_id THEN 'sale_id: not a bigint' ELSE 'sale_date: not a date' END, month, line_number
    FROM raw WHERE bad_id OR bad_date
""")
def src_csv_reject(t) -> DataFrame:
    good, rejects = _load_with_rejects(t)
    loaded = good.select(
        F.lit("loaded").alias("outcome"), F.col("sale_id").cast("string").alias("record_key"), "*",
        F.lit(None).cast("string").alias("reason"),
    )
    refused = rejects.select(F.lit("rejected").alias("outcome"), "record_key", "reason", "source_file", "line_number")
    return loaded.unionByName(refused, allowMissingColumns=True)


@registered(_BAD_ROWS + """
    SELECT month AS source_file, CASE WHEN bad_id THEN 'sale_id: not a bigint' ELSE 'sale_date: not a date' END AS reason,
           count(*) AS error_count, min(line_number) AS first_line, max(line_number) AS last_line
    FROM raw WHERE bad_id OR bad_date GROUP BY 1, 2
""")
def rpt_reject_summary(t) -> DataFrame:
    return files.reject_summary(_load_with_rejects(t)[1])


@registered("""
    SELECT o_orderkey AS col1, o_orderpriority AS col2, cast(o_orderdate AS date) AS col3, o_orderstatus AS file_part FROM orders
""")
def src_multi_file(t) -> DataFrame:
    """One directory per status, whatever statuses there are, read back by a wildcard."""
    root = _path(t, "multi")
    t["orders"].select(
        F.col("o_orderkey").alias("col1"), F.col("o_orderpriority").alias("col2"), day("o_orderdate").alias("col3"), F.col("o_orderstatus").alias("part")
    ).write.options(header=True, nullValue="", emptyValue='""', quote='"', escape='"').partitionBy("part").csv(root)
    rows = files.read_files(t.spark, f"{root}/part=*", "col1 bigint, col2 string, col3 date")
    part = F.nullif(F.regexp_extract("source_file", "/part=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return rows.withColumn("file_part", F.url_decode(part)).drop("source_file")


@registered("""
    SELECT event_id AS log_id, ts, user_id, event_type AS action FROM events
""")
def src_object_store(t) -> DataFrame:
    path = _path(t, "store")
    rows = t["events"].select(F.col("event_id").alias("log_id"), "ts", "user_id", F.col("event_type").alias("action"))
    rows.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    uri = path if "://" in path else f"file://{path}" if path.startswith("/") else path
    return files.read_object_store(
        t.spark, uri, "log_id bigint, ts timestamp_ntz, user_id bigint, action string", header=True,
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    )


@registered("""
    SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_totalprice AS amount,
           cast(o_orderdate AS date) AS transaction_date, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m') AS month
    FROM orders WHERE o_orderdate >= date '2000-01-01'
""")
def ext_filter_insert(t, since=date(2000, 1, 1)) -> DataFrame:
    source, target = _path(t, "ext"), _path(t, "target")
    rows = t["orders"].select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"), day("o_orderdate").alias("transaction_date"), F.col("o_orderstatus").alias("status"),
    )
    writers.export_csv(rows, source)
    schema = "transaction_id bigint, customer_id bigint, amount double, transaction_date date, status string"
    wanted = files.read_csv(t.spark, source, schema).filter(F.col("transaction_date") >= on(since))
    writers.write_partitioned(wanted.withColumn("month", F.date_format("transaction_date", "yyyy-MM")), target, "month")
    return t.spark.read.schema(schema + ", month string").parquet(target)


@registered("""
    SELECT event_id, event_type, user_id, ts AS event_ts, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events
""")
def src_ndjson(t) -> DataFrame:
    """Events as JSON lines, mixed with empty, ``null`` and broken lines that must not become rows."""
    path = _path(t, "ndjson")
    doc = F.to_json(
        F.struct(
            "event_id", "event_type", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
            F.from_json("props", "k bigint").alias("properties"),
        )
    )
    noise = F.element_at(F.array(F.lit(""), F.lit("null"), F.lit('{"cut')), (F.col("event_id") % 3 + 1).cast("int"))
    lines = F.when(F.col("event_id") % 10 == 0, F.array(doc, noise)).otherwise(F.array(doc))
    t["events"].select(F.explode(lines).alias("value")).write.text(path)
    get = lambda name, kind: F.variant_get("doc", f"$.{name}", kind)
    return files.read_ndjson(t.spark, path).select(
        get("event_id", "bigint").alias("event_id"),
        get("event_type", "string").alias("event_type"),
        get("user_id", "bigint").alias("user_id"),
        get("timestamp", "string").cast("timestamp_ntz").alias("event_ts"),
        get("properties.k", "bigint").alias("k"),
    )


@registered("""
    SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand, p_retailprice AS price FROM part
""")
def src_json_document(t, per_document: int = 10_000) -> DataFrame:
    """Product lists wrapped in one document per file.  Part keys are unique, so a document is bounded."""
    path = _path(t, "jsondoc")
    product = F.struct(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"),
    )
    documents = (
        t["part"].groupBy(F.floor(F.col("p_partkey") / per_document).alias("doc")).agg(F.collect_list(product).alias("products"))
        .select("doc", F.to_json(F.struct("products", F.lit("2025-01-31").alias("last_updated"))).alias("value"))
    )
    documents.write.partitionBy("doc").text(path)
    record = "product_id bigint, name string, category string, brand string, price double"
    return files.read_json_document(t.spark, f"{path}/*", record, "products")


@registered("""
    SELECT l_orderkey AS order_id, l_partkey AS product, cast(l_quantity AS bigint) AS quantity FROM lineitem
    UNION ALL SELECT l_orderkey, l_suppkey, cast(l_linenumber AS bigint) FROM lineitem
""")
def src_xml_records(t) -> DataFrame:
    path = _path(t, "xml")
    item = lambda a, b: F.struct(F.col(a).alias("product"), F.col(b).cast("bigint").alias("quantity"))
    items = F.struct(F.array(item("l_partkey", "l_quantity"), item("l_suppkey", "l_linenumber")).alias("item"))
    docs = t["lineitem"].select(F.col("l_orderkey").alias("order_id"), items.alias("items"))
    writers.export_xml(docs, path, "order", "orders", compression="gzip")
    schema = "order_id bigint, items struct<item: array<struct<product: bigint, quantity: bigint>>>"
    return files.read_xml_records(t.spark, path, "order", schema).select("order_id", F.inline("items.item"))


@registered("""
    SELECT c.c_custkey AS customer_id, c.c_name || ' (' || c.c_mktsegment || ')' AS full_name,
           coalesce(cast(sum(cast(o.o_totalprice AS decimal(12,2))) AS double), 0) AS total_purchases
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY c.c_custkey, c.c_name, c.c_mktsegment
""")
def snk_csv_export(t) -> DataFrame:
    path = _path(t, "export")
    bought = amounts_by_customer(t["orders"])
    rows = t["customer"].join(bought, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("full_name"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("total_purchases"),
    )
    writers.export_csv(rows, path)
    return files.read_csv(t.spark, path, "customer_id bigint, full_name string, total_purchases double")


@registered("SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, cast(l_shipdate AS date) AS ship_date FROM lineitem")
def snk_ctas_copy(t) -> DataFrame:
    rows = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", day("l_shipdate").alias("ship_date"))
    return writers.copy_table(rows, _path(t, "copy"), order_by=["l_partkey"])


_MONTHS = "CASE WHEN o_orderdate >= date '1996-01-01' AND o_orderdate < date '2001-01-01' THEN strftime(o_orderdate, '%Y-%m') ELSE 'outliers' END"


def _monthly(t, lo=date(1996, 1, 1), hi=date(2001, 1, 1)) -> str:
    rows = t["orders"].select("o_orderkey", "o_orderdate", "o_totalprice").withColumn(
        "part", writers.month_partition("o_orderdate", lo, hi)
    )
    return writers.write_partitioned(rows, _path(t, "monthly"), "part")


@registered(f"SELECT o_orderkey, o_orderdate, o_totalprice, {_MONTHS} AS part FROM orders")
def snk_partitioned_monthly(t) -> DataFrame:
    return t.spark.read.schema("o_orderkey bigint, o_orderdate timestamp_ntz, o_totalprice double, part string").parquet(_monthly(t))


@registered(f"""
    SELECT {_MONTHS} AS part, count(*) AS row_count, min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders GROUP BY 1
""")
def list_partitions(t) -> DataFrame:
    return writers.list_partitions(t.spark, _monthly(t), "part", bound="o_orderdate").withColumn("part", F.col("part").cast("string"))


@registered("""
    SELECT o_orderkey, CASE WHEN o_orderdate >= date '2000-01-01' AND o_orderdate < date '2000-04-01' THEN 'sales_2000_q1'
      WHEN o_orderdate >= date '2000-04-01' AND o_orderdate < date '2000-07-01' THEN 'sales_2000_q2'
      WHEN o_orderdate >= date '2000-07-01' AND o_orderdate < date '2000-10-01' THEN 'sales_2000_q3'
      WHEN o_orderdate >= date '2000-10-01' AND o_orderdate < date '2001-01-01' THEN 'sales_2000_q4'
      ELSE 'sales_other' END AS part FROM orders
""")
def snk_partitioned_named(t, year: int = 2000) -> DataFrame:
    starts = [date(year, m, 1) for m in (1, 4, 7, 10)] + [date(year + 1, 1, 1)]
    bounds = [(f"sales_{year}_q{i + 1}", starts[i], starts[i + 1]) for i in range(4)]
    rows = t["orders"].select("o_orderkey", writers.named_partition("o_orderdate", bounds, "sales_other").alias("part"))
    return t.spark.read.parquet(writers.write_partitioned(rows, _path(t, "named"), "part"))


@registered("""
    SELECT o_orderkey, CASE WHEN o_orderdate >= date '2000-01-01' AND o_orderdate < date '2001-01-01' THEN 'stored' ELSE 'rejected' END AS outcome,
           CASE WHEN o_orderdate >= date '2000-01-01' AND o_orderdate < date '2001-01-01' THEN NULL ELSE 'no partition for this value' END AS reason
    FROM orders
""")
def snk_partition_reject(t, lo=date(2000, 1, 1), hi=date(2001, 1, 1)) -> DataFrame:
    inside, outside = writers.split_by_range(t["orders"].select("o_orderkey", "o_orderdate"), "o_orderdate", lo, hi)
    path = writers.write_partitioned(inside.withColumn("part", F.date_format("o_orderdate", "yyyy-MM")), _path(t, "strict"), "part")
    stored = t.spark.read.parquet(path).select("o_orderkey", F.lit("stored").alias("outcome"))
    refused = outside.select("o_orderkey", F.lit("rejected").alias("outcome"), "reason")
    return refused.unionByName(stored, allowMissingColumns=True)


@registered("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, r_name AS region FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def snk_partitioned_two_level(t) -> DataFrame:
    rows = (
        t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("r_name").alias("region"))
    )
    path = writers.write_partitioned(rows, _path(t, "twolevel"), "month", "region")
    return t.spark.read.schema("o_orderkey bigint, month string, region string").parquet(path)


@registered("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def layout_hash(t, buckets: int | None = None) -> DataFrame:
    return layouts.layout_hash(t["orders"].select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", buckets)


@registered("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def layout_random(t, partitions: int | None = None) -> DataFrame:
    return layouts.layout_random(t["orders"].select("o_orderkey", "o_custkey", "o_totalprice"), partitions)


@registered("""
    SELECT p.p_type AS category, count(*) AS sales_count, cast(sum(cast(l.l_extendedprice AS decimal(12,2))) AS double) AS total_revenue
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1
""")
def layout_replicated(t) -> DataFrame:
    products = layouts.replicated(t["part"].select("p_partkey", "p_type"))
    return (
        t["lineitem"].join(products, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_type").alias("category"))
        .agg(F.count("*").alias("sales_count"), total(money("l_extendedprice")).alias("total_revenue"))
    )


@registered("""
    WITH n AS (SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM part) AS products),
    o AS (SELECT o_orderkey AS order_id, md5('order:42:' || o_orderkey) AS h FROM orders),
    ids AS (SELECT order_id, unnest(range(1, 2 + ('0x' || substr(h, 17, 4))::integer % 5)) AS item_no FROM o),
    i AS (SELECT order_id, md5('item:42:' || order_id || ':' || item_no) AS h FROM ids),
    c AS (SELECT order_id, (('0x' || substr(h, 1, 8))::bigint % (SELECT products FROM n)) AS product_id,
                 1 + ('0x' || substr(h, 9, 4))::integer % 5 AS quantity,
                 CASE WHEN ('0x' || substr(h, 13, 4))::integer % 10 >= 7 THEN ('0x' || substr(h, 13, 4))::integer % 20 ELSE 0 END AS discount FROM i),
    p AS (SELECT order_id, round((('0x' || substr(md5('product:42:' || product_id), 1, 4))::integer + 1000)::decimal(8,0) * 0.01
                 * quantity::decimal(2,0) * (100 - discount)::decimal(3,0) * 0.01, 2)::decimal(12,2) AS subtotal FROM c),
    s AS (SELECT order_id, count(*) AS item_count, sum(subtotal) AS total_amount FROM p GROUP BY 1)
    SELECT o.order_id, ('0x' || substr(h, 1, 8))::bigint % (SELECT customers FROM n) AS customer_id,
           (date '2024-12-31' - ('0x' || substr(h, 9, 4))::integer % 730)::date AS order_date,
           ['pending', 'processing', 'shipped', 'delivered', 'cancelled'][('0x' || substr(h, 13, 4))::integer % 5 + 1] AS status,
           ['Credit Card', 'PayPal', 'Bank Transfer', 'Cash on Delivery'][('0x' || substr(h, 21, 4))::integer % 4 + 1] AS payment_method,
           s.item_count, cast(s.total_amount AS double) AS total_amount
    FROM o JOIN s ON o.order_id = s.order_id
""")
def gen_star_schema(t) -> DataFrame:
    """The generated orders, over as many keys as the stored orders, customers and parts have."""
    return _star(t)["orders"].withColumn("total_amount", F.col("total_amount").cast("double"))


def _star(t) -> dict[str, DataFrame]:
    return generate.gen_star_schema(
        t["customer"].select(F.col("c_custkey").alias("id")),
        t["part"].select(F.col("p_partkey").alias("id")),
        t["orders"].select(F.col("o_orderkey").alias("id")),
    )


@registered("""
    WITH c AS (SELECT c_custkey AS id, md5('customer:42:' || c_custkey) AS h FROM customer)
    SELECT id AS customer_id, 'Customer ' || id AS customer_name, 'customer' || id || '@example.com' AS email,
           ['USA', 'UK', 'Germany', 'France', 'Canada'][('0x' || substr(h, 1, 4))::integer % 5 + 1] AS country,
           ['Regular', 'Premium', 'VIP'][('0x' || substr(h, 5, 4))::integer % 3 + 1] AS customer_segment,
           (date '2024-01-01' - ('0x' || substr(h, 9, 4))::integer % 1000)::date AS registration_date
    FROM c
""")
def gen_star_customers(t) -> DataFrame:
    return _star(t)["customers"]


@registered("""
    WITH p AS (SELECT p_partkey AS id, md5('product:42:' || p_partkey) AS h FROM part)
    SELECT id AS product_id, 'Product ' || id AS product_name,
           ['Electronics', 'Clothing', 'Food', 'Books', 'Home'][('0x' || substr(h, 5, 4))::integer % 5 + 1] AS category,
           ((('0x' || substr(h, 1, 4))::integer + 1000) / 100.0)::decimal(10,2)::double AS unit_price
    FROM p
""")
def gen_star_products(t) -> DataFrame:
    return _star(t)["products"].withColumn("unit_price", F.col("unit_price").cast("double"))


@registered("""
    WITH o AS (SELECT o_orderkey AS order_id, md5('order:42:' || o_orderkey) AS h FROM orders),
    ids AS (SELECT order_id, unnest(range(1, 2 + ('0x' || substr(h, 17, 4))::integer % 5)) AS item_no FROM o),
    i AS (SELECT order_id, item_no, md5('item:42:' || order_id || ':' || item_no) AS h FROM ids),
    c AS (SELECT order_id, cast(item_no AS integer) AS item_no, ('0x' || substr(h, 1, 8))::bigint % (SELECT count(*) FROM part) AS product_id,
                 1 + ('0x' || substr(h, 9, 4))::integer % 5 AS quantity,
                 CASE WHEN ('0x' || substr(h, 13, 4))::integer % 10 >= 7 THEN ('0x' || substr(h, 13, 4))::integer % 20 ELSE 0 END AS discount_percentage FROM i),
    p AS (SELECT *, ('0x' || substr(md5('product:42:' || product_id), 1, 4))::integer + 1000 AS cents FROM c)
    SELECT order_id, item_no, product_id, quantity, discount_percentage, (cents / 100.0)::decimal(10,2)::double AS unit_price,
           round(cents::decimal(8,0) * 0.01 * quantity::decimal(2,0) * (100 - discount_percentage)::decimal(3,0) * 0.01, 2)::decimal(12,2)::double AS subtotal
    FROM p
""")
def gen_star_items(t) -> DataFrame:
    """The items whose sums are the totals of ``gen_star_schema``."""
    return _star(t)["order_items"].withColumns({c: F.col(c).cast("double") for c in ("unit_price", "subtotal")})


@registered("""
    WITH b AS (SELECT cast(min(o_orderdate) AS date) AS lo, cast(max(o_orderdate) AS date) AS hi FROM orders),
    d AS (SELECT cast(unnest(generate_series(lo::timestamp, hi::timestamp, INTERVAL 1 DAY)) AS date) AS d FROM b)
    SELECT cast(strftime(d, '%Y%m%d') AS integer) AS date_key, d AS full_date, cast(year(d) AS integer) AS year,
           cast(quarter(d) AS integer) AS quarter, cast(month(d) AS integer) AS month, monthname(d) AS month_name,
           cast(weekofyear(d) AS integer) AS week, cast(day(d) AS integer) AS day_of_month,
           cast(dayofweek(d) AS integer) AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
    FROM d
""")
def gen_calendar(t) -> DataFrame:
    bounds = t["orders"].agg(day(F.min("o_orderdate")).alias("lo"), day(F.max("o_orderdate")).alias("hi"))
    return generate.gen_calendar(bounds)
