"""Shredding of JSON and XML columns into rows and typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import jsondoc
from tidemark.functions.scratch import scratch_path


def json_extract_typed(df: DataFrame, json_col: str, spec: dict[str, tuple[str, str]], keep: list[str] = ()) -> DataFrame:
    """``spec`` maps an output name to (path, type).  The text is parsed once per row."""
    parsed = df.select(*keep, F.parse_json(json_col).alias("_doc"))
    return parsed.select(*keep, *[F.variant_get("_doc", path, kind).alias(name) for name, (path, kind) in spec.items()])


def json_key_filter(df: DataFrame, json_col: str, keys: list[str], how: str = "all") -> DataFrame:
    """Rows whose document has all (or any) of the top-level keys."""
    test = jsondoc.has_all_keys if how == "all" else jsondoc.has_any_key
    return df.filter(test(json_col, list(keys)))


def json_contains(df: DataFrame, json_col: str, literal) -> DataFrame:
    return df.filter(jsondoc.contains(F.try_parse_json(json_col), literal))


def json_value_filter(df: DataFrame, json_col: str, path: str, value: str) -> DataFrame:
    return df.filter(F.get_json_object(json_col, path) == value)


def json_explode_items(df: DataFrame, json_col: str, path: str, element: str, keep: list[str] = ()) -> DataFrame:
    """One row per element of the array at ``path``; ``element`` is the element type."""
    items = F.from_json(F.get_json_object(json_col, path), f"array<{element}>")
    rows = df.select(*keep, F.explode(items).alias("item"))
    return rows.select(*keep, "item.*") if element.lower().startswith("struct") else rows


_API_DOCUMENT = (
    "user_id bigint, name string, email string, settings struct<theme string, notifications boolean>, "
    "order_id bigint, customer_id bigint, total decimal(18,2), items array<struct<id bigint, name string, qty int>>"
)


def json_shred_rows(df: DataFrame, json_col: str, route_col: str) -> DataFrame:
    """API documents to tagged rows: ``table_name`` and one struct per table, of which the named one is set.

    ``route_col`` (the endpoint) tells which tables a document feeds.  A document is parsed once, for all of them.
    """
    parsed = df.select(F.col(route_col).alias("_route"), F.from_json(json_col, _API_DOCUMENT).alias("_doc"))
    is_user, is_order = F.col("_route").like("/api/users/%"), F.col("_route").like("/api/orders/%")
    # A row for the document itself, before those of its items.  The outer form, because the plain one
    # makes Spark test the size of the array first, which parses every document a second time.
    item = "struct<id: bigint, name: string, qty: int>"
    items = F.when(is_order, F.coalesce("_doc.items", F.array().cast(f"array<{item}>"))).otherwise(F.array().cast(f"array<{item}>"))
    rows = parsed.select("_route", "_doc", F.posexplode_outer(F.concat(F.array(F.lit(None).cast(item)), items)).alias("_pos", "_item"))
    rows = rows.filter((is_user | is_order) & F.col("_pos").isNotNull())
    d = lambda path: F.col(f"_doc.{path}")
    detail = F.struct(
        d("order_id").alias("order_id"), F.col("_item.id").alias("product_id"), F.col("_item.name").alias("product_name"), F.col("_item.qty").alias("quantity")
    )
    first = F.col("_pos") == 0
    return rows.select(
        F.when(~first, "order_details").when(is_user, "users").otherwise("orders").alias("table_name"),
        F.when(first & is_user, F.struct(d("user_id"), d("name"), d("email"), d("settings.theme"), d("settings.notifications"))).alias("users"),
        F.when(first & ~is_user, F.struct(d("order_id"), d("customer_id"), d("total"))).alias("orders"),
        F.when(~first, detail).alias("order_details"),
    )


def json_shred_relational(df: DataFrame, json_col: str, route_col: str) -> dict[str, DataFrame]:
    """API documents to users, orders and order details.

    The documents are parsed and their rows written once, in a directory per table; each result reads its own.
    """
    rows, path = json_shred_rows(df, json_col, route_col), scratch_path(df.sparkSession, "shredded")
    rows.write.partitionBy("table_name").parquet(path)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    return {name: stored.filter(F.col("table_name") == name).select(f"{name}.*") for name in ("users", "orders", "order_details")}


def json_events_normalize(df: DataFrame, json_col: str, typed: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """Named top-level members as typed columns, all other members as one JSON text ``properties``."""
    doc = F.parse_json(json_col)
    others = F.map_filter(doc.cast("map<string,variant>"), lambda k, _: ~k.isin(*typed))
    return df.select(
        *keep,
        *[F.variant_get(doc, f"$.{name}", "string").cast(kind).alias(name) for name, kind in typed.items()],
        F.to_json(others).alias("properties"),
    )


def json_device_shred(target: DataFrame, df: DataFrame, json_col: str) -> DataFrame:
    """App events with nested device and properties, added to ``target`` unless their id is there already."""
    doc = F.parse_json(json_col)
    get = lambda path, kind: F.variant_get("_doc", path, kind)
    rows = df.select(doc.alias("_doc")).select(
        get("$.event_id", "string").alias("event_id"),
        get("$.user_id", "bigint").alias("user_id"),
        get("$.event_type", "string").alias("event_type"),
        get("$.timestamp", "string").cast("timestamp_ntz").alias("event_ts"),
        get("$.device.platform", "string").alias("platform"),
        get("$.device.version", "string").alias("device_version"),
        get("$.device.model", "string").alias("device_model"),
        F.to_json(get("$.properties", "variant")).alias("properties"),
    )
    others = [c for c in rows.columns if c != "event_id"]
    once = rows.groupBy("event_id").agg(F.min(F.struct(*others)).alias("r")).select("event_id", "r.*")
    return target.unionByName(once.join(target, "event_id", "left_anti"))


def _with_corrupt(schema: str | T.StructType) -> T.StructType:
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return T.StructType([*fields, T.StructField("_corrupt", T.StringType())])


def _parsed(df: DataFrame, xml_col: str, schema: str | T.StructType) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return df.withColumn("_x", F.from_xml(xml_col, _with_corrupt(schema), options))


def xml_wellformed_flag(df: DataFrame, xml_col: str, schema: str | T.StructType) -> DataFrame:
    """``df`` and whether the text parses, ``is_valid_xml``; NULL does not."""
    good = F.col("_x").isNotNull() & F.col("_x._corrupt").isNull()
    return _parsed(df, xml_col, schema).withColumn("is_valid_xml", good).drop("_x")


def xml_wellformed_split(df: DataFrame, xml_col: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows whose text parses, and the others: parsed and written once, in two directories."""
    flagged, path = xml_wellformed_flag(df, xml_col, schema), scratch_path(df.sparkSession, "wellformed")
    flagged.write.partitionBy("is_valid_xml").parquet(path)
    stored = df.sparkSession.read.schema(flagged.schema).parquet(path)
    return stored.filter("is_valid_xml").drop("is_valid_xml"), stored.filter("not is_valid_xml").drop("is_valid_xml")


def xml_header_extract(df: DataFrame, xml_col: str, schema: str | T.StructType, columns: dict[str, str], keep=()) -> DataFrame:
    """``columns`` maps an output name to the dotted place in ``schema``."""
    return _parsed(df, xml_col, schema).select(*keep, *[F.col(f"_x.{place}").alias(name) for name, place in columns.items()])


def xml_items_explode(
    df: DataFrame, xml_col: str, schema: str | T.StructType, items: str, columns: dict[str, str] | None = None, keep=()
) -> DataFrame:
    """One row per repeated element at ``items``, with header ``columns`` beside it."""
    header = [F.col(f"_x.{place}").alias(name) for name, place in (columns or {}).items()]
    names = [*keep, *(columns or {})]
    # The outer form with a test on the position: the plain form makes Spark test the
    # size of the array first, which parses every document a second time.
    rows = _parsed(df, xml_col, schema).select(*keep, *header, F.posexplode_outer(f"_x.{items}").alias("_pos", "_item"))
    return rows.filter(F.col("_pos").isNotNull()).select(*names, "_item.*")


def xml_text_and_count(df: DataFrame, xml_col: str, schema: str | T.StructType, items: str, keep=()) -> DataFrame:
    """All text nodes in document order, and the number of repeated elements.

    ``xpath`` raises on text that is not well-formed, so split such rows off first.
    """
    texts: Column = F.xpath(F.col(xml_col), F.lit("//text()"))
    counted = F.coalesce(F.size(F.col(f"_x.{items}")), F.lit(0))
    return _parsed(df, xml_col, schema).select(*keep, texts.alias("text_nodes"), counted.alias("items_count"))


def xml_header_detail_join(headers: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Shredded headers beside their items."""
    return headers.join(details, key)
