"""Synthetic star schema and calendar.

Attributes are cut from one hash per row, so a row depends only on its key and the
seed: any executor can recompute it, and two runs agree.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CENT = Decimal("0.01")

# The words generated columns are drawn from.
STATUSES = ["pending", "processing", "shipped", "delivered", "cancelled"]
PAYMENTS = ["Credit Card", "PayPal", "Bank Transfer", "Cash on Delivery"]
COUNTRIES = ["USA", "UK", "Germany", "France", "Canada"]
CATEGORIES = ["Electronics", "Clothing", "Food", "Books", "Home"]
SEGMENTS = ["Regular", "Premium", "VIP"]


def _hash(table: str, seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(table), F.lit(str(seed)), *[k.cast("string") for k in keys]))


def _number(digest: str | Column, slot: int) -> Column:
    """One of eight numbers 0..65535 in a hash."""
    return F.conv(F.substring(digest, 1 + 4 * slot, 4), 16, 10).cast("int")


def _wide(digest: str | Column) -> Column:
    """The first 32 bits of a hash."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number % len(values) + 1)


def product_price(product_id: Column, seed: int) -> Column:
    """10.00 .. 665.35, a function of the product alone."""
    cents = _number(_hash("product", seed, product_id), 0) + 1000
    return (cents.cast("decimal(8,0)") * CENT).cast("decimal(10,2)")


def gen_customers(ids: DataFrame, seed: int = 42) -> DataFrame:
    key = F.col("id")
    return ids.select("id", _hash("customer", seed, key).alias("h")).select(
        F.col("id").alias("customer_id"),
        F.concat(F.lit("Customer "), key.cast("string")).alias("customer_name"),
        F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")).alias("email"),
        _pick(COUNTRIES, _number("h", 0)).alias("country"),
        _pick(SEGMENTS, _number("h", 1)).alias("customer_segment"),
        F.date_sub(F.lit("2024-01-01").cast("date"), _number("h", 2) % 1000).alias("registration_date"),
    )


def gen_products(ids: DataFrame, seed: int = 42) -> DataFrame:
    key = F.col("id")
    return ids.select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("Product "), key.cast("string")).alias("product_name"),
        _pick(CATEGORIES, _number(_hash("product", seed, key), 1)).alias("category"),
        product_price(key, seed).alias("unit_price"),
    )


def gen_order_items(ids: DataFrame, products: int, seed: int = 42) -> DataFrame:
    """One to five items per order id, made from the id in place; no loop and no shuffle."""
    items = 1 + _number(_hash("order", seed, F.col("id")), 4) % 5
    lines = ids.select(F.col("id").alias("order_id"), F.explode(F.sequence(F.lit(1), items)).alias("item_no"))
    hashed = lines.withColumn("h", _hash("item", seed, F.col("order_id"), F.col("item_no")))
    chosen = hashed.select(
        "order_id",
        "item_no",
        (_wide("h") % products).alias("product_id"),
        (1 + _number("h", 2) % 5).alias("quantity"),
        F.when(_number("h", 3) % 10 >= 7, _number("h", 3) % 20).otherwise(0).alias("discount_percentage"),
    )
    price = product_price(F.col("product_id"), seed)
    kept = (100 - F.col("discount_percentage")).cast("decimal(3,0)") * CENT
    net = price * F.col("quantity").cast("decimal(2,0)") * kept
    return chosen.withColumn("unit_price", price).withColumn("subtotal", F.round(net, 2).cast("decimal(12,2)"))


def gen_orders(ids: DataFrame, customers: int, items: DataFrame, seed: int = 42) -> DataFrame:
    """Orders with the total of their items."""
    totals = items.groupBy(F.col("order_id").alias("k")).agg(
        F.count("*").alias("item_count"), F.sum("subtotal").alias("total_amount")
    )
    return (
        ids.select(F.col("id").alias("order_id"), _hash("order", seed, F.col("id")).alias("h"))
        .select(
            "order_id",
            (_wide("h") % customers).alias("customer_id"),
            F.date_sub(F.lit("2024-12-31").cast("date"), _number("h", 2) % 730).alias("order_date"),
            _pick(STATUSES, _number("h", 3)).alias("status"),
            _pick(PAYMENTS, _number("h", 5)).alias("payment_method"),
        )
        .join(totals, F.col("order_id") == F.col("k"))
        .drop("k")
    )


def gen_star_schema(
    customer_ids: DataFrame, product_ids: DataFrame, order_ids: DataFrame, seed: int = 42
) -> dict[str, DataFrame]:
    """Customers, products, orders and items over the given key ranges (column ``id``, e.g. ``spark.range(n)``)."""
    customers, products = customer_ids.count(), product_ids.count()
    items = gen_order_items(order_ids, products, seed)
    return {
        "customers": gen_customers(customer_ids, seed),
        "products": gen_products(product_ids, seed),
        "order_items": items,
        "orders": gen_orders(order_ids, customers, items, seed),
    }


def gen_calendar(bounds: DataFrame) -> DataFrame:
    """Date dimension between the ``lo`` and ``hi`` of a one-row frame; weeks are ISO, Sunday is day 0."""
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date")).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )
