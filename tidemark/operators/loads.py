"""Keyed loads as rewrites of whole tables: (target, source) -> new target.

Parquet tables are not updated in place.  Each function returns the new state of the
target; ``VersionedTable.publish`` or a dynamic partition overwrite stores it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import day, months_back, on
from tidemark.functions.ordering import global_row_number
from tidemark.functions.scratch import scratch_path

END_OF_TIME = "9999-12-31"


def _others(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, whose query fails when a key has several rows: nothing says which one counts.

    The test is part of the plan, so the source is computed once.
    """
    rest = _others(df, keys)
    rows = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(F.struct(*rest) if rest else F.lit(0)).alias("_row"))
    several = F.raise_error(F.lit(f"several source rows per {keys}; give an order column"))
    kind = rows.schema["_row"].dataType
    checked = rows.withColumn("_row", F.when(F.col("_n") > 1, several.cast(kind)).otherwise(F.col("_row")))
    return checked.select(*keys, *(["_row.*"] if rest else [])).select(*df.columns) if rest else checked.filter(F.col("_row") == 0).select(*keys)


def dedup_keep_latest(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Exactly one row per key: the last by ``order_by``, and by all columns where that ties.

    An aggregate, not a window: copies of a key shrink to one row in every task before
    the shuffle, so a key with very many copies costs no more than any other.
    """
    rest = _others(df, keys)
    if not rest:
        return df.dropDuplicates(keys)
    rank = F.struct(*order_by, *[c for c in rest if c not in order_by])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def dedup_delete_older(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Delete rows that have a newer twin; twins of the same, newest time all stay."""
    newest = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(ts).alias("_newest"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    stay = F.coalesce(F.col(ts) >= F.col("_newest"), F.lit(True))
    return df.join(newest, same).filter(stay).select(*df.columns)


def load_append(target: DataFrame, source: DataFrame) -> DataFrame:
    """A table without a unique key has no conflicts: every row is added."""
    return target.unionByName(source)


def unknown_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks; of several with one key, the smallest by all columns."""
    rest = _others(source, keys)
    if rest:
        once = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")
    else:
        once = source.dropDuplicates(keys)
    return once.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def load_insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add source rows whose key is not there yet (appending ``unknown_rows`` stores the same)."""
    return target.unionByName(unknown_rows(target, source, keys))


def load_upsert(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Source rows replace target rows of the same key; other target rows stay.

    A key may occur once in the source, unless ``order_by`` says which row is last.
    """
    source = dedup_keep_latest(source, keys, order_by) if order_by else require_unique(source, keys)
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def load_upsert_partial(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """Update only ``update_cols`` of existing keys (a NULL update stays NULL); insert new keys whole."""
    source = require_unique(source, keys)
    t, s = target.withColumn("_old", F.lit(True)).alias("t"), source.withColumn("_new", F.lit(True)).alias("s")
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(name)
        elif name not in source.columns:
            columns.append(F.col(f"t.{name}").alias(name))
        else:
            use_new = F.col("_new").isNotNull() if name in update_cols else F.col("_old").isNull()
            columns.append(F.when(use_new, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
    return t.join(s, keys, "full_outer").select(*columns)


def load_scd2_bulk(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    tracked: list[str],
    as_of: date | datetime | str,
    close_missing: bool = True,
) -> DataFrame:
    """New state of a versioned dimension: closed, unchanged, and new versions.

    ``dim`` carries ``valid_from``, ``valid_to`` and ``is_current``; a key that is repeated
    in ``source`` fails the query.  Attributes are compared null-safe, so a change to or from NULL is a
    change, and a second run with the same source changes nothing.  History passes
    through without a shuffle; current rows meet the source in one full outer join.
    """
    now = F.lit(str(as_of)).cast(dim.schema["valid_from"].dataType)
    end = F.lit(END_OF_TIME).cast(dim.schema["valid_to"].dataType)
    history, current = dim.filter(~F.col("is_current")), dim.filter("is_current")
    old = current.select(F.struct(*dim.columns).alias("_old"), F.col(key).alias("_old_key"))
    source = require_unique(source.select(key, *tracked), [key])
    new = source.select(F.struct(key, *tracked).alias("_new"), F.col(key).alias("_new_key"))
    attributes = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in tracked])
    has_old, has_new = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    same = has_old & has_new & attributes("_old").eqNullSafe(attributes("_new"))
    keep = same | (has_old & ~has_new) if not close_missing else same

    def version(**changes: Column) -> Column:
        values = []
        for field in dim.schema.fields:
            value = changes.get(field.name)
            if value is None:
                value = F.lit(None)
            values.append(value.cast(field.dataType).alias(field.name))
        return F.struct(*values)

    stored = {c: F.col(f"_old.{c}") for c in dim.columns}
    closed = version(**{**stored, "valid_to": now, "is_current": F.lit(False)})
    fresh = version(
        **{c: F.col(f"_new.{c}") for c in [key, *tracked]}, valid_from=now, valid_to=end, is_current=F.lit(True)
    )
    rows = F.array(
        F.when(has_old & keep, version(**stored)),
        F.when(has_old & ~keep, closed),
        F.when(has_new & ~same, fresh),
    )
    joined = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    live = joined.select(F.inline(F.filter(rows, lambda row: row.isNotNull())))
    return history.unionByName(live)


def load_scd2_one(dim: DataFrame, source: DataFrame, key: str, tracked: list[str], as_of) -> DataFrame:
    """Apply given keys only; keys absent from ``source`` stay open."""
    return load_scd2_bulk(dim, source, key, tracked, as_of, close_missing=False)


def dim_surrogate_key(dim: DataFrame, source: DataFrame, natural_key: str, surrogate: str) -> DataFrame:
    """Add source rows with unknown natural keys, numbered on from the largest surrogate key.

    A natural key that is repeated in the source gets one row, the smallest, and one number.
    """
    fresh = unknown_rows(dim, source, [natural_key])
    numbered = global_row_number(fresh, ("_position", [F.asc(natural_key)]))
    last = dim.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    added = numbered.withColumn(surrogate, (F.col("_position") + last).cast(dim.schema[surrogate].dataType))
    return dim.unionByName(added.drop("_position").select(*dim.columns))


def load_fact_enrich(
    staging: DataFrame, dims: dict[str, tuple[DataFrame, str, str]], keep_current: bool = True
) -> DataFrame:
    """Replace natural keys by surrogate keys of current dimension rows, and compute the amounts.

    ``dims`` maps a staging column to (dimension, natural key, surrogate key).
    """
    facts = staging
    for column, (dim, natural, surrogate) in dims.items():
        live = dim.filter("is_current") if keep_current and "is_current" in dim.columns else dim
        lookup = live.select(F.col(natural).alias(f"_{natural}"), surrogate)
        facts = facts.join(lookup, F.col(column) == F.col(f"_{natural}")).drop(f"_{natural}", column)
    gross = F.col("unit_price") * F.col("quantity")
    discount = F.round(gross * F.col("discount_percent") / 100, 2)
    return facts.withColumn("discount_amount", discount).withColumn("total_amount", F.round(gross, 2) - discount)


def since_watermark(
    source: DataFrame,
    control: DataFrame,
    table_name: str,
    ts: str,
    as_of: datetime,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    start: datetime = datetime(1900, 1, 1),
) -> tuple[DataFrame, DataFrame]:
    """Source rows later than the stored watermark, and the control table with the watermark moved.

    The new watermark is the latest time that was loaded, not the clock, so rows that
    reach the source later are not skipped.  Control has one row per table.
    """
    kind = source.schema[ts].dataType
    # Times travel as text, so they mean the same in every session time zone.
    mark = control.filter(F.col("table_name") == table_name).select(F.col("last_load_timestamp").cast("string")).first()
    last = F.lit(mark[0] if mark and mark[0] else str(start)).cast(kind)
    fresh = source.filter((F.col(ts) > last) & (F.col(ts) <= F.lit(str(as_of)).cast(kind)))
    seen = fresh.agg(F.max(ts).alias("last_load_timestamp"), F.count("*").alias("rows_loaded"))
    entry = seen.select(
        F.lit(table_name).alias("table_name"),
        F.coalesce("last_load_timestamp", last).alias("last_load_timestamp"),
        "rows_loaded",
        F.lit("SUCCESS").alias("status"),
    )
    rows = enrich(fresh) if enrich else fresh
    others = control.filter(F.col("table_name") != table_name)
    return rows, others.unionByName(entry)


def load_incremental(target: DataFrame, source: DataFrame, control: DataFrame, *args, **kwargs) -> tuple[DataFrame, DataFrame]:
    """``since_watermark`` added to the target (appending its rows stores the same)."""
    rows, control = since_watermark(source, control, *args, **kwargs)
    return target.unionByName(rows), control


def upd_line_total(df: DataFrame, quantity: str, price: str, out: str) -> DataFrame:
    return df.withColumn(out, (F.col(quantity) * F.col(price)).cast("decimal(14,2)"))


def upd_order_total(orders: DataFrame, items: DataFrame, key: str, item_key: str, amount: str, out: str) -> DataFrame:
    """Order total from its items; an order without items keeps the total it has."""
    sums = items.groupBy(F.col(item_key).alias("_k")).agg(F.sum(amount).alias("_sum"))
    joined = orders.join(sums, F.col(key) == F.col("_k"), "left")
    return joined.withColumn(out, F.coalesce("_sum", F.col(out))).select(*orders.columns)


def daily_sales(fact: DataFrame) -> DataFrame:
    """Fact rows (sale_date, product_key, store_key, transaction_id, customer_id, quantity, total_amount) by day, product, store.

    A transaction has one customer.  So transactions and then customers are counted by grouping,
    each step on fewer rows, where two distinct counts in one step would triple the rows first.
    """
    group = ["sale_date", "product_key", "store_key"]
    sums = [F.sum(c).alias(c) for c in ("quantity", "total_amount", "amounts")]
    rows = fact.withColumn("amounts", F.when(F.col("total_amount").isNotNull(), 1).otherwise(0))
    baskets = rows.groupBy(*group, "customer_id", "transaction_id").agg(*sums)
    buyers = baskets.groupBy(*group, "customer_id").agg(F.count("transaction_id").alias("transactions"), *sums)
    return buyers.groupBy(*group).agg(
        F.sum("transactions").alias("transaction_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_amount").cast("double").alias("total_revenue"),
        (F.sum("total_amount").cast("double") / F.nullif(F.sum("amounts"), F.lit(0))).alias("avg_transaction_amount"),
        F.count("customer_id").alias("unique_customers"),
    )


def agg_refresh_daily(agg: DataFrame, fact: DataFrame, refreshed: date) -> DataFrame:
    """Recompute one day and leave the others; doing it twice changes nothing."""
    today = F.col("sale_date") == on(refreshed)
    return agg.filter(~today).unionByName(daily_sales(fact.filter(today)))


def load_late_facts(agg: DataFrame, fact: DataFrame, late: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add late facts and recompute only the days they touch."""
    days = late.select("sale_date").distinct()
    every = fact.unionByName(late)
    touched = daily_sales(every.join(days, "sale_date", "left_semi"))
    return every, agg.join(days, "sale_date", "left_anti").unionByName(touched)


def summarize_day(orders: DataFrame, summary_date: date) -> DataFrame:
    """One row for a day: counts, sums and the region with most revenue.  A day without orders gives no row."""
    today = orders.filter(F.col("order_date") == on(summary_date))
    best = (
        today.groupBy("region").agg(F.sum("total_amount").alias("_revenue"))
        .orderBy(F.desc("_revenue"), "region").limit(1).select("region")
    )
    return (
        today.agg(
            F.count("*").alias("total_orders"),
            F.sum("total_amount").cast("double").alias("total_revenue"),
            F.sum("discount_amount").cast("double").alias("total_discount"),
            (F.sum("total_amount").cast("double") / F.count("total_amount")).alias("avg_order_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.countDistinct("product_id").alias("unique_products"),
        )
        .filter(F.col("total_orders") > 0)
        .select(on(summary_date).alias("summary_date"), "*", best.scalar().alias("top_region"))
    )


def agg_daily_summary(summary: DataFrame, orders: DataFrame, summary_date: date) -> DataFrame:
    """Upsert the summary row of a day; without orders that day, the stored row stays as it is."""
    some = orders.filter(F.col("order_date") == on(summary_date)).limit(1).agg(F.count("*")).scalar()
    kept = summary.filter((F.col("summary_date") != on(summary_date)) | (some == 0))
    return kept.unionByName(summarize_day(orders, summary_date))


def refresh_summary_table(build: DataFrame, path: str | None = None) -> DataFrame:
    """Store a summary and return it: the refresh of a materialized view."""
    path = path or scratch_path(build.sparkSession, "summary")
    build.write.mode("overwrite").parquet(path)
    return build.sparkSession.read.schema(build.schema).parquet(path)


def part_drop_old(df: DataFrame, month_col: str, months: int, as_of: date) -> DataFrame:
    """Keep month partitions from ``months`` before this month on; anything that is no month stays."""
    cutoff = months_back(as_of, months).strftime("%Y-%m")
    old = F.col(month_col).rlike(r"^\d{4}-\d{2}$") & (F.col(month_col) < cutoff)
    return df.filter(~F.coalesce(old, F.lit(False)))


def log_retention(log: DataFrame, ts: str, days: int, as_of: date) -> DataFrame:
    """Delete rows older than ``days``; rows without a time stay."""
    old = day(ts) < F.date_sub(on(as_of), days)
    return log.filter(~F.coalesce(old, F.lit(False)))


def cdc_capture(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Changed rows between two snapshots: insert and update carry the new row, delete the old one."""
    rest = _others(old, keys)
    o = old.select(*keys, F.struct(*rest).alias("_o"))
    n = new.select(*keys, F.struct(*rest).alias("_n"))
    change = (
        F.when(F.col("_o").isNull(), "insert")
        .when(F.col("_n").isNull(), "delete")
        .when(~F.col("_o").eqNullSafe(F.col("_n")), "update")
    )
    row = F.coalesce("_n", "_o")
    return (
        o.join(n, keys, "full_outer")
        .select(*keys, change.alias("change_type"), row.alias("_row"))
        .filter(F.col("change_type").isNotNull())
        .select(*keys, "change_type", "_row.*")
    )
