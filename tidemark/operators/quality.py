"""Validation, quality checks, gates and cleansing of staged rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import scratch_path
from tidemark.operators.unions import stacked


class QualityGateError(RuntimeError):
    """A load was stopped because too many rows are bad."""


_STAGED = ["order_id", "customer_id", "product_id", "order_date", "quantity", "price"]


def dq_validate_clean(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """Text staging columns to typed ones, with a VALID / INVALID mark and the raw row.

    ``strict`` marks a row INVALID when a cleaned value is NULL.  ``reference`` looks at
    the raw text only, so text that fails its pattern still counts as VALID.
    """

    def whole(name: str) -> Column:
        return F.when(F.col(name).rlike(r"^\d+$"), F.col(name).try_cast("int"))

    text = F.col("order_date")
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
    turned = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 2), F.substring(text, 4, 2))
    us = F.when(text.rlike(r"^\d{2}/\d{2}/\d{4}$"), turned.try_cast("date"))
    quantity, price = whole("quantity"), F.col("price").try_cast("decimal(10,2)")
    cleaned = {
        "order_id": whole("order_id"),
        "customer_id": whole("customer_id"),
        "product_id": whole("product_id"),
        "order_date": F.coalesce(iso, us),
        "quantity": F.when(quantity > 0, quantity),
        "price": F.when(F.col("price").rlike(r"^\d+\.?\d*$") & (price >= 0), price),
    }
    missing = lambda c: F.col(c).isNull()
    raw_missing = reduce(Column.__or__, [missing(c) for c in _STAGED])
    rows = raw.select(
        *[expr.alias(name) for name, expr in cleaned.items()],
        F.upper(F.trim("status")).alias("status"),
        raw_missing.alias("_raw_missing"),
        F.to_json(F.struct("*")).alias("raw_data"),
    )
    bad = reduce(Column.__or__, [missing(c) for c in _STAGED]) if mode == "strict" else F.col("_raw_missing")
    return rows.select(
        *cleaned, "status", F.when(bad, "INVALID").otherwise("VALID").alias("validation_status"), "raw_data"
    )


def dq_route_valid_invalid(validated: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows for the fact table; the others as raw text for the error table.

    The rows are computed and written once, in a directory per outcome; both results read theirs.
    """
    path = path or scratch_path(validated.sparkSession, "routed")
    typed = [c for c in validated.columns if c not in ("validation_status", "raw_data")]
    bad = F.col("validation_status") != "VALID"
    routed = validated.select("validation_status", *typed, F.when(bad, F.col("raw_data")).alias("raw_data"))
    routed.write.partitionBy("validation_status").parquet(path)
    stored = validated.sparkSession.read.schema(routed.schema).parquet(path)
    errors = stored.filter(bad).select("raw_data", F.lit("Validation failed").alias("error_message"))
    return stored.filter(~bad).select(*typed), errors


def dq_null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def dq_range_checks(df: DataFrame, ranges: dict[str, Column]) -> DataFrame:
    """One count per named condition, all in one pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in ranges.items()])


def counted_once(df: DataFrame, conditions: dict[str, Column], keys: list[str] | None) -> DataFrame:
    """One row: ``rows``, a count per condition and, with ``keys``, the ``duplicates`` among them.

    One scan and at most one shuffle: the conditions are counted per key, where the
    duplicates show, and then added up.
    """
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    if not keys:
        return df.agg(F.count("*").alias("rows"), *counts)
    per_key = df.groupBy(*keys).agg(F.count("*").alias("rows"), *counts)
    added = [F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name) for name in ("rows", *conditions)]
    return per_key.agg(*added, F.count_if(F.col("rows") > 1).alias("duplicates"))


def dq_report(df: DataFrame, checks: dict[str, Column], keys: list[str]) -> DataFrame:
    """check_name / result rows: the total, one count per check, and duplicate keys, in one scan."""
    names = ["Total Rows", *checks]
    counts = counted_once(df, {f"c{i}": c for i, c in enumerate(checks.values(), 1)}, keys)
    columns = ["rows", *[f"c{i}" for i in range(1, len(names))], "duplicates"]
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(c).cast("string").alias("result")) for n, c in zip([*names, "Duplicates"], columns)]
    return counts.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Rule:
    """``bad`` is the SQL condition of an offending row."""

    name: str
    bad: str
    severity: str = "FAIL"
    details: str = "rows break the rule"


def rules_from_table(rules: DataFrame) -> list[Rule]:
    """Rules kept in a table (check_name, bad, severity, details): one row each, a handful of rows."""
    return [Rule(r["check_name"], r["bad"], r["severity"], r["details"]) for r in rules.orderBy("check_name").collect()]


def _verdicts(counts: DataFrame, rows: list[tuple[str, str, str, str]], table_name: str) -> DataFrame:
    """(name, severity, details, column) per check to result rows, from one row of counts."""
    found = [
        F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), F.lit(d).alias("text"), F.col(c).alias("issue_count"))
        for n, s, d, c in rows
    ]
    clean = F.col("issue_count") == 0
    return counts.select(F.inline(F.array(*found))).select(
        F.lit(table_name).alias("table_name"),
        "check_name",
        F.when(clean, "PASS").otherwise(F.col("severity")).alias("check_result"),
        "issue_count",
        F.concat_ws(" ", F.lit("Found"), F.col("issue_count").cast("string"), "text").alias("check_details"),
    )


def _checks(rules: list[Rule], unique: list[str] | None) -> list[tuple[str, str, str, str]]:
    rows = [(rule.name, rule.severity, rule.details, f"r{i}") for i, rule in enumerate(rules)]
    return rows + ([(f"Duplicate {', '.join(unique)}", "FAIL", "keys occur more than once", "duplicates")] if unique else [])


def dq_rule_engine(df: DataFrame, rules: list[Rule] | DataFrame, table_name: str, unique: list[str] | None = None) -> DataFrame:
    """All rules in one aggregate over the data; result rows ready to append to a check history.

    ``unique`` adds a duplicate-key check; its shuffle carries the other counts along.
    """
    rules = rules_from_table(rules) if isinstance(rules, DataFrame) else rules
    counts = counted_once(df, {f"r{i}": F.expr(rule.bad) for i, rule in enumerate(rules)}, unique)
    return _verdicts(counts, _checks(rules, unique), table_name)


def routed_by_rules(df: DataFrame, rules: list[Rule], keys: list[str], known: DataFrame | None) -> DataFrame:
    """``df`` once through all rules: ``_outcome``, the rules broken, and counts that add up.

    A row that breaks a rule of severity FAIL is ``rejected``.  Of the others, rows with the same
    keys become one, the smallest, which is ``ignored`` if ``known`` has its key and else
    ``promoted``.  One scan and one shuffle: a rejected row is a group of its own.
    ``_r0``, ``_r1``, ... and ``_rows`` say how many rows of ``df`` broke a rule and how many there were.
    """
    broken = [F.coalesce(F.expr(rule.bad), F.lit(False)) for rule in rules]
    fails = [b for b, rule in zip(broken, rules) if rule.severity == "FAIL"]
    bad = reduce(Column.__or__, fails, F.lit(False))
    names = F.array_compact(F.array(*[F.when(b, F.lit(rule.name)) for b, rule in zip(broken, rules)]))
    flagged = df.select(
        F.struct(*df.columns).alias("_row"), names.alias("_broken"), F.when(bad, F.monotonically_increasing_id()).alias("_own"),
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[b.cast("int").alias(f"_r{i}") for i, b in enumerate(broken)],
    )
    grouped = flagged.groupBy(*[f"_key_{k}" for k in keys], "_own").agg(
        F.min(F.struct("_row", "_broken")).alias("_least"), F.count("*").alias("_rows"), *[F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(rules))]
    )
    outcome = F.when(F.col("_own").isNotNull(), "rejected")
    if known is not None:
        stored = known.select(*[F.col(k).alias(f"_stored_{k}") for k in keys]).distinct().withColumn("_known", F.lit(True))
        # NULL keys are rows like others: two of them are one, and a stored one is met again.
        same = reduce(Column.__and__, [F.col(f"_key_{k}").eqNullSafe(F.col(f"_stored_{k}")) for k in keys])
        grouped = grouped.join(stored, same & F.col("_own").isNull(), "left")
        outcome = outcome.when(F.col("_known"), "ignored")
    counts = ["_rows", *[f"_r{i}" for i in range(len(rules))]]
    return grouped.select("_least._row.*", F.col("_least._broken").alias("broken_rules"), outcome.otherwise("promoted").alias("_outcome"), *counts)


WEB_LOG_RULES = [
    Rule("time or code is missing", "timestamp IS NULL OR response_code IS NULL", "FAIL", "rows without time or code"),
    Rule("HTTP code out of range", "response_code NOT BETWEEN 100 AND 599", "FAIL", "rows with an impossible code"),
    Rule("Negative response time", "response_time_ms < 0", "FAIL", "rows with a negative time"),
    Rule("Slow response", "response_time_ms > 10000", "WARNING", "rows slower than ten seconds"),
]


def dq_web_log_checks(logs: DataFrame, table_name: str = "web_logs") -> DataFrame:
    return dq_rule_engine(logs, WEB_LOG_RULES, table_name, unique=["log_id"])


def dq_referential(fact: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphan rows per foreign key.  Keys are counted before they are compared, so a hot orphan is one row."""
    results = []
    for foreign_key, (dim, key) in references.items():
        used = fact.filter(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias("_fk")).agg(F.count("*").alias("n"))
        orphans = used.join(dim.select(F.col(key).alias("_pk")), F.col("_fk") == F.col("_pk"), "left_anti")
        results.append(
            orphans.agg(F.count("*").alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")).withColumn(
                "foreign_key", F.lit(foreign_key)
            )
        )
    return stacked(results)


def dq_gate(df: DataFrame, bad: Column, max_bad: int = 0) -> DataFrame:
    """The rows unchanged, or an error that stops the load."""
    count = df.agg(F.count_if(bad).alias("n")).first()["n"]
    if count > max_bad:
        raise QualityGateError(f"{count} bad rows, {max_bad} allowed")
    return df


def dq_cleanse(df: DataFrame, drop_if: Column | None = None, fixes: dict[str, Column] | None = None) -> DataFrame:
    """Leave out rows for which ``drop_if`` is true (not merely unknown), then replace column values."""
    kept = df if drop_if is None else df.filter(~F.coalesce(drop_if, F.lit(False)))
    return kept.withColumns(fixes) if fixes else kept
