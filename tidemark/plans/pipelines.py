"""Load pipelines: chained operators, a run row per step, staging cleared last."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tidemark.functions.exprs import months_back, on
from tidemark.operators import loads
from tidemark.operators import quality as dq
from tidemark.sources.ledger import Change, Directory, Entry, Ledger
from tidemark.sources.statistics import analyze
from tidemark.sources.writers import VersionedTable

LOG_SCHEMA = (
    "process_name string, step_name string, status string, rows_affected bigint, rows_rejected bigint, "
    "error_message string, start_time timestamp, end_time timestamp, duration_seconds bigint"
)


@dataclass
class RunLog:
    """Rows of one pipeline run; a handful per run, appended to the log table at the end."""

    spark: SparkSession
    process: str
    rows: list[tuple] = field(default_factory=list)

    def step(self, name: str, action: Callable[[], tuple[int, int] | int | None], required: bool = True) -> bool:
        """Run and log one step.  A failed one ends the run, unless it is not ``required``: then the
        run goes on and False is returned."""
        start = datetime.now(timezone.utc)

        def note(status: str, done: int | None, rejected: int | None, error: str | None) -> None:
            end = datetime.now(timezone.utc)
            seconds = int((end - start).total_seconds())
            self.rows.append((self.process, name, status, done, rejected, error, start, end, seconds))

        try:
            result = action()
        except Exception as error:
            note("FAILED", None, None, str(error))
            if required:
                raise
            return False
        done, rejected = result if isinstance(result, tuple) else (result, 0)
        note("SUCCESS", done, rejected, None)
        return True

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, LOG_SCHEMA)

    def append_to(self, path: str) -> None:
        self.frame().coalesce(1).write.mode("append").parquet(path)


def publish_counted(table: VersionedTable, df: DataFrame, append: bool = False, version: str | None = None) -> int:
    """Store and count the written rows in the same pass; a version that is stored already adds none."""
    if version is not None and version in table.versions():
        return 0
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    table.append(counted, version) if append else table.publish(counted, version)
    return seen.get["rows"]


def load_new_facts(
    change: Change,
    source: DataFrame,
    ts: str,
    run_at: datetime,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    part: str = "sale_date",
    key: str = "transaction_id",
    name: str = "fact_transactions",
) -> list[Directory]:
    """Stage what came since the watermark, in directories by ``part``, and the watermark moved to it.

    Nothing is visible before ``change`` is committed, and then facts and watermark are at once.
    ``enrich`` looks dimensions up; rows it leaves out do not move the watermark.
    """
    control = change.rows("control")
    fresh, _ = loads.since_watermark(source, control, name, ts, run_at, enrich)
    new = change.append("facts", fresh, part=part, key=key)
    if new:
        paths = {d.path for d in new}
        # The watermark is taken from what was stored, so a source that grows meanwhile loses nothing.
        _, control = loads.since_watermark(change.rows("facts", lambda d: d.path in paths), control, name, ts, run_at)
        change.replace("control", control)
    return new


def deduplicate_new(change: Change, new: list[Directory], key: str = "transaction_id", order: str = "transaction_ts", part: str = "sale_date") -> int:
    """Of rows with the same key the latest stays.  Returns the rows removed.

    Only the new directories and stored ones whose key bounds meet theirs are looked at, and of
    the stored ones only the key column; directories that do hold a repeated key are rewritten.
    """
    if not new:
        return 0
    fresh_paths = {d.path for d in new}
    fresh = change.rows("facts", lambda d: d.path in fresh_paths)
    known = [d for d in new if d.low is not None]
    low, high = (min(d.low for d in known), max(d.high for d in known)) if known else (None, None)
    maybe = change.may_hold("facts", low, high, but=new)
    holders: list[Directory] = []
    if maybe:
        paths = {d.path for d in maybe}
        stored = change.rows("facts", lambda d: d.path in paths).select(key, F.col("_metadata.file_path").alias("_file"))
        files = stored.join(fresh.select(key), key, "left_semi").select(F.regexp_extract("_file", "^(.*)/[^/]*$", 1).alias("f")).distinct()
        folders = [unquote(r.f) for r in files.collect()]  # at most one row per directory
        holders = [d for d in maybe if any(f.endswith(unquote(d.path)) for f in folders)]
    if not holders and fresh.groupBy(key).count().filter("count > 1").isEmpty():
        return 0
    touched = [*new, *holders]
    paths = {d.path for d in touched}
    kept = loads.dedup_keep_latest(change.rows("facts", lambda d: d.path in paths), [key], [order])
    return sum(d.rows for d in touched) - change.swap("facts", touched, kept, part=part, key=key)


def pipe_staging_to_prod(
    staging: VersionedTable,
    production: VersionedTable,
    keys: list[str],
    log_path: str,
    drop_if: Column,
    fixes: dict[str, Column] | None = None,
    checks: list[dq.Rule] = (),
    max_bad: int | None = None,
    process: str = "staging to production",
    statistics: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """Check, cleanse and add staged rows to production, take its statistics, then clear staging.

    Staging is cleared only after the new state of production is published.  A failed
    step is logged and raised, and leaves both tables as they were.  ``statistics`` is the catalog
    name of production and the columns to analyze; a failure there is logged and holds nothing up.
    """
    spark, log = staging.spark, RunLog(staging.spark, process)
    staged, stored = staging.current(), production.current()
    try:
        if checks:
            log.step("quality checks", lambda: dq.dq_rule_engine(staged, list(checks), "staging").agg(F.sum("issue_count")).first()[0])
        if max_bad is not None:
            log.step("quality gate", lambda: dq.dq_gate(staged, drop_if, max_bad) and None)
        clean = dq.dq_cleanse(staged, drop_if, fixes)

        def promote() -> tuple[int, int]:
            target = stored if stored is not None else spark.createDataFrame([], clean.schema)
            rejected = staged.agg(F.count_if(F.coalesce(drop_if, F.lit(False)))).first()[0]
            # Only new rows are written; production is read for its keys alone.
            return publish_counted(production, loads.unknown_rows(target, clean, keys), append=True), rejected

        log.step("promote", promote)
        if statistics is not None:
            log.step("statistics", lambda: analyze(production, *statistics), required=False)
        log.step("clear staging", lambda: staging.publish(staged.limit(0)) and 0)
    finally:
        if log.rows:
            log.append_to(log_path)
    return production.current()


def load_transactions(ledger: Ledger, source: DataFrame, run_at: datetime, ts: str = "transaction_ts") -> int:
    """One incremental run: new rows with the keys of current dimension rows, published with the watermark."""
    change = ledger.begin()

    def enrich(rows: DataFrame) -> DataFrame:
        dims = {"product_id": (change.rows("products"), "product_id", "product_key"), "store_id": (change.rows("stores"), "store_id", "store_key")}
        found = loads.load_fact_enrich(rows, dims).withColumn("date_key", F.date_format(ts, "yyyyMMdd").cast("int"))
        return found.withColumn("sale_month", F.date_format(ts, "yyyy-MM"))

    new = load_new_facts(change, source, ts, run_at, enrich, part="sale_month")
    change.commit(f"transactions until {run_at}")
    return sum(d.rows for d in new)


HISTORY = "run_at timestamp_ntz, table_name string, check_name string, check_result string, issue_count bigint, check_details string"


def load_checked(
    ledger: Ledger,
    staged: DataFrame,
    rules: list[dq.Rule],
    keys: list[str],
    run_at: datetime,
    table: str,
    part: str | None = None,
) -> Entry:
    """Promote staged rows with insert-ignore, keep the rest, and note every check, in one commit.

    Rows are checked while they are written: one write puts promoted rows into ``table`` and
    rejected ones, with the rules they broke, into ``<table>_rejected``; the counts of the checks
    are taken from that write and appended to ``dq_history``.  Running it again with the same rows
    promotes none of them twice.
    """
    change = ledger.begin()
    known = change.rows(table)
    routed = dq.routed_by_rules(staged, rules, keys, None if known is None else known.select(*keys))
    # Counted where rows are written, after the shuffle: a task that is run again counts once.
    seen = Observation()
    counts = [F.coalesce(F.sum(f"_r{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(rules))]
    counts.append(F.count_if(F.col("_rows") > 1).alias("duplicates"))
    rejected = StructType(list(staged.schema.fields)).add("broken_rules", ArrayType(StringType()))
    change.route(
        routed, "_outcome", {"promoted": table, "rejected": f"{table}_rejected"}, {table: staged.schema, f"{table}_rejected": rejected}, part, (seen, counts)
    )
    found = seen.get
    checks = [(rule.name, rule.severity, rule.details, found[f"r{i}"]) for i, rule in enumerate(rules)]
    checks.append((f"Duplicate {', '.join(keys)}", "FAIL", "keys occur more than once", found["duplicates"]))
    rows = [(run_at, table, n, severity if count else "PASS", count, f"Found {count} {text}") for n, severity, text, count in checks]
    change.append("dq_history", ledger.spark.createDataFrame(rows, HISTORY).coalesce(1))
    return change.commit(f"{table} {run_at}")


@dataclass
class Warehouse:
    """The tables of the daily workflow: ``products_staging``, ``products``, ``facts``, ``daily`` and
    ``control``, all in one ledger; the transactions come from outside.  ``part`` is the column that
    deals facts to directories, a day or a month as text or date."""

    ledger: Ledger
    transactions: DataFrame
    log_path: str
    part: str = "sale_date"


def pipe_daily_etl(
    spark: SparkSession,
    w: Warehouse,
    run_at: datetime,
    refresh: date,
    retention_months: int = 24,
    process: str = "daily etl",
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Dimensions, new facts, deduplication, the day's aggregate, retention, in that order.

    All steps belong to one change of the ledger.  A run that fails or is lost at any step
    leaves every table as it was, and of two runs at a time one is refused.  Files of days that no
    step touches stay; the aggregate reads one day of facts.  Returns the stored daily aggregate.
    """
    log, change = RunLog(spark, process), w.ledger.begin()
    new: list[Directory] = []
    try:
        tracked = ["product_name", "category", "price"]
        staged = change.rows("products_staging")

        def dimensions() -> int:
            if staged.isEmpty():  # nothing was delivered, which is not the same as everything withdrawn
                return 0
            return change.replace("products", loads.load_scd2_bulk(change.rows("products"), staged, "product_id", tracked, run_at))

        log.step("dimensions", dimensions)

        def facts() -> int:
            new.extend(load_new_facts(change, w.transactions, "transaction_ts", run_at, enrich, w.part))
            return sum(d.rows for d in new)

        log.step("facts", facts)
        log.step("deduplicate", lambda: deduplicate_new(change, new, part=w.part))

        def aggregate() -> int:
            # Directories of that day, or of its month.
            today = change.rows("facts", lambda d: d.part is not None and str(refresh).startswith(d.part)).filter(F.col("sale_date") == on(refresh))
            return change.replace_parts("daily", loads.daily_sales(today), "sale_date", [str(refresh)])

        log.step("aggregate", aggregate)
        oldest = months_back(refresh, retention_months).strftime("%Y-%m")
        log.step("retention", lambda: sum(d.rows for d in change.drop_parts("facts", lambda day: day is not None and day[:7] < oldest)))
        log.step("clear staging", lambda: change.replace("products_staging", staged.limit(0)))
        log.step("commit", lambda: change.commit(f"{process} {run_at}") and None)
    finally:
        if log.rows:
            log.append_to(w.log_path)
    return w.ledger.rows("daily")
