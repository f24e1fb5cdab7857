"""Sinks: exports, partitioned tables, versioned tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import on
from tidemark.functions.scratch import written


def export_csv(df: DataFrame, path: str, sep: str = ",", null: str = "") -> str:
    df.write.options(header=True, sep=sep, nullValue=null, emptyValue='""', quote='"', escape='"').csv(path)
    return path


def export_xml(df: DataFrame, path: str, row_tag: str, root_tag: str, records: int = 100_000, compression: str = "none") -> str:
    """Files of at most ``records`` elements each, since an XML file is read by one task.

    Most of an element is its tags, so plain files are many times as large as the rows in Parquet.  With
    ``compression="gzip"`` they are not; a file that is not split loses nothing by it.
    """
    df.write.format("xml").options(rowTag=row_tag, rootTag=root_tag, maxRecordsPerFile=records, compression=compression).save(path)
    return path


def copy_table(df: DataFrame, path: str, order_by: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Copy into another layout: a different number of files, sorted within each."""
    laid = df.repartition(partitions) if partitions else df
    laid = laid.sortWithinPartitions(*order_by) if order_by else laid
    laid.write.parquet(path)
    return df.sparkSession.read.parquet(path)


TASK_ROWS = 1_000_000  # rows a task sorts when it is given a number of rows


def tasks_for(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def write_partitioned(df: DataFrame, path: str, *columns: str, mode: str = "errorifexists", rows: int | None = None) -> str:
    """One directory per value.

    The rebalance hint shuffles on the partition columns, so a directory gets few
    files, and lets AQE split the shuffle partition of a value that holds many rows.

    AQE goes by compressed bytes, and a task sorts what it gets.  Rows of a column or two compress to
    almost nothing, so one task would sort all of them.  Given the number of ``rows``, ranges of
    about ``TASK_ROWS`` are dealt instead; a value may fill several, and a directory has a file of each.
    """
    if rows is None:
        balanced = df.hint("rebalance", *[F.col(c) for c in columns])
    else:
        balanced = df.repartitionByRange(tasks_for(rows, TASK_ROWS), *[F.col(c) for c in columns], F.rand(42))
    balanced.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    return path


def month_partition(ts: str, lo: date, hi: date) -> Column:
    """``yyyy-MM`` inside [lo, hi), the default partition ``outliers`` outside."""
    inside = (F.col(ts) >= on(lo)) & (F.col(ts) < on(hi))
    return F.when(inside, F.date_format(ts, "yyyy-MM")).otherwise("outliers")


def named_partition(ts: str, bounds: list[tuple[str, date, date]], default: str) -> Column:
    """The name of the first [lo, hi) range a value falls in."""
    result = F.lit(None).cast("string")
    for name, lo, hi in bounds:
        result = F.coalesce(result, F.when((F.col(ts) >= on(lo)) & (F.col(ts) < on(hi)), F.lit(name)))
    return F.coalesce(result, F.lit(default))


def split_by_range(df: DataFrame, ts: str, lo: date, hi: date) -> tuple[DataFrame, DataFrame]:
    """Rows inside [lo, hi), and the rows a table without a default partition refuses."""
    inside = F.coalesce((F.col(ts) >= on(lo)) & (F.col(ts) < on(hi)), F.lit(False))
    return df.filter(inside), df.filter(~inside).withColumn("reason", F.lit("no partition for this value"))


def list_partitions(spark: SparkSession, path: str, *columns: str, bound: str) -> DataFrame:
    """Row count and bounds of every partition."""
    return (
        spark.read.option("recursiveFileLookup", "false").parquet(path)
        .groupBy(*columns)
        .agg(F.count("*").alias("row_count"), F.min(bound).alias("low"), F.max(bound).alias("high"))
    )


def read_months(spark: SparkSession, path: str, ts: str, lo: date, hi: date, part: str = "part") -> DataFrame:
    """Rows of [lo, hi) from a month-partitioned table, reading only the directories that can hold them.

    A filter on the timestamp does not prune a derived month by itself, so the month
    predicate is added; ``outliers`` is kept because it may hold any date.
    """
    months = F.date_format(on(lo), "yyyy-MM"), F.date_format(on(hi), "yyyy-MM")
    table = spark.read.option("basePath", path).parquet(path).withColumn(part, F.col(part).cast("string"))
    pruned = table.filter(F.col(part).between(*months) | (F.col(part) == "outliers"))
    return pruned.filter((F.col(ts) >= on(lo)) & (F.col(ts) < on(hi)))


def rewrite_partitions(
    spark: SparkSession, path: str, part: str, source: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> list[str]:
    """Merge ``source`` into a partitioned table, reading and writing only the partitions it touches.

    ``merge(stored rows of those partitions, source)`` gives their new state.  It is
    written to scratch first, because a path cannot be overwritten while it is read.
    A key must not move to another partition; where it can, rewrite both.
    """
    values = [row[0] for row in source.select(F.col(part).cast("string")).distinct().collect()]  # at most one per directory
    touched = sorted(v for v in values if v is not None)
    if not values:
        return touched
    # Stated as literals, so that the scan opens these directories only; NULL has one as well.
    here = F.col(part).cast("string").isin(touched) if touched else F.lit(False)
    here = here | F.col(part).isNull() if None in values else here
    stored = spark.read.schema(source.schema).parquet(path).filter(here)
    write_partitioned(written(merge(stored, source), "merge"), path, part, mode="overwrite")
    return touched


def drop_partitions(path: str, part: str, old: Callable[[str], bool]) -> list[str]:
    """Delete the directories of the partitions whose value ``old`` accepts; no row is read or written."""
    system, root = fs.FileSystem.from_uri(path)
    dropped = []
    for entry in system.get_file_info(fs.FileSelector(root)):
        name, _, value = entry.base_name.partition("=")
        if entry.type == fs.FileType.Directory and name == part and old(unquote(value)):
            system.delete_dir(entry.path)
            dropped.append(unquote(value))
    return sorted(dropped)


class VersionedTable:
    """A table kept as directories, and a log that names the ones that make up its current state.

    ``publish`` replaces the state, ``append`` adds a directory to it.  Either writes its
    rows in full before the log entry that makes them visible, so readers see the old
    or the new state and never a mixture, and no path is overwritten while it is read.
    Doing it again under the same name does nothing, which makes retries harmless.
    """

    _LOG = "seq bigint, version string, kind string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._log = f"{self.root}/_versions"
        # Makes an empty log where there is none, and leaves an existing one alone.
        self._entry(0, "", "").limit(0).write.mode("ignore").parquet(self._log)

    def log(self) -> list[tuple[int, str, str]]:
        """(sequence, name, kind) of every change, oldest first: one short row each."""
        rows = self.spark.read.schema(self._LOG).parquet(self._log).collect()
        return sorted((row["seq"], row["version"], row["kind"]) for row in rows)

    def versions(self) -> list[str]:
        return [name for _, name, _ in self.log()]

    def paths(self) -> list[str]:
        """Directories of the current state: the last full one and what was appended since."""
        live: list[str] = []
        for _, name, kind in self.log():
            live = [name] if kind == "full" else [*live, name]
        return [f"{self.root}/{name}" for name in live]

    def current(self) -> DataFrame | None:
        paths = self.paths()
        return self.spark.read.parquet(*paths) if paths else None

    def publish(self, df: DataFrame, version: str | None = None) -> str:
        return self._write(df, version, "full")

    def append(self, df: DataFrame, version: str | None = None) -> str:
        return self._write(df, version, "delta")

    def _write(self, df: DataFrame, version: str | None, kind: str) -> str:
        names = self.versions()
        version = version or f"v{len(names):08d}"
        if version not in names:
            self._prepared(df, len(names)).write.mode("overwrite").parquet(f"{self.root}/{version}")
            self._entry(len(names), version, kind).write.mode("append").parquet(self._log)
        return version

    def _entry(self, seq: int, version: str, kind: str) -> DataFrame:
        one = self.spark.range(0, 1, 1, 1)
        return one.select(F.lit(seq).cast("bigint").alias("seq"), F.lit(version).alias("version"), F.lit(kind).alias("kind"))

    def _prepared(self, df: DataFrame, seq: int) -> DataFrame:
        return df


class KeyedTable(VersionedTable):
    """A versioned table whose appended rows replace all earlier rows of their keys.

    A change costs a write of the changed keys alone; readers merge.  ``compact``
    stores the merged state when the appended directories have become many.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        super().__init__(spark, root)
        self.keys = keys

    def _prepared(self, df: DataFrame, seq: int) -> DataFrame:
        return df.withColumn("_seq", F.lit(seq).cast("bigint"))

    def current(self) -> DataFrame | None:
        paths = self.paths()
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        if len(paths) == 1:
            return rows.drop("_seq")
        newest = rows.groupBy(*self.keys).agg(F.max("_seq").alias("_newest"))
        newest = newest.withColumnsRenamed({k: f"_key_{k}" for k in self.keys})
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in self.keys])
        current = rows.join(newest, same).filter(F.col("_seq") == F.col("_newest"))
        return current.drop("_seq", "_newest", *[f"_key_{k}" for k in self.keys])

    def compact(self, version: str | None = None) -> str:
        return self.publish(self.current(), version)
