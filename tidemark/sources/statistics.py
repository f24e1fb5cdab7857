"""Statistics of stored tables after a load, and sessions that order joins by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.writers import VersionedTable

_COST_BASED = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"}
_VERSION = "_version"


def cost_based(spark: SparkSession) -> SparkSession:
    """A session of the same application, with its catalog, that orders joins by statistics; ``spark`` keeps its settings.

    A session remembers a table as it first saw it: ask for one after ``analyze``, or refresh the table in it.
    """
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    for key, value in _COST_BASED.items():
        session.conf.set(key, value)
    return session


def catalog_table(table: VersionedTable, name: str) -> DataFrame:
    """The current state of ``table`` under a name of the catalog, one partition per live directory.

    No row is moved or read.  The name follows the table: a directory that was appended becomes a
    partition, and one that a new full version replaced stops being one.  A name whose columns
    are no longer those of the table is made anew.
    """
    spark, current = table.spark, table.current()
    if current is None:
        raise ValueError(f"{table.root} has no version yet")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in current.schema)
    if spark.catalog.tableExists(name) and spark.table(name).drop(_VERSION).dtypes != current.dtypes:
        spark.sql(f"DROP TABLE {name}")  # external: its files stay
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({columns}, {_VERSION} STRING) USING parquet PARTITIONED BY ({_VERSION}) LOCATION '{table.root}/_catalog'"
        )
    live = {path.rsplit("/", 1)[1]: path for path in table.paths()}
    known = {row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # one per directory
    for version in sorted(known - live.keys()):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({_VERSION}='{version}')")
    for version in sorted(live.keys() - known):
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({_VERSION}='{version}') LOCATION '{live[version]}'")
    return spark.table(name).drop(_VERSION)


def analyze(table: VersionedTable, name: str, columns: list[str]) -> int:
    """Take the statistics of ``columns`` under the catalog name ``name``.  Returns the number of rows.

    One distributed aggregate that reads these columns only.  Name the join keys and filter
    columns; the optimizer of a ``cost_based`` session then estimates joins and filters from them.
    """
    rows = catalog_table(table, name)
    if columns:
        wanted = ", ".join(f"`{c}`" for c in columns)
        table.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {wanted}")
    else:
        table.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    return rows.count()  # from footers, without a column


def column_statistics(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """What the catalog knows of each column: bounds, NULLs, and the estimated number of distinct values."""
    picked = {"min": "low", "max": "high", "num_nulls": "null_count", "distinct_count": "distinct_estimate"}
    found = []
    for column in columns:
        told = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()}
        found.append((column, *[None if told.get(k) in (None, "NULL") else told[k] for k in picked]))
    schema = "column_name string, " + ", ".join(f"{n} string" for n in picked.values())
    counts = [F.col(n).cast("bigint").alias(n) for n in ("null_count", "distinct_estimate")]
    return spark.createDataFrame(found, schema).select("column_name", "low", "high", *counts)
