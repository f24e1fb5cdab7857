"""What one task gets is bounded by rows or records, not only by compressed bytes."""

import gzip
from functools import partial
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.functions.scratch import scratch_path
from tidemark.plans import load_queries, source_queries
from tidemark.sources import files, footers, writers


def rows_per_file(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]


def test_narrow_rows_of_one_value_are_written_by_several_tasks(spark, monkeypatch):
    path = scratch_path(spark, "narrow")
    monkeypatch.setattr(writers, "TASK_ROWS", 1000)
    monkeypatch.setattr(footers, "scratch_path", lambda *_: path)
    rows = spark.range(10_000).withColumn("kind", F.when(F.col("id") < 9_000, 1).when(F.col("id") < 9_900, 2))
    got = footers.stored_counts(rows, F.col("kind"), "id")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [(1, 9000, 0, 8999), (2, 900, 9000, 9899), (None, 100, 9900, 9999)]))
    held = rows_per_file(spark, path)
    assert sum(held) == 10_000 and max(held) < 2500 and len(held) <= 10 + 3


def test_facts_are_joined_by_tasks_of_bounded_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(load_queries, "_JOINED", 500)
    facts = load_queries.sales_facts(load_queries._dealt(tables))
    held = [r["count"] for r in facts.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == tables["lineitem"].count() and max(held) < 1500
    plain = load_queries.sales_facts(tables)
    assert facts.exceptAll(plain).isEmpty() and plain.exceptAll(facts).isEmpty()


def test_xml_files_hold_a_bounded_number_of_records(spark, tables, monkeypatch):
    path = scratch_path(spark, "xml")
    docs = spark.range(0, 1000, 1, 1).select(F.col("id").alias("order_id"), F.when(F.col("id") % 7 > 0, F.col("id") * 2).alias("b"))
    writers.export_xml(docs, path, "order", "orders", records=100)
    back = files.read_xml_records(spark, path, "order", "order_id bigint, b bigint")
    held = [r["count"] for r in back.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert sorted(held) == [100] * 10
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, docs.collect()))

    at = []
    monkeypatch.setattr(source_queries, "_path", lambda t, name: at.append(scratch_path(spark, name)) or at[-1])
    monkeypatch.setattr(writers, "export_xml", partial(writers.export_xml, records=1000))
    assert source_queries.src_xml_records(tables).count() == 2 * tables["lineitem"].count()
    stored = files.read_xml_records(spark, at[0], "order", "order_id bigint")
    assert max(r["count"] for r in stored.groupBy(F.col("_metadata.file_name")).count().collect()) <= 1000


def test_xml_files_take_a_small_part_of_the_disk_of_their_text(spark, monkeypatch):
    lines = spark.range(0, 20_000, 1, 2).select(
        F.col("id").alias("l_orderkey"), F.when(F.col("id") % 11 > 0, F.hash("id").cast("bigint")).alias("l_partkey"), F.xxhash64("id").alias("l_suppkey"),
        F.lit(3).alias("l_linenumber"), F.when(F.col("id") % 13 > 0, F.floor(F.col("id") / 2)).alias("l_quantity"),
    )
    given = type("Given", (dict,), {"spark": spark})(lineitem=lines)
    at = []
    monkeypatch.setattr(source_queries, "_path", lambda t, name: at.append(scratch_path(spark, name)) or at[-1])
    got = source_queries.src_xml_records(given)
    want = lines.select("l_orderkey", "l_partkey", "l_quantity").unionAll(lines.select("l_orderkey", "l_suppkey", F.col("l_linenumber").cast("bigint")))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    stored = [f for f in Path(at[0].removeprefix("file:")).iterdir() if f.name.startswith("part-")]
    text = sum(len(gzip.decompress(f.read_bytes()) if f.suffix == ".gz" else f.read_bytes()) for f in stored)
    # Keys without any order, which compress worse than those of a real table.
    assert text > 20_000 * 250 and sum(f.stat().st_size for f in stored) < text / 6

    path = scratch_path(spark, "xml")  # plain where it is not asked for
    writers.export_xml(lines.limit(10), path, "order", "orders")
    assert {f.suffix for f in Path(path.removeprefix("file:")).iterdir() if f.name.startswith("part-")} == {".xml"}
