"""Typed reading of delimited text, JSON and XML files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scratch import written


class RejectLimitExceeded(RuntimeError):
    """More rows were rejected than the load allows."""


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    sep: str = ",",
    null: str = "",
    quote: str = '"',
    escape: str = '"',
    header: bool = True,
) -> DataFrame:
    """Delimited text with a given schema; a value of the wrong type fails the load."""
    return (
        spark.read.schema(schema)
        .options(header=header, sep=sep, nullValue=null, quote=quote, escape=escape, mode="FAILFAST")
        .csv(path)
    )


def _wrong_value(field: T.StructField) -> Column:
    kind = field.dataType.simpleString()
    bad = F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()
    return F.when(bad, F.lit(f"{field.name}: not a {kind}"))


def _places(stored: DataFrame) -> DataFrame:
    """Per file split: how many lines, and lines that open or close a quote, the file has before it.

    One row per split of a scan; splits of one file are added up in the order of their offsets.
    """
    splits = stored.groupBy("_file", "_block").agg(F.count("*").alias("_lines"), F.min("_at").alias("_first"), F.count_if("_odd").alias("_odds"))
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    return splits.select("_file", "_block", "_first", before("_lines").alias("_lines_before"), before("_odds").alias("_odds_before"))


def _with_lines(stored: DataFrame) -> DataFrame:
    """Stored rows, one per line of text, with their line numbers: where the split starts, and the place in it."""
    return stored.join(_places(stored), ["_file", "_block"]).withColumn("_line", F.col("_at") - F.col("_first") + F.col("_lines_before") + 1)


def _text_lines(spark: SparkSession, path: str | list[str], quote: str) -> DataFrame:
    """Every line of text with its file, its split and its place among the lines of the task."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        (quotes % 2 == 1).alias("_odd"),
    )


def _records(lines: DataFrame) -> DataFrame:
    """Lines put together to records where a quoted value holds line ends; ``_line`` is that of the first.

    A line with an odd number of quotes opens or closes such a value, in turn.  Only these lines
    are ordered, split by split; lines of other records stay where they are.
    """
    numbered = _with_lines(lines)
    inside = W.partitionBy("_file", "_block").orderBy("_at")
    odd = numbered.filter("_odd").withColumn("_nth", F.col("_odds_before") + F.row_number().over(inside))
    spans = odd.groupBy("_file", F.ceil(F.col("_nth") / 2).alias("_pair")).agg(F.min("_line").alias("_open"), F.max("_line").alias("_close"))
    spans = spans.filter("_close > _open")
    if spans.isEmpty():
        return numbered.select("_file", "_line", "value")
    parts = spans.select("_file", F.col("_open").alias("_record"), F.explode(F.sequence("_open", "_close")).alias("_line"))
    tagged = numbered.join(parts, ["_file", "_line"], "left")
    value = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_line", "value"))), lambda x: x["value"]), "\n")
    several = tagged.filter("_record is not null").groupBy("_file", "_record").agg(value.alias("value"))
    single = tagged.filter("_record is null").select("_file", "_line", "value")
    return single.unionByName(several.withColumnRenamed("_record", "_line"))


def read_csv_reject(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    limit: int | None = None,
    sep: str = ",",
    null: str = "",
    quote: str = '"',
    header: bool = True,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split a load into typed rows and rejected rows (reason, raw text, source file, line number, first value).

    Files are read in parallel, large ones in several splits, and still have line numbers: a task
    counts its lines, and a split's first line follows from the counts of the splits before it.
    With ``multi_line`` a quoted value may hold line ends, also across splits; quotes inside it are
    doubled.  Otherwise a line is a record.  Empty lines count but are no records.
    The text is parsed once and written out; both results read that copy.  The reason
    depends on every column, so no column is pruned from the parse that decides it.
    ``limit`` is the number of rejects the whole load tolerates.
    """
    schema = _schema(schema)
    names = [f.name for f in schema.fields]
    texts = T.StructType([T.StructField(name, T.StringType()) for name in [*names, "_corrupt"]])
    options = {"sep": sep, "nullValue": null, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = _text_lines(spark, path, quote)
    if multi_line:
        lines = _records(written(lines, "csv-lines"))
    row = F.from_csv("value", _ddl(texts), options).alias("_row")
    place = [c for c in ("_file", "_block", "_at", "_odd", "_line") if c in lines.columns]
    fields = lines.select(*place, "value", row).select(*place, "value", "_row.*")
    malformed = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed row"))
    parsed = written(
        fields.select(
            *place,
            *names,
            F.coalesce(malformed, *[_wrong_value(f) for f in schema.fields]).alias("_reason"),
            F.col("value").alias("_raw"),
        ),
        "csv-parse",
    )
    parsed = parsed if multi_line else _with_lines(parsed)
    parsed = parsed.filter((F.trim("_raw") != "") & ((F.col("_line") > 1) | F.lit(not header)))
    rejects = parsed.filter(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), F.col("_raw").alias("raw_record"), F.col("_file").alias("source_file"),
        F.col("_line").alias("line_number"), F.col(names[0]).alias("record_key"),
    )
    if limit is not None:
        count = rejects.count()
        if count > limit:
            raise RejectLimitExceeded(f"{count} rows rejected, limit {limit}")
    good = parsed.filter(F.col("_reason").isNull()).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    return good, rejects


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Rejects by file and reason, with the first and the last line concerned."""
    return rejects.groupBy("source_file", "reason").agg(
        F.count("*").alias("error_count"),
        F.min("line_number").alias("first_line"),
        F.max("line_number").alias("last_line"),
    )


def read_files(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, **options) -> DataFrame:
    """Many delimited files or a wildcard as one table, with the file each row came from."""
    options = {"header": True, **options}
    return spark.read.schema(schema).options(**options).csv(paths).withColumn("source_file", F.col("_metadata.file_path"))


def object_store_uri(uri: str) -> str:
    """The URI under the scheme Spark's object-store connector answers to."""
    return "s3a://" + uri[len("s3://") :] if uri.startswith("s3://") else uri


def read_object_store(
    spark: SparkSession, uri: str, schema: str | T.StructType, fmt: str = "csv", **options
) -> DataFrame:
    """Files of an object store.  Credentials come from the session's Hadoop configuration."""
    return spark.read.schema(schema).format(fmt).options(**options).load(object_store_uri(uri))


def read_ndjson(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON document per line; empty lines, ``null`` lines and lines that do not parse are left out."""
    line = F.trim("value")
    return (
        spark.read.text(path)
        .filter(F.col("value").isNotNull() & (line != "") & (line != "null"))
        .select(F.col("value").alias("json_line"), F.try_parse_json("value").alias("doc"))
        .filter(F.col("doc").isNotNull())
    )


def read_json_document(
    spark: SparkSession, path: str | list[str], record: str | T.StructType, array_field: str | None = None
) -> DataFrame:
    """Rows of a whole-file JSON array, or of the array ``array_field`` inside a wrapper object.

    A file is one document and one task; files are read in parallel.
    """
    record = _schema(record)
    reader = spark.read.option("multiLine", True)
    if array_field is None:
        return reader.schema(record).json(path)
    wrapper = T.StructType([T.StructField(array_field, T.ArrayType(record))])
    return reader.schema(wrapper).json(path).select(F.inline(array_field))


def read_xml_records(spark: SparkSession, path: str | list[str], row_tag: str, schema: str | T.StructType) -> DataFrame:
    """One row per ``row_tag`` element; the schema is given, so one-element lists stay lists.

    A file is read by one task; ``export_xml`` bounds the files it writes.
    """
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
