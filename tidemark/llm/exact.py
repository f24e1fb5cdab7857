"""Exact deduplication by content-defined chunk recipes.

A text is cut where its content says so, at line and sentence ends, so equal passages give
equal chunks wherever they stand.  Inside the scan every chunk is reduced to two independent
digests; the texts themselves never move.  The chunk dictionary gives each distinct chunk an
identifier and verifies it: chunks that share the short digest but not the long one get
different identifiers.  Two texts are equal when their ordered identifier lists are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm.common import fresh_name, joined_with_groups, numbered, stably_numbered, whole

# A chunk ends at the first line or sentence end after this many characters, or at the most.
CHUNK_MIN, CHUNK_MAX = 512, 4096


def chunks(text: Column, least: int = CHUNK_MIN, most: int = CHUNK_MAX) -> Column:
    """The chunks of a text in order; joined they are the text again.  No chunk of an empty text."""
    # A surrogate pair is one character to the pattern, so none is cut.
    pattern = rf"(?s).{{{least},{most}}}?(?:\n|[.!?] )|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, keep: list[str], text: str = "text", least: int = CHUNK_MIN, most: int = CHUNK_MAX) -> DataFrame:
    """``keep`` columns, ``text_sha256`` and ``_recipe``: the ordered list of verified chunk identifiers."""
    docs = docs.select(*keep, whole(text).alias("_text"))
    digests = F.transform(
        chunks(F.col("_text"), least, most),
        lambda c: F.struct(F.xxhash64(c).alias("short"), F.octet_length(c).alias("size"), F.unhex(F.sha2(c, 256)).alias("long")),
    )
    # From here on rows hold digests only; the table is stored because it is read twice.
    stored = written(docs.select(*keep, F.sha2("_text", 256).alias("text_sha256"), digests.alias("_chunks")), "recipes")
    stored, row = numbered(stored)
    places = stored.select(row, F.posexplode("_chunks").alias("place", "_chunk")).select(row, "place", "_chunk.*")
    # One row per distinct chunk; almost every short digest has one.
    known = places.groupBy("short", "size", "long").agg(F.count("*").alias("uses"))
    known = written(known.withColumn("nth", F.row_number().over(W.partitionBy("short").orderBy("size", "long"))), "chunks")
    uses = known.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    identified = joined_with_groups(places, known, ["short", "size", "long"], "uses", uses).select(
        row, F.struct("place", F.struct("short", "nth").alias("id")).alias("_at")
    )
    lists = identified.groupBy(row).agg(F.transform(F.array_sort(F.collect_list("_at")), lambda a: a["id"]).alias("_recipe"))
    empty = F.array().cast("array<struct<short:bigint,nth:int>>")
    return (
        stored.drop("_chunks").join(lists, row, "left").withColumn("_recipe", F.coalesce("_recipe", empty)).drop(row)
    )


def equal_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays.  NULL counts as an empty text, and empty
    texts are equal.  Rows that repeat id and text count each for itself in ``group_size``; of
    them one is kept.  A group whose ids are all NULL keeps one row.
    """
    rows = recipes(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_whole")), ["doc_id"], "_whole")
    rows = written(rows, "recipe-lists")
    same = written(rows.groupBy("_recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "recipe-groups")
    # Rows that repeat the id are told apart by a count, so that exactly one of them is kept.
    once = rows.groupBy("doc_id", "_recipe").agg(F.count("*").alias("_times"), F.first("text_sha256").alias("text_sha256"))
    return joined_with_groups(once, same, ["_recipe"], "group_size", rows.count()).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_nth"),
        "text_sha256",
    ).select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts."""
    rows, row = stably_numbered(docs)
    listed = written(
        recipes(rows.select(F.col(id_col).alias("_id"), F.col(row).alias("_row"), F.col(text).alias("_whole")), ["_id", "_row"], "_whole"),
        "recipe-lists",
    )
    best = listed.groupBy("_recipe").agg(F.max(F.struct(F.col("_id"), F.col("_row"))).alias("_best"))
    stays = fresh_name(rows, "stays")
    kept = best.select(F.col("_best._row").alias(stays))
    return rows.join(kept, rows[row] == kept[stays], "left_semi").drop(row)


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
