"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import io
import string
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written


def whole(col: str | Column) -> Column:
    """The whole text; NULL counts as empty."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; other letters stay, so the number of words cannot change."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    name = f"_{stem}"
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{stem}_{uuid.uuid4().hex[:8]}"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a number per row, and its column's name; for plans that read it once."""
    name = fresh_name(df, "row")
    return df.withColumn(name, F.monotonically_increasing_id()), name


def stably_numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a number per row that is the same each time the rows are read.

    The number is made of the partition and the place in it.  A scan of stored files gives the
    same ones again, also in a task that is run anew.  After a shuffle the places depend on
    which blocks arrive first, so such an input is written to the shared folder before.
    """
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain()
    return numbered(written(df, "rows") if "Exchange" in plan.getvalue() else df)


HEAVY_KEYS = 1000  # keys with more than one in so many of all rows are split


def joined_with_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row of ``groups`` that has their ``key``; no task gets all rows of a large group.

    ``groups`` says how many rows a key has.  A key with more than ``total / HEAVY_KEYS`` rows, of which
    there are at most ``HEAVY_KEYS``, is spread over as many parts as it is times too large; its
    group is copied to each.  Keys are told by a hash for this, and compared themselves in the join.
    """
    limit = max(1000, total // HEAVY_KEYS)
    mark, parts, part = (fresh_name(rows, stem) for stem in ("mark", "parts", "part"))
    heavy = groups.filter(F.col(size) > limit).groupBy(F.xxhash64(*key).alias(mark)).agg(F.ceil(F.max(size) / limit).alias(parts))
    heavy = F.broadcast(heavy)
    at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce(parts, F.lit(1)))
    spread = rows.withColumn(mark, F.xxhash64(*key)).join(heavy, mark, "left").withColumn(part, at).drop(mark, parts)
    copies = groups.withColumn(mark, F.xxhash64(*key)).join(heavy, mark, "left")
    copies = copies.withColumn(part, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(parts, F.lit(1).cast("bigint")) - 1))).drop(mark, parts)
    return spread.join(copies, [*key, part], how).drop(part)
