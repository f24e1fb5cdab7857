"""Connected components of a graph given by its links, with no node's links in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written


def stars(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has a smaller one in its component; roots are left out.

    Alternates two steps until nothing changes: each node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows.  Both are a minimum per node, combined before
    the shuffle, and a join back, which AQE splits at hot nodes; neighbours are never gathered.
    The rounds grow with the logarithm of the longest path.  Every round is written to the
    shared folder, so its lineage is cut.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    links = written(links.select(hi.alias("u"), lo.alias("v")).filter("u > v").distinct(), "links")
    mark = _mark(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(links: DataFrame) -> tuple:
    """Tells two sets of links apart."""
    mixed = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(mixed), F.lit(0)), F.sum(F.pmod(mixed, F.lit(1 << 31)))).first())
