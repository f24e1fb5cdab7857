"""Best-fit packing of documents into training sequences of several permitted lengths.

Best-fit decreasing looks at lengths only, and lengths are whole numbers up to the largest
capacity.  So the packing is worked out on the histogram of lengths, whose size is bounded by
that capacity and not by the data: pieces of one length are placed as runs of equal bins.
Documents then take their places by their rank among the pieces of their length.  The result is
one global packing, and no task sees more than its own pieces.

A new bin gets the permitted size that costs least per word, given what is left to fill it
with, and at the end every bin shrinks to the smallest permitted size that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm.common import whole

CAPACITIES = (512, 1024, 2048)
# Cost of a sequence in words: its length, a fixed share, and attention, which grows with the square.
PER_SEQUENCE, ATTENTION = 16, 1 / 32_768


def sequence_cost(capacity: int) -> float:
    return capacity + PER_SEQUENCE + ATTENTION * capacity**2


def word_count(text: str | Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")

_RANKS = 1 << 40  # more than there are pieces of one length


@dataclass
class _Bins:
    """Bins of equal content, numbered one after another."""

    first: int
    count: int
    size: int
    used: int


@dataclass
class Plan:
    """Runs of equal placements and the bins they fill.

    Run i places the pieces of ``length`` with ranks from ``rank`` on: ``each`` to a bin, the
    first bin being ``bin``, at ``offset`` in it.
    """

    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)  # length, rank, each, bin, offset, count
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)  # first, count, used, size


def _fill(length: int, size: int, left: dict[int, int], lengths: list[int]) -> int:
    """Words one new bin would hold: the largest remaining pieces that fit, one after another."""
    used, at = length, None
    while True:
        room = size - used if at is None else min(size - used, at - 1)
        i = bisect_left(lengths, room + 1) - 1
        if i < 0:
            return used
        at = lengths[i]
        have = left[at] - (at == length)
        used += at * min(have, (size - used) // at)


def best_fit(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = sequence_cost) -> Plan:
    """Packs ``histogram[length]`` pieces of each length, all between 1 and the largest capacity."""
    plan, left = Plan(), dict(histogram)
    sizes, lengths = sorted(capacities), sorted(histogram)
    open_: list[tuple[int, int]] = []  # (room left, bins), smallest room first
    groups: list[_Bins] = []
    bins = 0

    def put(group: _Bins) -> None:
        groups.append(group)
        if group.used < group.size:
            insort(open_, (group.size - group.used, len(groups) - 1))

    for length in sorted(histogram, reverse=True):
        rank = 0
        while left[length]:
            i = bisect_left(open_, (length, -1))
            if i < len(open_):
                group = groups[open_.pop(i)[1]]
            else:
                size = min(
                    (s for s in sizes if s >= length), key=lambda s: (cost(s) / _fill(length, s, left, lengths), s)
                )
                each = size // length
                group = _Bins(bins, -(-left[length] // each), size, 0)
                bins += group.count
            # A bin that was the tightest stays the tightest until the length no longer fits.
            each = (group.size - group.used) // length
            full, rest = min(group.count, left[length] // each), left[length] % each
            at, untouched = group.first, group.count
            for count, n in ((full, each), (1 if full < group.count and rest else 0, rest)):
                if count:
                    plan.runs.append((length, rank, n, at, group.used, count * n))
                    put(_Bins(at, count, group.size, group.used + n * length))
                    rank, at, untouched = rank + count * n, at + count, untouched - count
                    left[length] -= count * n
            if untouched:
                put(_Bins(at, untouched, group.size, group.used))
        lengths.pop()
    # A group that received more was replaced by a later one that starts at the same bin.
    last: dict[int, _Bins] = {}
    for group in groups:
        last[group.first] = group
    for first in sorted(last):
        group = last[first]
        plan.bins.append((first, group.count, group.used, next(s for s in sizes if s >= group.used)))
    return plan


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = sequence_cost) -> DataFrame:
    """One row per piece: ``doc_id, piece, start_word, n_words, bin_id, bin_offset, bin_size``.

    A document longer than the largest capacity is cut into pieces of that length and a rest;
    no word is lost.  ``length`` counts a document's words, by default those between white space.
    A document without words gives one piece of no words that needs no bin.  Ties between equal
    lengths go by the storage order of the pieces; repeated rows are packed each for itself.
    """
    most = max(capacities)
    words = word_count(text) if length is None else F.coalesce(length, F.lit(0)).cast("bigint")
    sized = docs.select(F.col(id_col).alias("doc_id"), words.alias("_n"))
    last = F.greatest(F.ceil(F.col("_n") / most) - 1, F.lit(0)).cast("bigint")
    pieces = sized.select("doc_id", "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    pieces = pieces.select(
        "doc_id",
        "piece",
        (F.col("piece") * most).alias("start_word"),
        F.least(F.col("_n") - F.col("piece") * most, F.lit(most).cast("bigint")).alias("n_words"),
        F.spark_partition_id().alias("_part"),
    )
    pieces = written(pieces, "pieces")
    counts = written(pieces.groupBy("_part", "n_words").agg(F.count("*").alias("_count")), "piece-counts")
    histogram = {r["n_words"]: r["n"] for r in counts.filter("n_words > 0").groupBy("n_words").agg(F.sum("_count").alias("n")).collect()}
    plan = best_fit(histogram, capacities, cost)
    # Rank of a piece among all pieces of its length: those in earlier partitions, then its own.
    # A window over the parts of one length holds one row per partition.
    earlier = W.partitionBy("n_words").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", "n_words", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("_part", "n_words").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("_own", own).join(offsets, ["_part", "n_words"]).withColumn("_rank", F.col("_before") + F.col("_own"))
    placed = ranked.withColumn("_at", place(plan)("n_words", "_rank"))
    return placed.select("doc_id", "piece", "start_word", "n_words", F.col("_at.bin_id").alias("bin_id"), F.col("_at.bin_offset").alias("bin_offset"), F.col("_at.bin_size").alias("bin_size"))


def place(plan: Plan):
    """The place of a piece, from its length and its rank among the pieces of that length.

    The plan's tables are bounded by the largest capacity, not by the data.
    """
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 6)
    bins = np.array(plan.bins, np.int64).reshape(-1, 4)
    starts = runs[:, 0] * _RANKS + runs[:, 1]  # ascending, as the runs are sorted

    @F.pandas_udf("bin_id bigint, bin_offset bigint, bin_size bigint")
    def udf(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        length, rank = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        out = pd.DataFrame({"bin_id": pd.NA, "bin_offset": pd.NA, "bin_size": pd.NA}, index=lengths.index, dtype="Int64")
        some = length > 0
        if some.any():
            length, rank = length[some], rank[some]
            run = runs[np.searchsorted(starts, length * _RANKS + rank, side="right") - 1]
            nth = rank - run[:, 1]
            number = run[:, 3] + nth // run[:, 2]
            out.loc[some, "bin_id"] = number
            out.loc[some, "bin_offset"] = run[:, 4] + nth % run[:, 2] * length
            out.loc[some, "bin_size"] = bins[np.searchsorted(bins[:, 0], number, side="right") - 1, 3]
        return out

    return udf
