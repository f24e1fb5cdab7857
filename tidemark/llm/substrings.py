"""Removal of long repeated passages by suffix arrays, over texts in many tasks.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts elsewhere.  No single
suffix array can hold the corpus, so windows of that length are first brought together by what
they contain: the window's anchor is its smallest hashed ``GRAM``-byte string, so equal windows
have equal anchors.  Neighbouring windows with the same anchor form a cell.

* An anchor that occurs once has no repeated window.
* A cell that occurs twice with the same bytes is repeated as a whole.
* The other cells of an anchor are written one after another, together with those of other
  anchors, and suffix-sorted: neighbours in suffix order with ``LENGTH`` common bytes are repeated.
* An anchor with more than ``CROWD`` different cells would need one large sort.  Its cells are cut
  into parts that hold more of their bytes in common, and the same is done with those: parts
  that occur twice are repeated, few kinds are sorted, many are cut again, at last into windows.

All four are exact but for collisions of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm.common import fresh_name, stably_numbered, whole
from tidemark.llm.suffixes import suffix_ranks

LENGTH, GRAM, CROWD = 400, 32, 256
WIDTHS = (46, 6, 1)  # windows in a part of a crowded cell, from round to round
_PIECE = 1 << 20  # window starts looked at together
_SORT = 1 << 18  # bytes suffix-sorted together, and one anchor more
_P, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram``-byte string; ``gram`` is a power of two."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    power, width = _P, 1
    while width < gram:
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % 2**64, 2 * width
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def cells(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int]]:
    """``(anchor hash, first window, windows)`` of each cell, in order; together all windows."""
    raw = np.frombuffer(data, np.uint8)
    low = np.uint64(2 * _PIECE - 1)
    for at in range(0, len(raw) - length + 1, _PIECE):
        part = raw[at : at + _PIECE + length - 1]
        h = _gram_hashes(part, gram)
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        span, width = length - gram + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        anchor = (least & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[first, len(anchor)])
        yield from zip(h[anchor[first]].view(np.int64).tolist(), (first + at).tolist(), sizes.tolist())


def _cell_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["anchor", "d1", "d2", "row", "starts", "n"]
    for batch in batches:
        out = []
        for row, text in zip(batch["row"], batch["text"]):
            data = text.encode()
            seen: dict[tuple[int, bytes], tuple[list[int], int]] = {}
            for anchor, start, n in cells(data):
                key = (anchor, xxhash.xxh3_128_digest(data[start : start + n - 1 + LENGTH]))
                if key in seen:  # a text that repeats itself gives each of its cells once
                    seen[key][0].append(start)
                else:
                    seen[key] = ([start], n)
            out += [
                (anchor, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), row, starts, n)
                for (anchor, d), (starts, n) in seen.items()
            ]
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the wanted cells of each text."""
    names = ["anchor", "row", "start", "n", "once", "crowded", "middle", "bytes"]
    for batch in batches:
        out, size = [], 0
        for row, text, wanted in zip(batch["row"], batch["text"], batch["wanted"]):
            data = text.encode()
            for w in wanted:
                start, n = w["start"], w["n"]
                piece = data[start : start + n - 1 + LENGTH]
                # Where the anchor lies: the leftmost place with its hash.
                found = _gram_hashes(np.frombuffer(piece, np.uint8), GRAM).view(np.int64) == w["anchor"] if w["crowded"] else None
                middle = 0 if found is None else int(found.argmax())
                out.append((w["anchor"], row, start, n, w["once"], w["crowded"], middle, piece))
                size += n + LENGTH
            if size > 8 * _PIECE:
                yield pd.DataFrame(out, columns=names)
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)


def _runs(where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of neighbouring numbers."""
    first = np.flatnonzero(np.r_[True, where[1:] != where[:-1] + 1])
    return where[first], where[np.r_[first[1:] - 1, len(where) - 1]]


def _sort_cells(held: pd.DataFrame) -> pd.DataFrame:
    """Spans of repeated windows in cells that occur once."""
    data = np.frombuffer(b"".join(held["bytes"]), np.uint8)
    sizes = held["bytes"].map(len).to_numpy()
    base = np.cumsum(sizes) - sizes
    n = held["n"].to_numpy()
    cell = np.repeat(np.arange(len(held)), sizes)
    starts_window = (np.arange(len(data)) - base[cell]) < n[cell]
    order, rank = suffix_ranks(data, LENGTH, starts_window)
    order = order[starts_window[order]]
    same = rank[order[:-1]] == rank[order[1:]]
    hit = np.zeros(len(data), bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    hit &= held["once"].to_numpy()[cell]
    where = np.flatnonzero(hit)
    if not len(where):
        return pd.DataFrame({"row": [], "lo": [], "hi": []}, dtype=np.int64)
    lo, hi = _runs(where + cell[where])  # one apart at cell borders, so that runs end there
    of = cell[where[np.searchsorted(where + cell[where], lo)]]
    shift = held["start"].to_numpy()[of] - base[of] - of
    return pd.DataFrame({"row": held["row"].to_numpy()[of], "lo": lo + shift, "hi": hi + shift + LENGTH})


def _sort_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if not len(batch):
            continue
        at = 0
        sizes = batch["bytes"].map(len).to_numpy()
        anchors = batch["anchor"].to_numpy()
        for k in range(len(batch)):
            new = anchors[k] != (anchors[k - 1] if k > at else held[-1]["anchor"].iloc[-1] if held else None)
            if new and size >= _SORT:
                yield _sort_cells(pd.concat([*held, batch.iloc[at:k]], ignore_index=True))
                held, size, at = [], 0, k
            size += sizes[k]
        if at < len(batch):
            held.append(batch.iloc[at:])
    if held:
        yield _sort_cells(pd.concat(held, ignore_index=True))


def _narrower(width: int):
    """Splits crowded cells where their windows lie around the anchor, ``width`` places to a part.

    The windows of a part all hold the same bytes around the anchor, but for ``width - 1``; those
    bytes make the part's own anchor.  Equal windows lie equally around equal anchors, so they
    meet in the same part; others are told apart by more and more of their bytes.
    """

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["anchor", "d1", "d2", "row", "start", "n", "once", "middle", "bytes"]
        for batch in batches:
            out = []
            for row, start, n, once, middle, data in zip(batch["row"], batch["start"], batch["n"], batch["once"], batch["middle"], batch["bytes"]):
                k = 0
                while k < n:
                    part = (middle - k) // width
                    to = min(n, middle - part * width + 1)  # the last window of the part, and one more
                    core = data[middle - part * width : middle + GRAM + max(0, LENGTH - GRAM - (part * width + width - 1))]
                    piece = data[k : to - 1 + LENGTH]
                    d = xxhash.xxh3_128_digest(piece)
                    anchor = int.from_bytes(xxhash.xxh3_64_digest(core + b"%d/%d" % (part, width)), "little", signed=True)
                    out.append((anchor, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), row, start + k, to - k, once, middle - k, piece))
                    k = to
                if len(out) > 10_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return narrow


_SPANS = "row bigint, lo int, hi int"


def _sorted_spans(cells_: DataFrame) -> DataFrame:
    return cells_.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_sort_batches, _SPANS)


def _crowded_spans(crowd: DataFrame) -> list[DataFrame]:
    """Spans of repeated windows in cells whose anchor has too many kinds to sort together."""
    out = []
    for width in WIDTHS:
        if crowd.isEmpty():
            break
        schema = "anchor bigint, d1 bigint, d2 bigint, row bigint, start int, n int, once boolean, middle int, bytes binary"
        parts = written(crowd.mapInPandas(_narrower(width), schema), "narrower-cells")
        cell = ["anchor", "d1", "d2"]
        counts = parts.groupBy(*cell).agg(F.count("*").alias("occurs"), F.min(F.struct("row", "start")).alias("at"))
        kinds = counts.groupBy("anchor").agg(F.count("*").alias("kinds"))
        told = parts.join(counts, cell).join(kinds, "anchor")
        several = F.col("occurs") > 1
        out.append(told.filter(several & F.col("once")).select("row", F.col("start").alias("lo"), (F.col("start") + F.col("n") - 1 + LENGTH).alias("hi")))
        # One of each kind goes on; a kind that repeats is only there to be compared with.
        each = told.filter(~several | (F.struct("row", "start") == F.col("at"))).withColumn("once", F.col("once") & ~several)
        out.append(_sorted_spans(each.filter((F.col("kinds") > 1) & (F.col("kinds") <= CROWD))))
        crowd = each.filter(F.col("kinds") > CROWD)
    return out


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``(row, lo, hi)``: byte spans made of repeated windows, for the columns ``row`` and ``text``.

    Spans of one row may overlap; their union is what is repeated.
    """
    found = written(rows.mapInPandas(_cell_rows, "anchor bigint, d1 bigint, d2 bigint, row bigint, starts array<int>, n int"), "cells")
    cell = ["anchor", "d1", "d2"]
    known = found.groupBy(*cell).agg(
        F.sum(F.size("starts")).alias("occurs"), F.min(F.struct("row", F.col("starts")[0].alias("start"), "n")).alias("at")
    )
    several = known.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("occurs").alias("most"))
    several = several.filter((F.col("kinds") > 1) | (F.col("most") > 1))
    # What is left is the repeated part of the corpus.
    known = written(known.join(several.select("anchor", "kinds"), "anchor"), "repeated-cells")
    whole_cells = (
        found.join(known.filter("occurs > 1").select(*cell), cell)
        .select("row", "n", F.explode("starts").alias("lo"))
        .select("row", "lo", (F.col("lo") + F.col("n") - 1 + LENGTH).alias("hi"))
    )
    # Groups in which every cell is repeated as a whole need no comparison.
    open_ = known.filter("kinds > 1")
    undecided = open_.groupBy("anchor").agg(F.min("occurs").alias("least")).filter("least = 1").select("anchor")
    wanted = open_.join(undecided, "anchor").select(
        F.col("at.row").alias("row"),
        F.struct("anchor", F.col("at.start").alias("start"), F.col("at.n").alias("n"), (F.col("occurs") == 1).alias("once"), (F.col("kinds") > CROWD).alias("crowded")).alias("w"),
    )
    texts = rows.join(wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")), "row")
    cut = written(
        texts.mapInPandas(_cut, "anchor bigint, row bigint, start int, n int, once boolean, crowded boolean, middle int, bytes binary"), "cell-bytes"
    )
    spans = [_sorted_spans(cut.filter(~F.col("crowded"))), *_crowded_spans(cut.filter("crowded"))]
    return reduce(DataFrame.unionByName, spans, whole_cells)


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping and touching spans as maximal ones."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for lo, hi in spans:
        out.append(data[at:lo])
        at = hi
    return b"".join([*out, data[at:]])


def with_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the repeated byte spans of each row, or NULL, and the name of their column."""
    column = fresh_name(docs, "spans")
    docs, row = stably_numbered(docs)
    spans = repeated_spans(docs.select(F.col(row).alias("row"), whole(text).alias("text")))
    per_row = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias(column))
    return docs.join(per_row.withColumnRenamed("row", row), row, "left"), column


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text; bytes that are no text any more become U+FFFD."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [t if s is None else _kept(t.encode(), merged((x["lo"], x["hi"]) for x in s)).decode(errors="replace") for t, s in zip(texts, spans)], dtype=object
        )

    found, spans = with_spans(docs, text)
    return found.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(cut(whole(text), spans))).select(*docs.columns)


def removal_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeated``.

    NULL and empty texts have no bytes, and texts shorter than the window have no repeats.
    Repeated rows are different places, so what they share goes from each of them.
    """

    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    def report(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(texts, spans):
            data = t.encode()
            runs = [] if s is None else merged((x["lo"], x["hi"]) for x in s)
            out.append((len(data), sum(hi - lo for lo, hi in runs), len(runs), hashlib.sha256(_kept(data, runs)).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found, spans = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    return found.select("doc_id", report(whole("text"), spans).alias("r")).select("doc_id", "r.*", (F.col("r.n_removed") > 0).alias("repeated"))
