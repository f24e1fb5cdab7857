"""Removal of word passages that an earlier document holds, by full-text indexes of shards.

A word goes when it lies in ``LENGTH`` consecutive words that also start in a document with a
smaller id.  One index cannot hold the corpus, and searching every document in every shard would grow
with the square of it.  So text is dealt to shards by content: a window's anchor is its smallest
hashed ``GRAM``-word string, equal windows have equal anchors, and neighbouring windows with the same
anchor form a cell.

* An anchor whose windows lie in one document only is done with.
* The different cells of all other anchors go, with their words and the smallest id that has them,
  to the shard of their anchor.  The shard builds an FM-index over them and streams them
  through it; the matching statistics, ``LENGTH`` words at most, tell for every window which
  suffixes start with it, and so the smallest id that has it.
* An anchor with more than ``CROWD`` different cells would overfill a shard.  Its windows are dealt
  one by one, by a digest of their words, and the smallest id of each is a plain minimum.

Rows then meet their cells and lose the windows with a smaller id.  Copies of a cell are
recognised by a 128-bit digest before texts move; windows are told apart by their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm.common import fresh_name, stably_numbered, whole
from tidemark.llm.fm_index import FMIndex

LENGTH, GRAM, CROWD = 50, 16, 1000
SHARD = 500_000  # words in a shard, about
_PIECE = 1 << 20  # windows looked at together
_MIX = np.uint64(0xD6E8FEB86659FD93)
_WORDS = 1_000_000  # hashes of words that a task remembers


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def words_of(text: str) -> list[bytes]:
    """Words are cut at ASCII white space only."""
    return text.encode().split()


def _gram_hashes(words: list[bytes], gram: int) -> np.ndarray:
    """A hash of every ``gram`` neighbouring words."""
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    out, covered, power = h, 1, 0x9E3779B97F4A7C15
    while covered < gram:  # of twice the width, or of what is missing
        more = min(covered, gram - covered)
        out = out[: len(out) - more] * np.uint64(power) + out[more:]
        covered, power = covered + more, power * power % 2**64
    out = out ^ (out >> np.uint64(32))
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def cells(words: list[bytes], length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """``(anchor hash, first window, windows)`` of each cell, in order; together all windows."""
    out = []
    low = np.uint64(2 * _PIECE - 1)
    for at in range(0, len(words) - length + 1, _PIECE):
        h = _gram_hashes(words[at : at + _PIECE + length - 1], gram)
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        span, width = length - gram + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        sizes = np.diff(first, append=len(place))
        out += zip(h[place[first]].view(np.int64).tolist(), (first + at).tolist(), sizes.tolist())
    return out


def _digest(raw: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(raw)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _offsets(words: list[bytes]) -> list[int]:
    """Where each word starts in the words joined by a space; one more for the end."""
    return np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()


_CELLS = "row bigint, doc bigint, anchor bigint, d1 bigint, d2 bigint, starts array<int>, n int"


def _cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("anchor", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("starts", pa.list_(pa.int32())), ("n", pa.int32())])
    for batch in batches:
        out = []
        for row, doc, text in zip(*(batch.column(k).to_pylist() for k in range(2)), batch.column(2)):
            words = words_of(text.as_py())
            if len(words) < LENGTH:
                continue
            raw, at = b" ".join(words), _offsets(words)
            seen: dict[tuple, tuple[list[int], int]] = {}
            for anchor, start, n in cells(words):
                key = (anchor, *_digest(raw[at[start] : at[start + n - 1 + LENGTH] - 1]))
                if key in seen:  # a text that repeats itself gives each of its cells once
                    seen[key][0].append(start)
                else:
                    seen[key] = ([start], n)
            out += [(row, doc, *key, starts, n) for key, (starts, n) in seen.items()]
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted cells of each text."""
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.bool_(), pa.binary()]
    names = ["anchor", "d1", "d2", "doc", "n", "crowded", "words"]
    for batch in batches:
        out, size = [], 0
        for k in range(batch.num_rows):
            words = words_of(batch.column("text")[k].as_py())
            raw, at = b" ".join(words), _offsets(words)
            for w in batch.column("wanted")[k].as_py():
                piece = raw[at[w["start"]] : at[w["start"] + w["n"] - 1 + LENGTH] - 1]
                out.append((w["anchor"], w["d1"], w["d2"], w["doc"], w["n"], w["crowded"], piece))
                size += len(piece)
            if size > 8 * _PIECE:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def smallest_ids(held: list[list[bytes]], docs: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each list of words, the smallest of ``docs`` whose list holds the window, for every window."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(words) for words in held])
    text = np.fromiter((number.setdefault(w, len(number)) for words in held for w in words), np.int64, sizes.sum())
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # A number of its own after each list, so that no match runs across.
    joined = np.insert(text, ends, len(number))
    index = FMIndex(joined, length)
    owner = np.append(np.repeat(np.arange(len(held)), sizes + 1), 0)[index.suffixes]
    found, low, _ = index.matching_statistics(text, starts, ends)
    borders = index.borders(length)
    least = np.minimum.reduceat(docs[owner], borders[:-1])
    whole_window = found == length
    out = np.where(whole_window, least[np.searchsorted(borders, low, "right") - 1], np.iinfo(np.int64).max)
    return [out[s : e - length + 1] for s, e in zip(starts, ends)]


_RUN = pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32()), ("doc", pa.int64())]))


def _runs(least: np.ndarray) -> list[dict]:
    """Neighbouring windows with the same smallest id."""
    first = np.flatnonzero(np.r_[True, np.diff(least) != 0])
    sizes = np.diff(first, append=len(least))
    return [{"lo": lo, "n": n, "doc": doc} for lo, n, doc in zip(first.tolist(), sizes.tolist(), least[first].tolist())]


def _search(shard: pa.Table) -> pa.Table:
    """All cells of a shard streamed through the index over them."""
    docs = shard.column("doc").to_numpy()
    least = smallest_ids([w.split() for w in shard.column("words").to_pylist()], docs)
    runs = pa.array([_runs(x) for x in least], _RUN)
    return shard.select(["anchor", "d1", "d2"]).append_column("runs", runs)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of crowded cells, by the digest of its words."""
    names = ["anchor", "d1", "d2", "at", "w1", "w2", "doc"]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("anchor", "d1", "d2", "n", "doc", "words")]
        for from_ in range(0, batch.num_rows, 1000):
            out = []
            for anchor, d1, d2, n, doc, raw in zip(*(c[from_ : from_ + 1000] for c in columns)):
                at = _offsets(raw.split())
                out += [(anchor, d1, d2, k, *_digest(raw[at[k] : at[k + LENGTH] - 1]), doc) for k in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)


_CELL = ["anchor", "d1", "d2"]
_RESULT = "anchor bigint, d1 bigint, d2 bigint, runs array<struct<lo: int, n: int, doc: bigint>>"


def _crowded_runs(crowd: DataFrame) -> DataFrame:
    windows = written(crowd.mapInArrow(_windows, "anchor bigint, d1 bigint, d2 bigint, at bigint, w1 bigint, w2 bigint, doc bigint"), "windows")
    least = windows.groupBy("w1", "w2").agg(F.min("doc").alias("doc"))
    told = windows.drop("doc").join(least, ["w1", "w2"])
    # A cell has at most LENGTH - GRAM + 1 windows.
    return told.groupBy(*_CELL).agg(F.collect_list(F.struct(F.col("at").cast("int").alias("lo"), F.lit(1).alias("n"), "doc")).alias("runs"))


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``(row, lo, hi)``: word spans that a smaller ``doc`` holds, for the columns ``row``, ``doc`` and ``text``.

    Spans of one row may overlap; their union is what is repeated.
    """
    ready = rows.filter("doc is not null").select("row", "doc", "text")
    found = written(ready.mapInArrow(_cell_rows, _CELLS), "passage-cells")
    known = found.groupBy(*_CELL).agg(
        F.min("doc").alias("doc"), F.max("doc").alias("last"), F.min(F.struct("row", F.col("starts")[0].alias("start"), "n")).alias("at")
    )
    shared = known.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("last").alias("most"), F.count("*").alias("kinds"))
    shared = shared.filter("least < most").select("anchor", "kinds")
    known = written(known.join(shared, "anchor"), "shared-cells")
    size = known.agg(F.coalesce(F.sum(F.col("at.n") - 1 + LENGTH), F.lit(0))).first()[0]
    shards = 1 + size // SHARD
    wanted = known.select(
        F.col("at.row").alias("row"),
        F.struct(*_CELL, "doc", F.col("at.start").alias("start"), F.col("at.n").alias("n"), (F.col("kinds") > CROWD).alias("crowded")).alias("w"),
    )
    texts = rows.select("row", "text").join(wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")), "row")
    cut = written(texts.mapInArrow(_cut, "anchor bigint, d1 bigint, d2 bigint, doc bigint, n int, crowded boolean, words binary"), "passage-words")
    dealt = cut.filter("not crowded").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    searched = dealt.groupBy("shard").applyInArrow(_search, _RESULT)
    runs = written(searched.unionByName(_crowded_runs(cut.filter("crowded"))), "passage-runs")
    hits = found.join(runs, _CELL).select("row", "starts", F.expr("filter(runs, r -> r.doc < doc)").alias("runs")).filter(F.size("runs") > 0)
    each = hits.select("row", F.explode("starts").alias("start"), "runs").select("row", "start", F.inline("runs"))
    return each.select("row", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("lo") + F.col("n") - 1 + LENGTH).alias("hi"))


def _kept(words: list[bytes], spans) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words outside the spans, and the removed runs."""
    if spans is None:
        return words, []
    edge = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        edge[s["lo"]] += 1
        edge[s["hi"]] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    border = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    return [w for w, g in zip(words, gone.tolist()) if not g], list(zip(border[::2].tolist(), border[1::2].tolist()))


def with_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the repeated word spans of each row, or NULL, and the name of their column."""
    column = fresh_name(docs, "spans")
    docs, row = stably_numbered(docs)
    spans = repeated_windows(docs.select(F.col(row).alias("row"), F.col(id_col).cast("bigint").alias("doc"), whole(text).alias("text")))
    per_row = spans.groupBy("row").agg(F.collect_set(F.struct("lo", "hi")).alias(column))
    return docs.join(per_row.withColumnRenamed("row", row), row, "left").drop(row), column


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the repeated words; a text that loses any is its other words joined by a space."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([b" ".join(_kept(words_of(t), s)[0]).decode() for t, s in zip(texts, spans)], dtype=object)

    found, spans = with_spans(docs, id_col, text)
    return found.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(cut(whole(text), spans))).select(*docs.columns)


def removal_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, n_spans, repeated``.

    NULL and empty texts have no words; texts shorter than the window keep theirs.  A row without
    an id is neither smaller nor larger than another.  Rows with the same id do not shorten each other.
    """

    @F.pandas_udf("n_words bigint, n_removed bigint, kept_sha256 string, n_spans bigint")
    def report(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(texts, spans):
            words = words_of(t)
            kept, runs = _kept(words, s)
            out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), len(runs)))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "n_spans"])

    found, spans = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    return found.select("doc_id", report(whole("text"), spans).alias("r")).select("doc_id", "r.*", (F.col("r.n_removed") > 0).alias("repeated"))
