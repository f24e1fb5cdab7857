"""Alignment of two tokenizers' tokens by the bytes they cover.

Tokenizer A is a byte-level BPE run over a space and the text, tokenizer B a piece BPE run over
the text, before which it puts the space itself.  The places where a token of both ends cut the two
id lists into groups; inside a group every pair of tokens whose bytes overlap is a link.

``align`` finds the cuts by intersecting the key sets of two dictionaries from cumulative end to
token index; ``Aligner`` does the same with arrays for many pieces of text at once.  A text is first
taken apart before each space that follows a non-space: neither tokenizer has a token across that
place, so it is always a cut, and each piece can be aligned by itself.  Pieces recur, so a task
remembers those it has seen.

How many documents hold a pair of ids is a count over the corpus.  Documents are handled in blocks
of a few MB; a block knows each of its pairs once, so what is shuffled is one row per block and pair,
never one per token.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidemark.functions.scratch import written
from tidemark.llm.common import numbered

TOKENIZERS = "/opt/tokenizers"
BLOCK = 1 << 22  # characters of text in a block
_PIECES, _LINKS = 400_000, 6_000_000  # what a task remembers at most
_JOINED = 1 << 16  # characters encoded in one go
_LOW = 32  # bits of B's id in a pair


def align(a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """``(first a, end a, first b, end b)`` of each group of two token lists over the same bytes."""
    ends_a = {end: k for k, end in enumerate(accumulate(a_sizes), 1)}
    ends_b = {end: k for k, end in enumerate(accumulate(b_sizes), 1)}
    out, i, j = [], 0, 0
    for cut in sorted(ends_a.keys() & ends_b.keys()):
        to_i, to_j = ends_a[cut], ends_b[cut]
        out.append((i, to_i, j, to_j))
        i, j = to_i, to_j
    return out


def links(a_sizes: list[int], b_sizes: list[int]) -> list[tuple[int, int]]:
    """Index pairs of the tokens of one group whose bytes overlap."""
    if len(a_sizes) == 1 or len(b_sizes) == 1:
        return [(i, j) for i in range(len(a_sizes)) for j in range(len(b_sizes))]
    out, i, j, end_a, end_b = [], 0, 0, a_sizes[0], b_sizes[0]
    while True:
        out.append((i, j))
        if end_a == end_b and i + 1 == len(a_sizes):
            return out
        if end_a < end_b:
            i += 1
            end_a += a_sizes[i]
        else:
            j += 1
            end_b += b_sizes[j]


def byte_level_sizes(path: str) -> np.ndarray:
    """Bytes of each token of a byte-level vocabulary, in which one character stands for one byte."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        sizes[i] = len(token)
    return sizes


class Aligner:
    """Aligns texts, remembering the pieces it has seen."""

    _BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
    _UNUSUAL = re.compile(r"\s ")

    def __init__(self, folder: str = TOKENIZERS):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
        self.a.encode_special_tokens = True
        self.a_size = byte_level_sizes(f"{folder}/byte_bpe_50k.json")
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # Pieces are independent only if no token goes on after a space.
        assert not any(re.search("[^▁]▁", p) for p in pieces)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Every id as printed before another of its side, the other side, another group, another piece.
        self.ids = max(len(self.a_size), len(self.b_size))
        self.shown = [f"{i}{after}" for after in ",|;\n" for i in range(self.ids)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str | None] = []  # printed groups of a piece, None where the bytes differ
        self.numbers = array("q")  # tokens of A, of B, groups, links of a piece, one after another
        self.pairs, self.ends = array("q"), array("q", [0])

    def pieces(self, text: str) -> list[str]:
        """The pieces of a space and ``text``, without the space each starts with."""
        text = " " + text
        if self._UNUSUAL.search(text):
            return [p[1:] for p in self._BEFORE_SPACE.split(text)]
        return text[1:].split(" ")

    def learn(self, pieces: list[str]) -> None:
        """Aligns the pieces and remembers them."""
        # A piece that ends in white space, as at the end of a text, must not meet another one.
        joined = [p for p in pieces if p and not p[-1].isspace()]
        part = np.cumsum([len(p) for p in joined]) // _JOINED
        for some in np.split(np.arange(len(joined)), np.flatnonzero(np.diff(part)) + 1) if joined else []:
            self._learn_together(joined[some[0] : some[-1] + 1])
        for piece in pieces:
            if not piece or piece[-1].isspace():
                self._learn_alone(piece)

    def _learn_together(self, pieces: list[str]) -> None:
        """Encodes the pieces in one go and tells them apart by their sizes, all of them at once."""
        joined = " " + " ".join(pieces)
        b = self.b.encode(joined[1:])
        if b"".join(map(self.b_bytes.__getitem__, b)) != joined.encode():
            for piece in pieces:
                self._learn_alone(piece)
            return
        a = np.array(self.a.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts, a_cut, b_cut = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        # Two tokens overlap where nothing ends between: one pair for each end of either.
        ends = np.union1d(a_ends, b_ends)
        pairs = a[np.searchsorted(a_ends, ends)] << _LOW | b[np.searchsorted(b_ends, ends)]
        to = np.cumsum([1 + len(p.encode()) for p in pieces])
        upto = np.stack([np.searchsorted(x, to) + 1 for x in (a_ends, b_ends, cuts, ends)], axis=1)
        # Tokens in the order they are printed, each with what follows it.
        a_after, b_after = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_after[a_cut], b_after[b_cut], b_after[upto[:, 1] - 1] = 1, 2, 3
        a_place = np.arange(len(a)) + np.r_[0, b_cut + 1][np.searchsorted(a_cut, np.arange(len(a)))]
        b_place = np.arange(len(b)) + (a_cut + 1)[np.searchsorted(b_cut, np.arange(len(b)))]
        shown = np.empty(len(a) + len(b), np.int64)
        shown[a_place], shown[b_place] = a_after * self.ids + a, b_after * self.ids + b
        printed = "".join(map(self.shown.__getitem__, shown.tolist()))[:-1].split("\n")
        first = len(self.groups)
        self.known.update(zip(pieces, range(first, first + len(pieces))))
        self.groups.extend(printed)
        self.ends.frombytes((len(self.pairs) + upto[:, 3]).tobytes())
        self.pairs.frombytes(pairs.tobytes())
        self.numbers.frombytes(np.diff(upto, axis=0, prepend=0).tobytes())

    def _learn_alone(self, piece: str) -> None:
        # B puts a space before a text, but none before an empty one.
        b = self.b.encode(piece) if piece else [self.b.piece_to_id("▁")]
        if b"".join(map(self.b_bytes.__getitem__, b)) == (" " + piece).encode():
            a = self.a.encode_batch_fast([" " + piece], add_special_tokens=False)[0].ids
            self._add(piece, a, self.a_size[a].tolist(), b, self.b_size[b].tolist())
        else:
            self._add(piece, [], [], [], [], differs=True)

    def _add(self, piece: str, a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int], differs: bool = False) -> None:
        found = align(a, a_sizes, b, b_sizes)
        printed, before = [], len(self.pairs)
        for i, to_i, j, to_j in found:
            if to_i - i == 1 == to_j - j:
                self.pairs.append(a[i] << _LOW | b[j])
                printed.append(f"{a[i]}|{b[j]}")
                continue
            self.pairs.extend(a[i + x] << _LOW | b[j + y] for x, y in links(a_sizes[i:to_i], b_sizes[j:to_j]))
            printed.append(f"{','.join(map(str, a[i:to_i]))}|{','.join(map(str, b[j:to_j]))}")
        self.known[piece] = len(self.groups)
        self.groups.append(None if differs else ";".join(printed))
        self.ends.append(len(self.pairs))
        self.numbers.extend((len(a), len(b), len(found), len(self.pairs) - before))

    def look_up(self, texts: list[str | None]) -> list[list[int]]:
        """The numbers of the pieces of each text; none for a text without tokens."""
        taken = [self.pieces(t) if t else [] for t in texts]
        found = [list(map(self.known.get, p)) for p in taken]
        missing = dict.fromkeys(p for pieces, ids in zip(taken, found) if None in ids for p, i in zip(pieces, ids) if i is None)
        if missing:
            self.learn(list(missing))
            found = [list(map(self.known.__getitem__, p)) if None in ids else ids for p, ids in zip(taken, found)]
        if None in self.groups:
            found = [[] if any(self.groups[i] is None for i in ids) else ids for ids in found]
        return found

    def trim(self) -> None:
        if len(self.known) > _PIECES or len(self.pairs) > _LINKS:
            self.forget()


_aligners: dict[str, Aligner] = {}


def _aligner(folder: str) -> Aligner:
    """The aligner of this worker process."""
    if folder not in _aligners:
        _aligners[folder] = Aligner(folder)
    return _aligners[folder]


def _parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of neighbouring rows, about ``most`` characters at a time, at least one row."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        at, size, texts = 0, 0, []
        for k in range(len(column)):
            texts.append(column[k].as_py())
            size += len(texts[-1] or "")
            if size >= most:
                yield ids.slice(at, len(texts)), texts
                at, size, texts = k + 1, 0, []
        if texts:
            yield ids.slice(at, len(texts)), texts


def _document_pairs(aligner: Aligner, doc: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair and number of links, sorted by document and pair."""
    key, times = np.unique(doc << 32 | piece, return_counts=True)
    doc, piece = key >> 32, key & 0xFFFFFFFF
    ends, pairs = np.array(aligner.ends, np.int64), np.array(aligner.pairs, np.int64)
    sizes = ends[piece + 1] - ends[piece]
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(ends[piece], sizes)
    doc, pair, times = np.repeat(doc, sizes), pairs[place], np.repeat(times, sizes)
    order = np.lexsort((pair, doc))
    doc, pair, times = doc[order], pair[order], times[order]
    first = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
    return doc[first], pair[first], np.add.reduceat(times, first) if len(first) else times


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _packed(doc: np.ndarray, at: np.ndarray, times: np.ndarray) -> bytes:
    """Documents, places and counts as bytes; sorted numbers are kept as small steps."""
    step = np.diff(at, prepend=0).astype(np.int32)
    body = np.diff(doc, prepend=0).astype(np.int32).tobytes() + step.tobytes() + times.astype(np.int32).tobytes()
    # Bytes of the same weight side by side: most are zero.
    return zstandard.ZstdCompressor(level=1).compress(np.frombuffer(body, np.uint8).reshape(-1, 4).T.tobytes() if body else b"")


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    numbers = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.int32).ravel().astype(np.int64)
    doc, step, times = numbers.reshape(3, -1)
    return np.cumsum(doc), np.cumsum(step), times


def _block_maker(folder: str, block: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(folder)
        for ids, texts in _parts(batches, block):
            aligner.trim()
            found = aligner.look_up(texts)
            sizes = np.array([len(x) for x in found])
            piece = np.fromiter(chain.from_iterable(found), np.int64, sizes.sum())
            doc, pair, times = _document_pairs(aligner, np.repeat(np.arange(len(found)), sizes), piece)
            distinct, at, docs = np.unique(pair, return_inverse=True, return_counts=True)
            sums = np.cumsum(np.r_[np.zeros((1, 4), np.int64), np.array(aligner.numbers, np.int64).reshape(-1, 4)[piece]], axis=0)
            totals = sums[np.cumsum(sizes)] - sums[np.cumsum(sizes) - sizes]
            shas = [hashlib.sha256(";".join([aligner.groups[i] for i in x]).encode()).hexdigest() if x else "" for x in found]
            per_doc = pa.StructArray.from_arrays(
                [ids, *(pa.array(totals[:, k]) for k in range(4)), pa.array(shas, pa.string())], ["doc_id", *_NUMBERS, "groups_sha256"]
            )
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [whole(per_doc), whole(pa.array(distinct)), whole(pa.array(docs.astype(np.int64))), pa.array([_packed(doc, at, times)], pa.binary())],
                ["per_doc", "pairs", "docs", "entries"],
            )

    return blocks


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs put back on the documents of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            per_doc = batch.column("per_doc")[k].values
            counts = batch.column("counts")[k]
            best, total = np.zeros(len(per_doc), np.int64), np.zeros(len(per_doc), np.int64)
            if counts.is_valid:
                pairs = batch.column("pairs")[k].values.to_numpy()
                told = counts.values
                at = np.searchsorted(pairs, told.field("pair").to_numpy())
                n, is_best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
                n[at], is_best[at] = told.field("n").to_numpy(), told.field("best").to_numpy(zero_copy_only=False)
                doc, at, times = _unpacked(batch.column("entries")[k].as_py())
                np.add.at(total, doc, n[at] * times)
                np.add.at(best, doc, is_best[at] * times)
            columns = [per_doc.field(c) for c in ("doc_id", *_NUMBERS)] + [pa.array(best), pa.array(total), per_doc.field("groups_sha256")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"])


def link_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A pair's count is the number of rows that hold it linked; a repeated row counts again.
    ``n_best`` counts the links whose pair has the highest count of all pairs with its A id, ties
    included.  NULL, empty texts and texts that B does not give back byte for byte (it reads
    U+2581 as a space) have no tokens: zeros and an empty ``groups_sha256``.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    per_doc = _columns(docs, *((c, "bigint") for c in _NUMBERS), ("groups_sha256", "string"))
    schema = f"per_doc array<{per_doc.simpleString()}>, pairs array<bigint>, docs array<bigint>, entries binary"
    blocks, block_id = numbered(written(docs.mapInArrow(_block_maker(folder, block), schema), "token-blocks"))
    places = blocks.select(block_id, F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select(block_id, F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = places.groupBy("pair").agg(F.sum("docs").alias("n"))
    # One A id has at most as many pairs as B has ids.
    counts = counts.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy(F.shiftright("pair", _LOW))))
    told = places.select(block_id, "pair").join(counts, "pair").groupBy(block_id).agg(F.collect_list(F.struct("pair", "n", "best")).alias("counts"))
    out = _columns(docs, *((c, "bigint") for c in (*_NUMBERS, "n_best", "count_sum")), ("groups_sha256", "string"))
    return blocks.join(told, block_id, "left").drop(block_id, "docs").mapInArrow(_finish, out)


def _columns(docs: DataFrame, *more: tuple[str, str]) -> StructType:
    """The schema of ``doc_id``, as ``docs`` has it, and further columns."""
    out = StructType([docs.schema["doc_id"]])
    for name, kind in more:
        out.add(name, _parse_datatype_string(kind))
    return out


def alignments(docs: DataFrame, id_col: str = "doc_id", text: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id`` and ``groups``: the aligned token lists of each text, ``array<struct<a: array<int>, b: array<int>>>``.

    Rows without tokens (see ``link_report``) have no groups.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    group = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(folder)
        for ids, texts in _parts(batches, BLOCK):
            aligner.trim()
            rows = []
            for pieces in aligner.look_up(texts):
                printed = [g.split("|") for i in pieces for g in aligner.groups[i].split(";")]
                rows.append([{"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))} for a, b in printed])
            yield pa.RecordBatch.from_arrays([ids, pa.array(rows, group)], ["doc_id", "groups"])

    return docs.mapInArrow(aligned, _columns(docs, ("groups", "array<struct<a: array<int>, b: array<int>>>")))
