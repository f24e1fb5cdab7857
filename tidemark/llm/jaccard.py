"""Near-duplicates by the Jaccard similarity of the sets of word shingles.

Two texts are linked when their sets share at least ``similarity`` of their union.  The caller
brings texts together by a fingerprint of the set.  What is too far apart for that comes from
min-wise hashes: ``BANDS`` bands of ``ROWS`` hashes each, and texts that agree on a
whole band meet.  At a similarity of exactly 0.8 three pairs in a million agree on no band, and
fewer the closer the texts are.  Texts that meet there are told apart by their sketches, one byte of
every hash.  Those that look alike either way have their whole sets compared: what is linked is
decided by the sets, never by the hashes.

No step gives out a row per pair.  Texts that look alike form a group, and groups of
the same texts are one, whichever way they were found.  A task holds the sets of one group, and gives out a star per component.
Texts of equal sets are one node throughout, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.scratch import written
from tidemark.llm.common import whole
from tidemark.llm.components import stars

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
_DRAW = np.random.default_rng(42)
_FLIPS = _DRAW.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
_FACTORS = _DRAW.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the shingles; a shorter text, also an empty one, is one shingle."""
    words = (text or "").encode().lower().split()
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.array([hashed(b" ".join(words[k : k + shingle])) for k in range(max(1, len(words) - shingle + 1))], np.uint64))


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of every min-wise hash."""
    out = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(hashes), 2048):  # bounded memory for texts of any length
        out = np.minimum(out, ((hashes[at : at + 2048] ^ _FLIPS) * _FACTORS).min(axis=1))
    return out


def _band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * _MIX
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _fewest_equal(similarity: float) -> float:
    """Hashes that agree in all but a few of a million pairs of at least this similarity."""
    n = BANDS * ROWS
    return n * similarity - 5 * np.sqrt(n * similarity * (1 - similarity))


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The second and third column of each run of equal values in the first."""
    held, last = [], None
    for batch in batches:
        if not len(batch):
            continue
        key, *rest = (batch.iloc[:, i].to_numpy() for i in range(3))
        cuts = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)].tolist()
        for lo, hi in zip(cuts, cuts[1:]):
            if held and key[lo] != last:
                yield tuple(map(np.concatenate, zip(*held)))
                held = []
            held.append([x[lo:hi] for x in rest])
            last = key[lo]
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _joined(n: int, near) -> np.ndarray:
    """Component labels of ``n`` things; ``near(p, others)`` tells which of the others are linked to p."""
    labels = np.arange(n)
    for p in range(n):
        others = p + 1 + np.flatnonzero(labels[p + 1 :] != labels[p])  # the rest is connected already
        if len(others) and len(found := np.unique(labels[others[near(p, others)]])):
            same = np.isin(labels, np.r_[found, labels[p]])
            labels[same] = labels[same].min()
    return labels


def alike(sketches: np.ndarray, fewest: float) -> np.ndarray:
    """Labels of the sketches that are connected by pairs that agree in ``fewest`` bytes at least."""
    return _joined(len(sketches), lambda p, others: (sketches[others] == sketches[p]).sum(axis=1) >= fewest)


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Labels of the sets that are connected by pairs of at least this similarity."""
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), bool)

    def near(p: int, others: np.ndarray) -> np.ndarray:
        own = codes[ends[p] - sizes[p] : ends[p]]
        mark[own] = True
        # Sums up to each end; the members before p+1 are not looked at.
        total = np.r_[0, np.cumsum(mark[codes[ends[p] :]])]
        mark[own] = False
        shared = total[ends[others] - ends[p]] - total[ends[others] - sizes[others] - ends[p]]
        return shared >= similarity * (sizes[p] + sizes[others] - shared) - 1e-9

    return _joined(len(sets), near)


def similar_roots(
    rows: DataFrame, row: str, text: str, fingerprint: Callable[[np.ndarray], int], near_groups: Callable[[DataFrame], DataFrame],
    shingle: int = SHINGLE, similarity: float = SIMILARITY,
) -> DataFrame:
    """``(row, root)`` for every row: the smallest row reachable over links.

    ``row`` must number the rows, and be the same each time they are read.  ``near_groups`` turns
    ``(node, fp)``, the ``fingerprint`` of every different set, into ``(group, node)``.
    """
    fewest = _fewest_equal(similarity)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, prints, bands, bytes_ = [], [], [], []
            for content in batch["text"]:
                hashes = shingles(content, shingle)
                least = least_hashes(hashes)
                keys.append(xxhash.xxh128_digest(hashes.tobytes()))
                prints.append(fingerprint(hashes))
                bands.append(_band_keys(least))
                bytes_.append(((least * _MIX) >> np.uint64(56)).astype(np.uint8).tobytes())
            prints = np.array(prints, np.uint64).view(np.int64)
            yield pd.DataFrame({"row": batch["row"], "key": keys, "fp": prints, "bands": bands, "sketch": bytes_})

    def grouped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for nodes, sketches in _runs(batches):
            labels = alike(np.frombuffer(b"".join(sketches), np.uint8).reshape(len(nodes), -1), fewest)
            for label in np.unique(labels):
                members = np.sort(nodes[labels == label])
                if len(members) > 1:
                    name = np.uint64(xxhash.xxh64_intdigest(members.tobytes())).astype(np.int64)
                    yield pd.DataFrame({"group": name, "node": members})

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["row"], "hashes": [shingles(x, shingle).tobytes() for x in batch["text"]]})

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for nodes, hashes in _runs(batches):
            labels = similar([np.frombuffer(x, np.uint64) for x in hashes], similarity)
            other = np.flatnonzero(labels != np.arange(len(labels)))
            if len(other):
                yield pd.DataFrame({"a": nodes[other], "b": nodes[labels[other]]})

    texts = rows.select(F.col(row).alias("row"), whole(text).alias("text"))
    sketched = written(texts.mapInPandas(sketch, "row bigint, key binary, fp bigint, bands array<bigint>, sketch binary"), "sketches")
    classes = sketched.groupBy("key").agg(F.min("row").alias("node"))
    nodes = written(sketched.join(classes.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "fp", "bands", "sketch"), "nodes")
    entries = nodes.select(F.explode("bands").alias("band"), "node")
    met = entries.withColumn("n", F.count("*").over(Window.partitionBy("band"))).filter("n > 1").select("band", "node")
    near = met.join(nodes.select("node", "sketch"), "node").select("band", "node", "sketch").repartition("band").sortWithinPartitions("band")
    found = written(near_groups(nodes.select("node", "fp")).union(near.mapInPandas(grouped, "group bigint, node bigint")).distinct(), "found")
    names = found.groupBy("group").agg(F.bit_xor(F.xxhash64("node")).alias("name"))
    groups = written(found.join(names, "group").select(F.col("name").alias("group"), "node").distinct(), "groups")
    wanted = groups.select(F.col("node").alias("row")).distinct()
    whole_sets = texts.join(wanted, "row", "left_semi").mapInPandas(sets, "node bigint, hashes binary")
    meeting = groups.join(whole_sets, "node").select("group", "node", "hashes").repartition("group").sortWithinPartitions("group")
    roots = stars(meeting.mapInPandas(linked, "a bigint, b bigint"))
    known = classes.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    return sketched.select("row", "key").join(known, "key").select("row", "root")
