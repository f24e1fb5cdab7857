"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints within the error budget of k bits are found by walking the trie of all
fingerprints against itself: pairs of nodes go down together, add up the bits in which they
differ, and are dropped as soon as they exceed the budget.  To share the walk between tasks,
the bits are cut into b blocks; k errors leave b - k blocks untouched, so under one of the
C(b, k) orders of the blocks the two fingerprints agree on all their leading b - k blocks.
Each order is a trie; each of its nodes at that depth is walked in one task.

Only distinct fingerprints are walked, 8 bytes each, so copies cost nothing.  A task keeps
about 50 bytes per fingerprint below one node; the walk skips pairs of nodes already known to
be connected, so a dense cluster costs no pair per link.  With six blocks a node holds one in
two million fingerprints; ``blocks`` raises that number for larger corpora.

The pipeline's stage walks the same tries over fingerprints of whole shingle sets, with a wider
budget: what is connected under a node forms a group, and the sets of a group are then compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm import jaccard
from tidemark.llm.common import fresh_name, stably_numbered, whole
from tidemark.llm.components import stars

SHINGLE, BITS_APART, BLOCKS = 4, 4, 6
SET_BITS_APART, SET_BLOCKS = 6, 8
SEED = 42
_SMALL = 64  # pairs of leaves that are compared directly
_WAVE = 250_000  # node pairs, or leaf pairs, held at once
_FILL = 200_000  # fingerprints walked together
_CHUNK = 65_536  # hashes looked at together
_MIX = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64 bits; a bit is set when it is set in over half the shingles' hashes."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if n <= shingle:
        return hashed(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    m = n - shingle + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, m, _CHUNK):  # bounded memory for texts of any length
        to = min(m, at + _CHUNK)
        first = (ends[at:to] - sizes[at:to]).tolist()
        last = ends[at + shingle - 1 : to + shingle - 1].tolist()
        counts += _bits_set(np.array([hashed(joined[s:e], SEED) for s, e in zip(first, last)], np.uint64))
    return _majority(counts, m)


def set_fingerprint(hashes: np.ndarray) -> int:
    """Unsigned 64 bits of a set of hashes; a bit is set when it is set in over half of them."""
    parts = (hashes[at : at + _CHUNK] for at in range(0, len(hashes), _CHUNK))
    return _majority(sum(map(_bits_set, parts)), len(hashes))


def _bits_set(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = len(bits) // 128 * 128
    blocks = bits[:full].reshape(-1, 128, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return blocks + bits[full:].sum(axis=0, dtype=np.int64)


def _majority(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit column."""

    @F.pandas_udf("bigint")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return udf(text)


# --- the walk -----------------------------------------------------------------------------


def _connect(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels after joining u with v: the smallest index of each component."""
    while True:
        lu, lv = labels[u], labels[v]
        apart = lu != lv
        if not apart.any():
            return labels
        u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
        np.minimum.at(labels, np.maximum(lu, lv), np.minimum(lu, lv))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


def _leaf_pairs(values, a0, a1, b0, b1, budget) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves of small node pairs that differ in at most ``budget`` bits."""
    sizes = (a1 - a0) * (b1 - b0)
    node = np.repeat(np.arange(len(a0)), sizes)
    nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    width = (b1 - b0)[node]
    i, j = a0[node] + nth // width, b0[node] + nth % width
    near = (i < j) | (a0[node] != b0[node])
    i, j = i[near], j[near]
    close = np.bitwise_count(values[i] ^ values[j]) <= budget
    return i[close], j[close]


def walk(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Component labels of the sorted distinct ``values`` under the nodes ``[lo, hi)`` at ``depth``.

    Two values below the same node are connected when they differ in at most ``budget`` bits.
    """
    labels = np.arange(len(values))
    # Links of one bit first: what they connect is then skipped by the full walk.
    wide = (hi - lo) > _SMALL
    for allowed, nodes in ((1, wide), (budget, np.ones(len(lo), bool))):
        runs = np.cumsum(np.r_[0, labels[1:] != labels[:-1]])
        a = (lo[nodes], hi[nodes])
        todo = [(depth, *a, *a, np.zeros(nodes.sum(), np.int8))] if nodes.any() and allowed <= budget else []
        while todo:
            at, a0, a1, b0, b1, off = todo.pop()
            if len(a0) > _WAVE:
                half = len(a0) // 2
                todo += [(at, *(x[half:] for x in (a0, a1, b0, b1, off))), (at, *(x[:half] for x in (a0, a1, b0, b1, off)))]
                continue
            # Nodes whose leaves are all connected need no further walk.
            joined = (runs[a0] == runs[a1 - 1]) & (runs[b0] == runs[b1 - 1]) & (labels[a0] == labels[b0])
            small = ~joined & ((a1 - a0) * (b1 - b0) <= _SMALL)
            if small.any():
                pick = np.flatnonzero(small)
                for part in np.array_split(pick, len(pick) * _SMALL // (8 * _WAVE) + 1):
                    i, j = _leaf_pairs(values, a0[part], a1[part], b0[part], b1[part], allowed)
                    new = labels[i] != labels[j]
                    if new.any():
                        labels = _connect(labels, i[new], j[new])
                        runs = np.cumsum(np.r_[0, labels[1:] != labels[:-1]])
            down = ~joined & ~small
            if not down.any() or at >= 64:
                continue
            a0, a1, b0, b1, off = (x[down] for x in (a0, a1, b0, b1, off))
            bit = np.uint64(1 << (63 - at))
            above = ~np.uint64((1 << (64 - at)) - 1)
            am = np.searchsorted(values, (values[a0] & above) | bit).clip(a0, a1)
            same = a0 == b0
            bm = np.where(same, am, np.searchsorted(values, (values[b0] & above) | bit).clip(b0, b1))
            more = (off + 1).astype(np.int8)
            cross = ~same
            kids = [
                (a0, am, b0, bm, off, None), (am, a1, bm, b1, off, None), (a0, am, bm, b1, more, None), (am, a1, b0, bm, more, cross),
            ]
            kids = [tuple(x if keep is None else x[keep] for x in kid) for *kid, keep in kids]
            a0, a1, b0, b1, off = (np.concatenate(x) for x in zip(*kids))
            alive = (a0 < a1) & (b0 < b1) & (off <= allowed)
            alive &= ~((a0 == b0) & (a1 - a0 == 1))
            if alive.any():
                todo.append((at + 1, *(x[alive] for x in (a0, a1, b0, b1, off))))
    return labels


# --- sharing the walk between tasks -------------------------------------------------------


def _widths(blocks: int) -> list[int]:
    return [64 // blocks + (i < 64 % blocks) for i in range(blocks)]


def _orders(blocks: int, budget: int) -> list[tuple[list[int], int]]:
    """Each order of the blocks with the number of leading bits that must agree."""
    widths = _widths(blocks)
    out = []
    for lead in combinations(range(blocks), blocks - budget):
        rest = [i for i in range(blocks) if i not in lead]
        out.append(([*lead, *rest], sum(widths[i] for i in lead)))
    return out


def _ordered(value: Column, order: list[int], widths: list[int]) -> Column:
    """The bits of ``value`` with its blocks in ``order``, first block highest."""
    out, left = F.lit(0).cast("bigint"), 64
    for block in order:
        low = 64 - sum(widths[: block + 1])
        left -= widths[block]
        part = F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << widths[block]) - 1))
        out = out.bitwiseOR(F.shiftleft(part, left))
    return out


def _restore(values: np.ndarray, order: list[int], widths: list[int]) -> np.ndarray:
    out, left = np.zeros_like(values), 64
    for block in order:
        left -= widths[block]
        part = (values >> np.uint64(left)) & np.uint64((1 << widths[block]) - 1)
        out |= part << np.uint64(64 - sum(widths[: block + 1]))
    return out


def _walked(values: DataFrame, budget: int, blocks: int, give: Callable[[np.ndarray, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """What ``give`` makes of the fingerprints below some nodes, and of the labels of the components there.

    ``values`` has one column ``fp`` of distinct fingerprints; each is looked at once per trie.
    """
    if blocks <= budget:
        raise ValueError("more blocks than errors are needed")
    widths, orders = _widths(blocks), _orders(blocks, budget)
    turned = F.array(
        *[
            F.struct(F.lit(i).alias("trie"), F.shiftrightunsigned(_ordered(F.col("fp"), order, widths), 64 - lead).alias("node"), _ordered(F.col("fp"), order, widths).alias("bits"))
            for i, (order, lead) in enumerate(orders)
        ]
    )
    rows = values.select(F.explode(turned).alias("t")).select("t.*").repartition("trie", "node").sortWithinPartitions("trie", "node")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def finish(held: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for trie, part in held.groupby("trie", sort=False):
                order, lead = orders[trie]
                bits = np.sort(part["bits"].to_numpy().view(np.uint64))
                node = bits >> np.uint64(64 - lead)
                lo = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
                hi = np.r_[lo[1:], len(bits)]
                many = hi - lo > 1
                labels = walk(bits, lo[many], hi[many], lead, budget)
                if (labels != np.arange(len(labels))).any():
                    yield give(_restore(bits, order, widths).view(np.int64), labels)

        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) >= _FILL:
                rows = pd.concat(held, ignore_index=True)
                # Whole nodes only; the last one may go on in the next batch.
                last = rows.iloc[-1]
                open_ = ((rows["trie"] == last["trie"]) & (rows["node"] == last["node"])).to_numpy()
                yield from finish(rows[~open_])
                held = [rows[open_]]
        if held:
            yield from finish(pd.concat(held, ignore_index=True))

    return rows.mapInPandas(join, schema)


def near_links(values: DataFrame, budget: int = BITS_APART, blocks: int = BLOCKS) -> DataFrame:
    """Links ``(a, b)`` that connect exactly what pairs within ``budget`` bits connect.

    ``values`` has one column ``fp`` of distinct fingerprints.  Inside a task only a star per
    component is given out, not every pair.
    """

    def star(prints: np.ndarray, labels: np.ndarray) -> pd.DataFrame:
        other = np.flatnonzero(labels != np.arange(len(labels)))
        return pd.DataFrame({"a": prints[other], "b": prints[labels[other]]})

    return _walked(values, budget, blocks, star, "a bigint, b bigint")


def near_groups(prints: DataFrame, budget: int = SET_BITS_APART, blocks: int = SET_BLOCKS) -> DataFrame:
    """``(group, node)`` for the columns ``node`` and ``fp``: any two nodes within ``budget`` bits share a group.

    A group holds what is connected below one node of a trie, never more than a component.
    Nodes in no group are left out, and groups of the same fingerprints are one.
    """

    def members(prints: np.ndarray, labels: np.ndarray) -> pd.DataFrame:
        order = np.argsort(labels, kind="stable")
        order = order[np.bincount(labels)[labels[order]] > 1]
        label, fp = labels[order], prints[order]
        first = np.r_[True, label[1:] != label[:-1]]
        mixed = fp.view(np.uint64) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
        names = np.bitwise_xor.reduceat(mixed, np.flatnonzero(first)).view(np.int64)
        return pd.DataFrame({"group": names[np.cumsum(first) - 1], "fp": fp})

    values = prints.groupBy("fp").agg(F.count("*").alias("n"))
    apart = _walked(values.select("fp"), budget, blocks, members, "group bigint, fp bigint").distinct()
    equal = values.filter("n > 1").select(F.col("fp").alias("group"), "fp")
    return apart.union(equal).join(prints, "fp").select("group", "node")


def near_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BITS_APART, blocks: int = BLOCKS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``budget`` bits.  NULL and
    empty texts have fingerprint zero and are linked like any other.  Repeated rows come back as
    often as they came.  NULL ids are linked too; a component of NULL ids only has a NULL id.
    """
    rows = written(docs.select(F.col(id_col).alias("doc_id"), fingerprints(whole(text), shingle).alias("fp")), "fingerprints")
    members = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = stars(near_links(members.select("fp"), budget, blocks))
    linked = members.join(roots, members["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.join(least, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = jaccard.SHINGLE, similarity: float = jaccard.SIMILARITY, budget: int = SET_BITS_APART, blocks: int = SET_BLOCKS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id.

    Links are pairs whose sets of ``shingle`` words have a Jaccard similarity of at least
    ``similarity``.  Fingerprints of the sets within ``budget`` bits bring texts together, and the sets
    decide.  Some pairs of that similarity lie further apart than any order of blocks can carry;
    so that none is lost, the bands of ``jaccard`` bring texts together as well.
    """
    rows, row = stably_numbered(docs)
    ids = written(rows.select(F.col(row).alias("_row"), F.col(id_col).alias("_id")), "ids")
    roots = jaccard.similar_roots(rows, row, text, set_fingerprint, lambda prints: near_groups(prints, budget, blocks), shingle, similarity)
    best = roots.join(ids, roots["row"] == ids["_row"]).groupBy("root").agg(
        F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_row"))).alias("_best")
    )
    stays = fresh_name(rows, "stays")
    kept = best.select(F.col("_best._row").alias(stays))
    return rows.join(kept, rows[row] == kept[stays], "left_semi").drop(row)
