import random
import re

from tests.llm.conftest import edge_rows
from tidemark.llm import packing


def spread_out(plan):
    """Every piece of the plan by bin: (offset, length)."""
    bins = {}
    for length, _, each, first, offset, count in plan.runs:
        for k in range(count):
            bins.setdefault(first + k // each, []).append((offset + k % each * length, length))
    return bins


def best_fit_one_by_one(lengths, capacities, cost):
    """The rule itself: each piece into the fullest open bin that has room, else a new bin."""
    sizes, bins, left = sorted(capacities), [], {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[1] - b[0] >= n]
        if fits:
            bin_ = min(fits, key=lambda b: b[1] - b[0])
        else:
            size = min((s for s in sizes if s >= n), key=lambda s: (cost(s) / packing._fill(n, s, left, sorted(k for k in left if left[k] and k <= n)), s))
            bin_ = [0, size]
            bins.append(bin_)
        bin_[0] += n
        left[n] -= 1
    return bins


def test_plan_is_whole_and_tight():
    for seed in range(120):
        draw = random.Random(seed)
        histogram = {}
        for _ in range(draw.randint(1, 300)):
            n = draw.randint(1, 64)
            histogram[n] = histogram.get(n, 0) + draw.choice([1, 1, 1, 9, 80])
        plan = packing.best_fit(histogram, (16, 32, 64))
        placed = {}
        for length, rank, each, _, _, count in sorted(plan.runs):
            assert rank == placed.get(length, 0) and count % each == 0
            placed[length] = rank + count
        assert placed == histogram
        size = {b: (used, s) for first, count, used, s in plan.bins for b in range(first, first + count)}
        bins = spread_out(plan)
        assert set(size) == set(bins)
        for b, pieces in bins.items():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            used, s = size[b]
            assert at == used <= s == min(c for c in (16, 32, 64) if c >= used)


def test_runs_use_as_many_bins_as_single_pieces():
    for seed in range(30):
        draw = random.Random(seed)
        lengths = [draw.randint(1, 64) for _ in range(draw.randint(1, 200))]
        histogram = {n: lengths.count(n) for n in lengths}
        plan = packing.best_fit(histogram, (64,))
        assert sum(c for _, c, _, _ in plan.bins) == len(best_fit_one_by_one(lengths, (64,), packing.sequence_cost))


def check(rows, docs, most=2048):
    """Pieces cover each document once, and bins hold theirs without a gap."""
    words = sorted(((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in docs), key=repr)
    total = {}
    for r in rows:
        total.setdefault(r.doc_id, []).append((r.start_word, r.n_words))
    assert sum(n for _, n in words) == sum(r.n_words for r in rows)
    for i in {i for i, _ in words}:
        want = sorted((k, min(most, n - k)) for j, n in words if j == i for k in (range(0, n, most) if n else [0]))
        assert sorted(total[i]) == want
    bins = {}
    for r in rows:
        if r.bin_id is None:
            assert r.n_words == 0
        else:
            bins.setdefault((r.bin_id, r.bin_size), []).append((r.bin_offset, r.n_words))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), pieces in bins.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert size == min(c for c in packing.CAPACITIES if c >= at)


def test_documents(documents):
    rows = packing.pack(documents).collect()
    check(rows, [(r.doc_id, r.text) for r in documents.collect()])
    used, room = sum(r.n_words for r in rows), sum({r.bin_id: r.bin_size for r in rows}.values())
    assert used / room > 0.97


def test_awkward_rows(edge, no_docs):
    check(packing.pack(edge).collect(), [r[:2] for r in edge_rows()])
    assert packing.pack(no_docs).count() == 0
