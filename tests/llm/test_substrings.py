import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import edge_rows, ids_and, prose
from tidemark.llm import substrings, suffixes


def brute(rows, length=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(d) else 0
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((i, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def planted():
    shared, common = prose(50, 90), prose(51, 400)
    rows = [(k, prose(100 + k, 60) + (shared if k % 3 == 0 else "") + prose(200 + k, 50) + (common if k % 4 == 1 else "")) for k in range(24)]
    edited = prose(60, 700).split()
    for k in range(6):
        words = list(edited)
        words[k * 90 + 40] = "edit"
        rows.append((100 + k, " ".join(words)))
    rows += [(200, "abcd" * 300), (201, "xy" + "abcd" * 150), (202, "é" * 450), (203, rows[0][1]), (204, common + common)]
    return rows


@pytest.mark.parametrize("crowd", [256, 3, 1])
def test_equals_brute_force_on_either_side_of_the_crowd_limit(spark, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    got = substrings.removal_report(spark.createDataFrame(planted(), "doc_id bigint, text string").repartition(4))
    assert ids_and(got, *COLUMNS) == brute(planted())


def test_documents(documents):
    assert ids_and(substrings.removal_report(documents), *COLUMNS) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(edge, no_docs):
    rows = [(i, t[:3000] if t and len(t) > 100_000 else t) for i, t, *_ in edge_rows()]
    got = substrings.removal_report(edge.sparkSession.createDataFrame(rows, "doc_id bigint, text string"))
    assert ids_and(got, *COLUMNS) == brute(rows)
    long = [r for r in substrings.removal_report(edge).collect() if r.doc_id in (4, 5)]
    assert all(r.n_removed == r.n_bytes and r.n_spans == 1 for r in long)
    assert all(r.repeated == (r.n_removed > 0) for r in got.collect())
    assert substrings.removal_report(no_docs).count() == 0 and substrings.remove_repeats(no_docs).count() == 0
    left = substrings.remove_repeats(edge)
    assert left.columns == edge.columns and {r.doc_id: r.text for r in left.collect()}[4] == ""


def test_cells_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE", 1 << 10)
    data = prose(7, 900).encode()
    found = list(substrings.cells(data))
    assert [w for _, s, n in found for w in range(s, s + n)] == list(range(len(data) - 399))


def test_suffix_order_and_prefixes():
    for seed in range(150):
        draw = random.Random(seed)
        letters = draw.choice([1, 2, 3, 26])
        s = bytes(draw.randint(97, 96 + letters) for _ in range(draw.randint(1, 250)))
        data = np.frombuffer(s, np.uint8)
        order = suffixes.suffix_order(data, 1000)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        fit = order[order <= len(s) - 13]
        for a, b, n in zip(fit, fit[1:], suffixes.common_prefixes(data, fit, 13)):
            assert n == next((k for k in range(13) if s[a + k] != s[b + k]), 13)


def test_ranks_tell_whether_the_first_bytes_agree(monkeypatch):
    rounds = []
    ranked = suffixes._ranked
    monkeypatch.setattr(suffixes, "_ranked", lambda *a: rounds.append(len(a[1])) or ranked(*a))
    for seed in range(150):
        draw = random.Random(seed)
        alphabet = draw.choice([b"a", b"ab", b"\x00\xff", bytes(range(256))])
        some = bytes(draw.choices(alphabet, k=draw.randint(1, 60)))
        s = some * draw.randint(1, 4) + bytes(draw.choices(alphabet, k=draw.randint(0, 60))) + some
        data, depth = np.frombuffer(s, np.uint8), draw.choice([1, 3, 7, 20, 50, 400])
        order, rank = suffixes.suffix_ranks(data, depth)
        assert [s[i : i + depth] for i in order] == sorted(s[i : i + depth] for i in range(len(s)))
        groups = {}
        for i in range(len(s)):
            groups.setdefault(s[i : i + depth] if i + depth <= len(s) else i, []).append(i)
        assert sorted(groups.values()) == sorted(np.flatnonzero(rank == r).tolist() for r in set(rank.tolist()))
        wanted = np.array([i + depth <= len(s) and draw.random() < 0.5 for i in range(len(s))])
        order, rank = suffixes.suffix_ranks(data, depth, wanted)
        mine = [i for i in order.tolist() if wanted[i]]
        assert [s[i : i + depth] for i in mine] == sorted(s[i : i + depth] for i in np.flatnonzero(wanted))
        assert all((rank[a] == rank[b]) == (s[a : a + depth] == s[b : b + depth]) for a, b in zip(mine, mine[1:]))
    # A long repeat is settled in a few rounds of sorting numbers.
    rounds.clear()
    text = prose(70, 3000).encode()
    suffixes.suffix_ranks(np.frombuffer(text + b"." + text, np.uint8), 400)
    assert len(rounds) <= 9


def test_many_suffixes_are_ranked_without_packing():
    text = np.frombuffer(b"".join(prose(80 + k % 3, 2400).encode() for k in range(150)), np.uint8)
    assert 3 * (len(text) + 1).bit_length() > 63
    order, rank = suffixes.suffix_ranks(text, 100)
    s = text.tobytes()
    assert (np.diff(rank[order]) >= 0).all() and sorted(order.tolist()) == list(range(len(s)))
    for k in range(0, len(s) - 1, 997):
        a, b = order[k], order[k + 1]
        x, y = s[a : a + 100], s[b : b + 100]
        assert x <= y and (rank[a] == rank[b]) == (x == y and len(x) == 100)
