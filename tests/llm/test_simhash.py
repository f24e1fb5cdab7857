import re
from collections import defaultdict

import numpy as np
import xxhash

import corpus_pipeline
from tests.llm.conftest import edge_rows, ids_and, prose
from tidemark.llm import jaccard, simhash
from tidemark.llm.components import stars


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, budget=4):
    prints = [(i, brute_print(t)) for i, t in rows]
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= budget:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(prints):
        least[find(k)] += [i] if i is not None else []
    return sorted(((i, f"{f:016x}", min(least[find(k)], default=None)) for k, (i, f) in enumerate(prints)), key=repr)


def test_equals_brute_force(documents):
    got = simhash.near_components(documents)
    assert ids_and(got, "fingerprint", "component_id") == brute_components([(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(edge, no_docs):
    got = simhash.near_components(edge)
    assert ids_and(got, "fingerprint", "component_id") == brute_components([r[:2] for r in edge_rows()])
    assert simhash.near_components(no_docs).count() == 0
    kept = simhash.drop_near_copies(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len({c for *_, c in brute_components([r[:2] for r in edge_rows()])})
    assert simhash.drop_near_copies(no_docs).count() == 0


def test_the_walk_connects_what_pairs_connect():
    draw = np.random.default_rng(5)
    for _ in range(15):
        values = set()
        for center in draw.integers(0, 2**63, 6, dtype=np.uint64):
            for _ in range(int(draw.integers(1, 250))):
                v = int(center)
                for bit in draw.integers(0, 64, draw.integers(0, 9)):
                    v ^= 1 << int(bit)
                values.add(v)
        v = np.array(sorted(values), np.uint64)
        near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
        want = simhash._connect(np.arange(len(v)), *np.nonzero(near))
        assert (simhash.walk(v, np.array([0]), np.array([len(v)]), 0, 4) == want).all()


def test_links_in_tasks_equal_all_pairs(spark):
    draw = np.random.default_rng(9)
    values = set()
    for center in draw.integers(0, 2**63, 40, dtype=np.uint64):
        for _ in range(40):
            v = int(center)
            for bit in draw.integers(0, 64, draw.integers(0, 7)):
                v ^= 1 << int(bit)
            values.add(v)
    v = np.array(sorted(values), np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp bigint")
    roots = {r.node: r.root for r in stars(simhash.near_links(frame)).collect()}
    got = [roots.get(int(x), int(x)) for x in v.view(np.int64)]
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    want = simhash._connect(np.arange(len(v)), *np.nonzero(near))
    pairs = set(zip(got, want.tolist()))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_of_a_chain_and_of_a_hub(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + k) for k in range(1, 500)]
    df = spark.createDataFrame(chain + hub + [(5, 5)], "a bigint, b bigint")
    got = {r.node: r.root for r in stars(df).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + k: 1000 for k in range(1, 500)}


def test_fingerprints_of_long_texts_do_not_depend_on_the_pieces():
    text = prose(8, 70_000)
    assert simhash.fingerprint(text) == brute_print(text)


def test_pairs_within_the_budget_share_a_group(spark):
    draw = np.random.default_rng(11)
    values = []
    for center in draw.integers(0, 2**63, 30, dtype=np.uint64):
        for _ in range(25):
            v = int(center)
            for bit in draw.integers(0, 64, draw.integers(0, 9)):
                v ^= 1 << int(bit)
            values.append(v)
    v = np.array(values, np.uint64)  # some come twice
    frame = spark.createDataFrame([(k, int(x)) for k, x in enumerate(v.view(np.int64))], "node bigint, fp bigint").repartition(5)
    held = {}
    for r in simhash.near_groups(frame).collect():
        held.setdefault(r.group, []).append(r.node)
    assert all(len(set(nodes)) == len(nodes) > 1 for nodes in held.values())
    near = np.argwhere(np.triu(np.bitwise_count(v[:, None] ^ v[None, :]) <= simhash.SET_BITS_APART, 1))
    together = {(min(a, b), max(a, b)) for nodes in held.values() for a in nodes for b in nodes if a != b}
    assert {tuple(p) for p in near.tolist()} <= together
    root = simhash._connect(np.arange(len(v)), *near.T)
    assert all(len(set(root[nodes].tolist())) == 1 for nodes in held.values())


def test_the_stage_brings_texts_together_by_fingerprints(spark, monkeypatch):
    rows = [(k, prose(50 + k // 2, 200) + " end" * (k % 2)) for k in range(12)]
    met = []
    walked = simhash.near_groups

    def watched(prints, *args):
        met.append((prints, walked(prints, *args)))
        return met[-1][1]

    monkeypatch.setattr(simhash, "near_groups", watched)
    kept = corpus_pipeline.simhash_near_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 12, 2))
    ((prints, groups),) = met
    assert sorted(r.fp for r in prints.collect()) == sorted(np.array([simhash.set_fingerprint(jaccard.shingles(t)) for _, t in rows], np.uint64).view(np.int64).tolist())
    assert groups.select("group").distinct().count() == 6 and groups.count() == 12
