import random

import numpy as np

import corpus_pipeline
from tests.llm.conftest import prose
from tidemark.llm import jaccard, simhash


def brute_set(text, shingle=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))}


def brute_kept(rows, similarity=0.8):
    """The smallest id of each component over all pairs."""
    sets = [brute_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared >= similarity * (len(sets[a]) + len(sets[b]) - shared) - 1e-9 and label[a] != label[b]:
                label = [label[b] if x == label[a] else x for x in label]
    return sorted(min(rows[k][0] for k in range(len(rows)) if label[k] == c) for c in set(label))


def edited(text, share, draw):
    return " ".join("new%d" % draw.randrange(10**6) if draw.random() < share else w for w in text.split())


def test_similar_texts_many_bits_apart_are_dropped(spark):
    draw = random.Random(3)
    rows = []
    for k in range(40):
        base = prose(900 + k, draw.choice([12, 60, 150, 400]))
        rows += [(len(rows) + j, edited(base, share, draw)) for j, share in enumerate([0, 0.01, 0.015, 0.03, 0.05])]
    prints = [simhash.fingerprint(t) for _, t in rows]
    sets = [brute_set(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert sum((prints[a] ^ prints[b]).bit_count() > 4 for a, b in pairs) > 10
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


def test_pipeline_stage_equals_brute_force(spark, documents):
    docs = corpus_pipeline.written(documents.dropDuplicates(["text"]), "distinct")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


def test_labels_of_sets_equal_all_pairs():
    draw = np.random.default_rng(2)
    base = np.arange(60)
    sets = [np.unique(np.r_[base[draw.random(60) > 0.08], draw.integers(100, 10**6, draw.integers(0, 9))]).astype(np.uint64) for _ in range(80)]
    got = jaccard.similar(sets, 0.8)
    near = np.array([[len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) for y in sets] for x in sets])
    assert (got == simhash._connect(np.arange(80), *np.nonzero(near))).all() and len(set(got)) > 1


def test_runs_over_many_batches_are_whole():
    import pandas as pd

    frame = pd.DataFrame({"k": [1, 1, 1, 2, 3, 3], "a": range(6), "b": range(6)})
    got = [x.tolist() for x, _ in jaccard._runs(frame.iloc[k : k + 2] for k in range(0, 6, 2))]
    assert got == [[0, 1, 2], [3], [4, 5]]
