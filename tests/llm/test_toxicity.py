import zlib

import numpy as np
import pytest

from tests.llm.conftest import edge_rows
from tests.llm.test_quality import auc
from tidemark.llm import toxicity


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.log_model(toxicity.trigram_counts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")))


def test_trigram_counts_equal_brute_force(spark):
    texts = ["Ab ab, c!", "", None, "É x"]
    got = toxicity.trigram_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros(28**3, np.int64)
    for t in texts:
        s = [toxicity._symbol(c) for c in f" {(t or '').lower()} "]
        s = [c for k, c in enumerate(s) if c or k == 0 or s[k - 1]]
        for a, b, c in zip(s, s[1:], s[2:]):
            want[a * 784 + b * 28 + c] += 1
    assert (got == want).all()


@pytest.mark.parametrize(
    "disguised, meant",
    [("stuuuupid", "stupid"), ("m0r0n", "moron"), ("tr@sh", "trash"), ("w0rthl3ss", "worthless"), ("cl0wn", "clown"), ("l.o.s.e.r", "loser"), ("l o s e r", "loser")],
)
def test_disguises_are_undone(model, disguised, meant):
    restore = toxicity.restorer(model)
    assert restore(f"the {disguised} and") == f"the {meant} and"


def test_plain_text_stays(model):
    restore = toxicity.restorer(model)
    for text in ("", "The anthre of 2024, and 12 others.", "a a a a a a", "stes anhe.\nOnre ti"):
        assert restore(text) == text


def best_by_hand(token, model):
    """All readings of a short token, scored one by one."""
    readings = [("", 0.0)]
    for c in token:
        options = ([(c, 0.0)] if c.isalpha() else []) + [(x, toxicity.SWAPPED) for x in toxicity.LEET.get(c, "")] + ([("", toxicity.DROPPED_LEET)] if c in toxicity.LEET else [])
        readings = [(t + x, s - cost) for t, s in readings for x, cost in options]

    def total(text, score):
        a, b = 0, 0
        for c in text:
            s = toxicity._symbol(c)
            score += model[a, b, s]
            a, b = b, s
        return score + (model[a, b, 0] if b else 0)

    return max(total(t, s) for t, s in readings), {t for t, s in readings if total(t, s) >= max(total(*r) for r in readings) - 1e-9}


def test_viterbi_finds_the_best_reading(model):
    for token in ("1d10t", "l0$er", "5cum", "b4d", "1l1", "t3$t", "a1b", "7op"):
        _, best = best_by_hand(token, model)
        assert toxicity.decode(token, model) in best


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert {i for i, r in got.items() if r.held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    held = [(r.toxic, got[r.doc_id].score) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert auc([t for t, _ in held], [s for _, s in held]) > 0.9


def test_awkward_rows(edge, no_docs, spark):
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(1, 16)] + [(None, 1, 0), (3, 0, None), (4, 1, 7)], "doc_id bigint, quality int, toxic int")
    rows = toxicity.classify(edge, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert toxicity.classify(no_docs, labels).count() == 0
    assert {r.score for r in toxicity.classify(edge, labels.limit(0)).collect()} == {0.5}
