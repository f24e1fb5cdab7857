import zlib

import numpy as np

from tests.llm.conftest import edge_rows
from tidemark.llm import quality


def auc(truth, score):
    good, bad = np.array(score)[np.array(truth) == 1], np.array(score)[np.array(truth) == 0]
    return ((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()) if len(good) and len(bad) else 1.0


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert {i for i, r in got.items() if r.held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 5 == 0}
    held = [(r.quality, got[r.doc_id].score, got[r.doc_id].predicted) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert auc([q for q, *_ in held], [s for _, s, _ in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_expression_equals_the_rules(spark):
    draw = np.random.default_rng(2)
    x = draw.random((400, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.7)).astype(float)
    model = quality.fit(x, y)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in quality.STATISTICS))
    got = np.array([r[0] for r in frame.select(model.score()).collect()])
    logit = model.intercept + sum(w * quality._covers(r, x) for r, w in model.rules)
    assert np.allclose(got, 1 / (1 + np.exp(-logit)))
    assert auc(y, got) > 0.97 and len(model.rules) < 200


def test_awkward_rows(edge, no_docs, spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(1, 16)] + [(None, 1, 0), (3, None, 1), (4, 7, 1), (11, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.classify(edge, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(no_docs, labels).count() == 0
    assert {r.score for r in quality.classify(edge, labels.limit(0)).collect()} == {0.5}


def test_statistics_of_empty_and_long_texts():
    assert quality.statistics(None) == quality.statistics("") == [0.0] * len(quality.STATISTICS)
    assert all(np.isfinite(quality.statistics(t)).all() for t in (" ", "\n\n", "x" * 3_000_000, "🎉"))
