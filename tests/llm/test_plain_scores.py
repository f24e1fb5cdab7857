"""Every score of the classifiers against plain Python: dictionaries and loops, no arrays, one text at a time."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language, quality, toxicity

SF = "/root/testdata/sf0.001"
WORD = 0xFFFFFFFF


def letters(text):
    """Lower-case letters, runs of anything else as one space, a space at both ends."""
    out = [" "]
    for c in f"{text or ''} ":
        low = c.lower() if len(c.lower()) == 1 else c
        c = low if c.isalpha() or ord(c) >= 0x10000 else " "
        if c != " " or out[-1] != " ":
            out.append(c)
    return [ord(c) for c in out]


def language_grams(text):
    codes, out = letters(text), Counter()
    for start in range(len(codes)):
        h = 0
        for n in range(3):
            if start + n >= len(codes):
                break
            c = codes[start + n]
            h = c * 2654435761 & WORD if n == 0 else h * 40503 + c * 2246822519 & WORD
            out[((h ^ h >> 15) * 2654435761 & WORD) >> 12 & language.DIMENSIONS - 1] += 1
    return out


def toxic_grams(text):
    codes, out = letters(text), Counter()
    for start in range(len(codes) - toxicity.GRAM + 1):
        h = 0
        for c in codes[start : start + toxicity.GRAM]:
            h = (h ^ c) * 2654435761 & WORD
            h ^= h >> 15
        out[h & toxicity.BUCKETS - 1] += 1
    return out


def test_language_scores(documents):
    rows = documents.collect()
    known = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None]
    frequency = Counter(g for r in known for g in language_grams(r.text))
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.fit(documents.filter(~held).select(F.col("doc_id").alias("key"), "text", "lang"))
    idf = [math.log((1 + len(known)) / (1 + frequency[g])) + 0.1 for g in range(language.DIMENSIONS)]
    assert model.idf.tolist() == pytest.approx(idf, rel=1e-5)
    centroids = [[float(x) for x in c] for c in model.centroids]
    got = {r.doc_id: r for r in language.identify(documents).collect()}
    for r in rows:
        weights = {g: (1 + math.log(n)) * idf[g] for g, n in language_grams(r.text).items()}
        size = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * c[g] for g, w in weights.items()) / size if size else 0.0 for c in centroids]
        best = max(cosines)
        if any(map(str.isalpha, r.text or "")):
            assert got[r.doc_id].score == pytest.approx(min(1, max(0, best)), abs=1e-4)
            assert got[r.doc_id].lang_pred in {model.languages[k] for k, c in enumerate(cosines) if c > best - 1e-4}
        else:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0)


def test_quality_scores(spark, documents, labels):
    got = {r.doc_id: r for r in quality.classify(documents, labels).collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    known = [(i, marks[i], *quality.statistics(t)) for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 and marks.get(i) in (0, 1)]
    known.sort()
    model = quality.fit(np.array([r[2:] for r in known], float), np.array([r[1] for r in known], float))
    assert len(model.rules) > 1
    for i, text in texts.items():
        values = quality.statistics(text)
        logit = model.intercept
        for rule, weight in model.rules:
            if all((values[k] > cut) == above for k, above, cut in rule):
                logit += weight
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_toxicity_scores(spark, documents, labels, monkeypatch):
    draw = np.random.default_rng(11)
    counts = Counter(g for r in documents.collect() for g in toxic_grams(r.text))
    chosen = np.array(sorted(g for g, _ in counts.most_common(60)))
    scorer = toxicity.Scorer(chosen, draw.normal(size=120).astype(np.float32), -0.4)
    monkeypatch.setattr(toxicity, "fit", lambda learn, rows: scorer)
    got = {r.doc_id: r for r in toxicity.classify(documents, labels).collect()}
    restore = toxicity.restorer(toxicity.log_model(toxicity.trigram_counts(documents.select("text"))))
    for r in documents.collect():
        grams = toxic_grams(restore(r.text or ""))
        total = max(1, sum(grams.values()))
        logit = scorer.intercept
        for k, g in enumerate(chosen.tolist()):
            logit += (grams[g] > 0) * float(scorer.weights[k]) + math.log1p(1000 * grams[g] / total) * float(scorer.weights[60 + k])
        assert got[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, logit)))), abs=1e-3)
