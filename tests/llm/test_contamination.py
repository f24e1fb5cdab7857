import itertools
import random
import re

import numpy as np

from tests.llm.conftest import prose
from tidemark.llm import contamination as C


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    """Every alignment of every document with every item."""
    codes = {}
    number = lambda text: np.array([codes.setdefault(w, len(codes)) for w in words(text)], np.int64)
    numbered = [(i, number(text)) for i, text in items]
    out = set()
    for d, text in docs:
        a = number(text)
        for i, b in numbered:
            width, need = (C.WINDOW, C.AGREE) if len(b) >= C.WINDOW else (len(b), len(b))
            if len(b) < C.SHORTEST or len(a) < width:
                continue
            same = (a[:, None] == b[None, :]).astype(np.int16)
            x, y = len(a) - width + 1, len(b) - width + 1
            if sum(same[k : k + x, k : k + y] for k in range(width)).max() >= need:
                out.add((d, i))
    return sorted(out)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string")


def test_masks_are_lossless():
    for gone in itertools.combinations(range(C.WINDOW), C.WINDOW - C.AGREE):
        assert any(
            not ({p + o for o in mask} & set(gone)) for mask in C.MASKS for p in range(C.WINDOW - mask[-1])
        ), gone


def test_equals_brute_force(spark):
    draw = random.Random(4)
    items = [(i, prose(300 + i, draw.choice([2, 3, 6, 7, 9, 14, 15, 22, 40]))) for i in range(25)] + [(90, None), (91, "")]
    docs = []
    for d in range(60):
        text = prose(400 + d, draw.randint(0, 80)).split()
        if d % 2:
            part = words(items[draw.randrange(25)][1])
            part = part[draw.choice([0, 0, 3]) :]
            for _ in range(draw.randint(0, 5)):
                if part:
                    part[draw.randrange(len(part))] = "other"
            at = draw.randint(0, len(text))
            text[at:at] = [w.upper() + draw.choice(["", ",", "###"]) for w in part]
        docs.append((d, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "!!!")]
    got = C.leaks(*frames(spark, docs, items))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == brute(docs, items)


def test_documents(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert sorted((r.doc_id, r.item_id) for r in C.leaks(documents, benchmark).collect()) == want


def test_items_that_share_a_passage_meet_documents_once(spark):
    item = prose(7, 20)
    got = C.leaks(*frames(spark, [(1, "start " + item + " end")], [(5, item), (2, item), (9, item)])).collect()
    assert [(r.doc_id, r.item_id, r.n_items, r.first_word, r.last_word) for r in got] == [(1, 2, 3, 1, 20)]


def test_awkward_rows(edge, no_docs, spark):
    item = prose(2, 200)[:300]
    items = spark.createDataFrame([(1, item), (1, item), (None, prose(3, 30)), (4, None)], "item_id bigint, text string")
    got = {r.doc_id for r in C.leaks(edge, items).collect()}
    assert got == {11, 12, 13}
    assert C.leaks(no_docs, items).count() == 0 and C.leaks(edge, items.limit(0)).count() == 0
    kept = C.drop_contaminated(edge, items)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 3
    assert C.drop_contaminated(edge, items.limit(0)).count() == edge.count()
    assert C.drop_contaminated(no_docs, items).count() == 0


def test_short_items_match_word_for_word(spark):
    items = [(k, " ".join(prose(600, 6).split()[:k])) for k in range(1, 7)] + [(7, "zero")]
    first = prose(600, 6).split()
    docs = [(1, " ".join(first)), (2, " ".join(first[:3])), (3, f"{first[0]} {first[2]}"), (4, " ".join(reversed(first))), (5, f"x {first[0]}, {first[0].upper()} y {first[0]}")]
    frames_ = frames(spark, docs, items)
    got = C.leaks(*frames_)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == brute(docs, items)
    assert [(r.first_word, r.last_word) for r in got.filter("doc_id = 5").collect()] == [(1, 4)]
    assert C.leaks(*frames_, shortest=7).count() == 0 and C.leaks(*frames_, shortest=6).count() == 1


def test_items_of_a_shared_passage_can_be_found(spark):
    passage = prose(7, 60)
    items = [(5, passage + " " + prose(8, 60)), (2, passage + " " + prose(9, 60)), (7, prose(10, 20))]
    docs, benchmark = frames(spark, [(1, "start " + " ".join(passage.split()[:20]))], items)
    assert {(r.item_id, r.n_items) for r in C.leaks(docs, benchmark).collect()} == {(2, 2)}
    classes = {(r.item_id, r.member_id) for r in C.item_classes(benchmark).collect()}
    assert {m for i, m in classes if i == 2} == {2, 5} and (7, 7) in classes
