import hashlib
import random

import pytest

from tests.llm.conftest import edge_rows, ids_and, prose
from tidemark.llm import passages

COLUMNS = ("n_words", "n_removed", "kept_sha256")


def brute(rows, length=50):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in texts:
        for k in range(len(words) - length + 1 if i is not None else 0):
            key = tuple(words[k : k + length])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - length + 1 if i is not None else 0):
            if least[tuple(words[k : k + length])] < i:
                gone.update(range(k, k + length))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def planted():
    shared, common = prose(50, 70), prose(51, 300)
    rows = [(50 - k, f"{prose(100 + k, 60)} {shared if k % 3 == 0 else ''} {prose(200 + k, 30)} {common if k % 4 == 1 else ''}") for k in range(24)]
    edited = prose(60, 400).split()
    for k in range(12):
        words = list(edited)
        words[k * 30 + 20] = "edit"
        rows.append((100 + k, "  \n".join(words)))
    rows += [(200, "ab " * 300), (201, "xy " + "ab " * 150), (202, "é " * 45), (203, rows[0][1]), (204, common + " " + common), (1, prose(60, 400))]
    # One passage of 49 words inside many different texts, and one of exactly 50.
    rows += [(300 + k, f"{prose(400 + k, 40)} {prose(70, 49 + k % 2)} {prose(500 + k, 40)}") for k in range(9)]
    return rows + [(203, rows[0][1]), (None, common), (None, common)]


@pytest.mark.parametrize("crowd, shard", [(1000, 500_000), (1000, 300), (4, 2000), (0, 1000)])
def test_equals_brute_force_on_either_side_of_the_limits(spark, monkeypatch, crowd, shard):
    monkeypatch.setattr(passages, "CROWD", crowd)
    monkeypatch.setattr(passages, "SHARD", shard)
    got = passages.removal_report(spark.createDataFrame(planted(), "doc_id bigint, text string").repartition(4))
    assert ids_and(got, *COLUMNS) == brute(planted())


def test_documents(documents):
    assert ids_and(passages.removal_report(documents), *COLUMNS) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(edge, no_docs):
    assert ids_and(passages.removal_report(edge), *COLUMNS) == brute([(i, t) for i, t, *_ in edge_rows()])
    assert passages.removal_report(no_docs).count() == 0 and passages.remove_passages(no_docs).count() == 0
    left = passages.remove_passages(edge)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert left.columns == edge.columns and left.count() == edge.count() and texts[5] == "" and texts[1] is None and texts[3] == " \n\t "
    assert texts[12] == "end" and len(texts[4].split()) == 60_000


def test_one_large_family(spark):
    base = prose(9, 120).split()
    draw = random.Random(2)
    rows = []
    for k in range(3000):
        words = list(base)
        words[draw.randrange(120)] = f"w{k}"
        rows.append((k, " ".join(words)))
    got = passages.removal_report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8))
    assert ids_and(got, *COLUMNS) == brute(rows)


def test_cells_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(passages, "_PIECE", 1 << 9)
    words = prose(7, 3000).encode().split()
    assert [w for _, s, n in passages.cells(words) for w in range(s, s + n)] == list(range(2951))
