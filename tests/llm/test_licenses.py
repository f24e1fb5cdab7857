import re
import string

from tests.llm.conftest import edge_rows, ids_and
from tidemark.llm import licenses
from tidemark.llm.license_rules import BASE_PHRASES, keyword, rules

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = [(k, label) for label, phrase in BASE_PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in found}))


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def test_base_places_equal_brute_force(spark):
    texts = [
        "Licensed under the MIT license. Under THE mit License!", "cc-by-nc cc by nc CC BY NC 4.0", "Apache License, Version 2.0", "apache license version 20",
        "under the mit Kicense under the mıt license", "x" * 50_000 + " under the mit license", None, "",
    ]
    got = licenses.license_scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    assert ids_and(got, *COLUMNS) == sorted(((i, *base(t)) for i, t in enumerate(texts)), key=repr)


def test_documents_equal_brute_force(documents):
    got = licenses.license_scan(documents)
    assert ids_and(got, *COLUMNS) == sorted(((r.doc_id, *base(r.text)) for r in documents.collect()), key=repr)


def test_awkward_rows(edge, no_docs):
    got = licenses.license_scan(edge)
    assert ids_and(got, *COLUMNS) == sorted(((r[0], *base(r[1])) for r in edge_rows()), key=repr)
    assert licenses.license_scan(no_docs).count() == 0


def test_priority_and_containment(spark):
    text = "This file is licensed under the GNU General Public License version 2 or later. MPL 2.0? Mozilla Public License 2.0"
    found, _ = licenses.detections(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
    rows = found.filter("label is not null").collect()
    kept = {r.label for r in rows if r.kept}
    assert "gpl-2-or-later" in kept and "mpl-2.0" in kept
    assert "gpl" not in kept and "mpl" not in kept and "gpl-2" not in kept  # inside a better one
    for r in rows:
        others = [o for o in rows if o is not r and o.start_word <= r.start_word and o.end_word >= r.end_word and o.priority <= r.priority]
        wider = [o for o in others if (o.start_word, -o.end_word, o.priority, o.rule) < (r.start_word, -r.end_word, r.priority, r.rule)]
        assert r.kept == (not wider)
        assert re.fullmatch(dict(enumerate(p for _, _, p in rules()))[r.rule], r.matched)


def test_adjacent_places_and_positions(spark):
    found, _ = licenses.detections(spark.createDataFrame([(1, "cc by nc cc by nc then cc by nc")], "doc_id bigint, text string"))
    assert sorted(r.start_word for r in found.filter("rule = 2").collect()) == [0, 3, 7]


def test_every_rule_can_be_gated():
    for label, priority, pattern in rules():
        assert 0 <= priority < licenses.PRIORITIES and len(keyword(pattern)) >= 3, (label, pattern)
    assert len(rules()) > 250


def test_no_python_in_the_plan(documents):
    plan = licenses.license_scan(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 6
