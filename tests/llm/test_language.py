import zlib

from tests.llm.conftest import edge_rows
from tidemark.llm import language


def test_held_out_accuracy(documents):
    got = {r.doc_id: r for r in language.identify(documents).collect()}
    rows = documents.collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert {r.doc_id for r in held} == {i for i, r in got.items() if r.held_out}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_do_not_matter(documents):
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = documents.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    key = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(df).collect())
    assert key(other) == key(documents)


def test_awkward_rows(edge, no_docs):
    rows = language.identify(edge).collect()
    assert len(rows) == len(edge_rows())
    letters = {i: any(map(str.isalpha, t or "")) for i, t, *_ in edge_rows()}
    assert all((r.lang_pred == "und") == (not letters[r.doc_id]) for r in rows)
    assert language.identify(no_docs).count() == 0
    kept = language.keep_identified(edge)
    assert kept.columns == edge.columns and all(any(map(str.isalpha, r.text or "")) for r in kept.collect())


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in language.identify(df).collect()} == {"und"}
    assert [r.doc_id for r in language.keep_identified(df).collect()] == [1]


def test_far_texts_are_rejected_and_prose_is_kept(documents, spark):
    strange = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(["漢字仮名交じり文の例です。" * 30, "Это совсем другой язык, его не учили. " * 20])], "doc_id bigint, text string")
    all_ = documents.unionByName(strange, allowMissingColumns=True)
    rows = language.identify(all_).collect()
    assert all(r.rejected for r in rows if r.doc_id >= 10**6)
    assert sum(r.rejected for r in rows if r.doc_id < 10**6) == 0


def test_counts_do_not_depend_on_pieces(monkeypatch):
    from tidemark.llm import chars

    text = "some words in a row " * 500
    whole = language.ngram_counts(text)
    monkeypatch.setattr(chars, "PIECE", 999)
    # Pieces end at spaces, so only a few n-grams with a space in the middle can differ.
    assert abs(whole - language.ngram_counts(text)).sum() <= 6 * 12


def test_a_language_of_any_size_is_sampled(spark):
    # More than a million rows for every row of the sample.
    rows = spark.range(1_100_000).selectExpr("id AS key", "'la' AS text", "'xx' AS lang")
    assert language.fit(rows, dimensions=64, sample=1).languages == ["xx"]
    for n in (10, 10**6, 10**9, 10**13):
        for each in (1, 22, 1000):
            bound = language.draw_below(each, n)
            let = n if bound is None else (bound + 2**63) * n // 2**64
            assert min(n, each) <= let <= each + 6 * each**0.5 + 17
