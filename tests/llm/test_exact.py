import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import edge_rows, ids_and
from tidemark.llm import exact


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("keep_id", "group_size", "kept", "text_sha256")


def test_equals_brute_force(documents):
    assert ids_and(exact.equal_groups(documents), *COLUMNS) == expected([(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(edge, no_docs):
    assert ids_and(exact.equal_groups(edge), *COLUMNS) == expected([r[:2] for r in edge_rows()])
    assert exact.equal_groups(no_docs).count() == 0 and exact.drop_exact_copies(no_docs).count() == 0
    kept = exact.drop_exact_copies(edge)
    assert kept.columns == edge.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({r[1] or "" for r in edge_rows()})


def test_chunks_join_to_the_text(spark):
    texts = ["", "a", "line\n" * 5000, "x" * 10_000, "One. Two! Three? " * 900, "é🎉" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select("text", exact.chunks(F.col("text")).alias("c")).collect():
        assert "".join(row.c) == row.text
        assert all(len(c) <= exact.CHUNK_MAX for c in row.c)


def test_shared_passages_share_chunks(spark):
    passage = "".join(f"Sentence number {i} of a passage that is shared by both texts. " for i in range(200))
    df = spark.createDataFrame([("Short start. " + passage,), ("Another and somewhat longer start of a text. " + passage,)], "text string")
    a, b = [set(r.c) for r in df.select(exact.chunks(F.col("text"), 128, 1024).alias("c")).collect()]
    assert len(a & b) >= 0.7 * len(a)


def test_colliding_short_digests_get_different_identifiers(edge, monkeypatch):
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: F.lit(0).cast("bigint"))
    assert ids_and(exact.equal_groups(edge), *COLUMNS) == expected([r[:2] for r in edge_rows()])


def test_no_python_and_no_text_in_an_exchange(documents):
    plan = exact.equal_groups(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_large_group_is_spread_and_stays_whole(spark):
    from tidemark.llm import common

    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 900).cast("string")).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = common.joined_with_groups(rows, groups, ["k"], "n", 9000)
    assert sorted(joined.columns) == ["id", "k", "n"]
    assert joined.count() == 9000 and joined.filter("k = 'hot' and n = 3000").count() == 3000
    keys = spark.range(0).select("id", F.lit("x").alias("k"))
    assert common.joined_with_groups(keys, groups, ["k"], "n", 0).count() == 0


def test_copies_in_their_thousands(spark):
    rows = [(k, "the same text " * 200 if k % 3 else f"text {k} " + "the same line. " * 90) for k in range(4000)]
    got = exact.equal_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    large = [r for r in got if r.group_size > 1]
    assert len(got) == 4000 and len(large) == 2666 and {r.keep_id for r in large} == {3998} and sum(r.kept for r in got) == 4000 - 2665
