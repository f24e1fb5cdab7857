"""The stages against brute force, each on its own input, and the queries as registered."""

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.test_contamination import brute as leaks
from tests.llm.test_packing import check as check_packing
from tests.llm.test_jaccard import brute_kept
from tidemark.llm import language, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.written(stage(spark, out[-1], SF), name))
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns_stay(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "decontaminate", "best_fit_packing"]
    for df in stages[1:5]:
        assert df.dtypes == stages[0].dtypes


def test_language_stage(stages):
    rejected = {r.doc_id for r in language.identify(stages[0]).filter("rejected").collect()}
    assert pairs(stages[1]) == [p for p in pairs(stages[0]) if p[0] not in rejected]


def test_exact_stage(stages):
    last = {}
    for i, t in pairs(stages[1]):
        last[t] = max(i, last.get(t, i))
    assert pairs(stages[2]) == sorted((i, t) for t, i in last.items())


def test_near_stage(stages):
    rows = pairs(stages[2])
    assert [i for i, _ in pairs(stages[3])] == brute_kept(rows)


def test_decontamination_stage(stages, spark):
    rows = pairs(stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, _ in leaks(rows, items)}
    assert pairs(stages[4]) == [p for p in rows if p[0] not in dirty]


def test_packing_stage_and_run(stages, spark):
    check_packing(stages[5].collect(), pairs(stages[4]))
    key = lambda df: sorted((r.doc_id, r.piece, r.n_words) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[5])


def test_registration():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)}
    assert names | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(queries.oracle_sql()) <= set(__spark_entry__.oracle_sql())
