"""Hand-made documents with every awkward case, and helpers of the operators' tests."""

from __future__ import annotations

import random

import pytest

# Names the operators use for their own columns; documents may bring them along.
CLASHING = ("row", "_row", "kept", "score", "label", "fingerprint", "fp", "n_words", "bin_id", "anchor", "lo", "hi", "seed", "_recipe", "_spans", "lang_pred")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(2, 8))) for _ in range(n))


def edge_rows() -> list[tuple]:
    long = prose(1, 60_000)
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (6, "Tie tie tie"), (7, "Tie tie tie"), (7, "Tie tie tie"),
        (None, "no id at all"), (None, "no id at all"), (8, "É ñ ß 漢字 🎉 Kİ"), (9, "for " * 3000), (10, "1234 !!! $$$"), (11, prose(2, 200)),
        (12, prose(2, 200) + " end"), (13, prose(3, 300)), (2, ""), (14, "\x00 control \x1f"), (15, prose(4, 120)),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None, None, *["x"] * len(CLASHING)) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


def ids_and(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)
