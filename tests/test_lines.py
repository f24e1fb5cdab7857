"""Line numbers and records of a parallel read equal those of a sequential reader."""

from __future__ import annotations

import csv
import io
import os
import random

import pytest

from tests.conftest import rows
from tidemark.functions.scratch import scratch_path
from tidemark.sources import files

SCHEMA = "id int, note string, amount double"


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "257b", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def folder(spark, *texts):
    path = scratch_path(spark, "lines").removeprefix("file://")
    os.makedirs(path)
    for k, text in enumerate(texts):
        with open(f"{path}/f{k}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return path


def sequential(text):
    """(first line, fields) of each record, by the standard reader."""
    reader, out, at = csv.reader(io.StringIO(text, newline="")), [], 1
    for fields in reader:
        out.append((at, fields))
        at = reader.line_num + 1
    return [(line, fields) for line, fields in out[1:] if fields]


def made(seed, n, quoted):
    draw = random.Random(seed)
    lines = ["id,note,amount"]
    for k in range(n):
        note = draw.choice(["plain", "", "a longer note of several words", '"with, comma"', '"say ""so"""'])
        if quoted and draw.random() < 0.3:
            note = '"' + "\n".join(draw.choice(["part", "", "x,y", '""quoted""']) for _ in range(draw.randint(2, 30))) + '"'
        lines.append(f"{'bad' if draw.random() < 0.2 else k},{note},{draw.choice(['1.5', 'much', '2'])}")
        if draw.random() < 0.1:
            lines.append("")
    return "\n".join(lines) + draw.choice(["", "\n"])


@pytest.mark.parametrize("quoted", [False, True])
def test_line_numbers_over_many_splits(spark, small_splits, quoted):
    texts = [made(k, 120, quoted) for k in range(3)] + ["id,note,amount\n", "id,note,amount\nbad,x,1"]
    path = folder(spark, *texts)
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    good, rejects = files.read_csv_reject(spark, path, SCHEMA, multi_line=quoted)
    want_bad, want_good = [], []
    for k, text in enumerate(texts):
        for line, (key, note, amount) in sequential(text):
            if key == "bad" or amount == "much":
                want_bad.append((f"f{k}.csv", line, key))
            else:
                want_good.append((int(key), note or None, float(amount)))
    got = [(f.rsplit("/", 1)[1], n, key) for f, n, key in rows(rejects, "source_file", "line_number", "record_key")]
    assert sorted(got) == sorted(want_bad)
    assert rows(good) == sorted(want_good, key=repr)


def test_no_header_and_an_empty_file(spark):
    path = folder(spark, "1,a,x\n2,b,3\n", "")
    good, rejects = files.read_csv_reject(spark, path, SCHEMA, header=False)
    assert rows(good, "id") == [(2,)] and rows(rejects, "line_number", "reason") == [(1, "amount: not a double")]


def test_a_quote_that_is_never_closed_is_one_bad_record(spark):
    path = folder(spark, 'id,note,amount\n1,"open,2\n3,c,4\n')
    good, rejects = files.read_csv_reject(spark, path, SCHEMA, multi_line=True)
    assert rows(good, "id") == [(3,)] and [r[0] for r in rows(rejects, "line_number")] == [2]
