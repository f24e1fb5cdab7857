"""Run registered queries beside their SQL in DuckDB and compare rows, names and types.

usage: python tools/check_oracle.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from tidemark.registry import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.tables import NAMES, Tables  # noqa: E402

KINDS = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def differences(df, con, sql: str) -> list[str]:
    """Empty when the Spark result equals the SQL result."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    want = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for column, kind in df.dtypes:
        if not kinds[column].startswith(KINDS.get(kind, kind)):
            problems.append(f"type of {column}: {kind} != {kinds[column]}")
    order = sorted(names)
    got = sorted(tuple(_plain(row[c]) for c in order) for row in df.collect())
    index = [names.index(c) for c in order]
    want = sorted(tuple(_plain(row[i]) for i in index) for row in want)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
        problems.append(f"values differ: {order} {pairs}")
    if not want:
        problems.append("empty result")
    return problems


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = [e for name, e in catalog().items() if not argv[1:] or name.startswith(tuple(argv[1:]))]
    spark = local_session("check")
    con, bad = duck(sf), 0
    for entry in chosen:
        start = time.time()
        try:
            df = entry.run(Tables(spark, sf))
            if entry.sql is None:
                rows, problems = df.count(), []
                note = f"rows only: {rows}"
            else:
                problems = differences(df, con, entry.sql)
                note = "ok"
        except Exception as error:  # report and go on with the other queries
            problems, note = [f"{type(error).__name__}: {str(error)[:900]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'pass'} {entry.name} {time.time() - start:.2f}s {note} {problems or ''}", flush=True)
    print(f"{len(chosen)} queries, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
