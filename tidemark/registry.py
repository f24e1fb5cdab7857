"""Names the registered queries and the SQL that states their result."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from textwrap import dedent

from pyspark.sql import DataFrame

# Modules that register queries when imported.
_MODULES = (
    "tidemark.operators.filters",
    "tidemark.operators.joins",
    "tidemark.operators.subqueries",
    "tidemark.operators.aggregates",
    "tidemark.operators.windows",
    "tidemark.operators.ranking",
    "tidemark.operators.unions",
    "tidemark.operators.marts",
    "tidemark.operators.skew",
    "tidemark.operators.reports",
    "tidemark.plans.source_queries",
    "tidemark.plans.document_queries",
    "tidemark.plans.quality_queries",
    "tidemark.plans.load_queries",
    "tidemark.plans.stream_queries",
)


@dataclass(frozen=True)
class Entry:
    name: str
    run: Callable[..., DataFrame]
    sql: str | None


_ENTRIES: dict[str, Entry] = {}


def registered(sql: str | None = None, **params):
    """Register ``fn(tables, **params)`` under its own name.

    ``params`` are the values used by the registered query; the function keeps
    its own defaults for other callers.
    """

    def wrap(fn):
        run = partial(fn, **params) if params else fn
        _ENTRIES[fn.__name__] = Entry(fn.__name__, run, dedent(sql).strip() if sql else None)
        return fn

    return wrap


def catalog() -> dict[str, Entry]:
    for module in _MODULES:
        importlib.import_module(module)
    return dict(_ENTRIES)
