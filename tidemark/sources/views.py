"""Summary tables that are kept up to date by what changed, and used where they answer the question."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import on
from tidemark.sources.ledger import Ledger

MEASURES = ("rows", "amount", "average", "members")


@dataclass(frozen=True)
class Question:
    """Measures by some columns, over the parts from ``since`` to before ``until``."""

    by: tuple[str, ...]
    measures: tuple[str, ...] = MEASURES
    since: date | None = None
    until: date | None = None

    def holds(self, part: str | None) -> bool:
        if part is None:  # rows without a part are asked for only if there is no range
            return self.since is None and self.until is None
        return (self.since is None or part >= str(self.since)) and (self.until is None or part < str(self.until))

    def within(self, part: str) -> Column:
        tests = [F.col(part) >= on(self.since)] if self.since else []
        tests += [F.col(part) < on(self.until)] if self.until else []
        return reduce(Column.__and__, tests, F.lit(True))


class SummaryView:
    """Sums of a fact table of a ledger by ``part`` (a date column) and ``dims``.

    What is stored can be added to: row counts, sums, and the set of distinct members per group, all
    in directories by part.  ``refresh`` looks at which fact directories it has not seen: parts
    that only gained directories get the sums of those added, parts that lost any are computed
    anew, and the files of all other parts stay.
    """

    def __init__(self, ledger: Ledger, fact: str, part: str, dims: list[str], amount: str, member: str, name: str = "summary"):
        self.ledger, self.fact, self.part, self.dims, self.amount, self.member = ledger, fact, part, dims, amount, member
        self.sums, self.sets, self._note = f"{name}_sums", f"{name}_members", f"seen by {name}"

    def _fact_parts(self, entry) -> dict[str, set[str]]:
        found: dict[str, set[str]] = {}
        for d in entry.tables.get(self.fact, []):
            found.setdefault(json.dumps(d.part), set()).add(d.path)
        return found

    def _news(self, entry) -> tuple[dict[str, set[str]], dict[str, set[str]]]:
        """Directories to add and directories to compute anew, by part."""
        seen = {part: set(paths) for part, paths in json.loads(entry.notes.get(self._note, "{}")).items()}
        now = self._fact_parts(entry)
        added = {p: paths - seen.get(p, set()) for p, paths in now.items() if paths > seen.get(p, set())}
        changed = {p: now.get(p, set()) for p in now.keys() | seen.keys() if p not in added and now.get(p, set()) != seen.get(p, set())}
        return added, changed

    def stale(self) -> list[str | None]:
        """Parts of which the summary does not know the latest rows."""
        added, changed = self._news(self.ledger.latest())
        return sorted((json.loads(p) for p in added.keys() | changed.keys()), key=str)

    def refresh(self) -> list[str | None]:
        """Brings the summary up to the fact table, in one commit; returns the parts it touched."""
        change = self.ledger.begin()
        added, changed = self._news(change.base)
        touched = [json.loads(p) for p in added.keys() | changed.keys()]
        if not touched and self.sums in change.base.tables:
            return []
        wanted = {path for paths in (*added.values(), *changed.values()) for path in paths}
        fresh = change.rows(self.fact, lambda d: d.path in wanted)
        group = [self.part, *self.dims]
        sums = fresh.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), F.count(self.amount).alias("amounts"), F.sum(self.amount).alias("amount"))
        sets = fresh.select(*group, F.col(self.member).alias("member")).filter("member is not null").distinct()
        keep = {json.loads(p) for p in added}
        old_sums, old_sets = (change.rows(name, lambda d: d.part in keep) for name in (self.sums, self.sets))
        if old_sums is not None:
            amount = sums.schema["amount"].dataType
            both = old_sums.unionByName(sums).groupBy(*group)
            sums = both.agg(F.sum("rows").alias("rows"), F.sum("amounts").alias("amounts"), F.sum("amount").cast(amount).alias("amount"))
            sets = old_sets.unionByName(sets).distinct()
        change.replace_parts(self.sums, sums, self.part, touched)
        change.replace_parts(self.sets, sets, self.part, touched)
        change.note(self._note, json.dumps({p: sorted(paths) for p, paths in self._fact_parts(change.state).items()}))
        change.commit(f"refresh of {self.sums}")
        return sorted(touched, key=str)

    def covers(self, q: Question) -> bool:
        """Whether the summary can answer: it has the columns, and has seen all rows of the parts in question."""
        known = set(q.by) <= {self.part, *self.dims} and set(q.measures) <= set(MEASURES)
        entry = self.ledger.latest()
        return known and self.sums in entry.tables and not any(q.holds(p) for p in self.stale())

    def answer(self, q: Question) -> DataFrame:
        """The summary's answer if it covers the question, else the fact table's; both are the same rows."""
        return self.from_summary(q) if self.covers(q) else self.from_fact(q)

    def from_fact(self, q: Question) -> DataFrame:
        rows = self.ledger.rows(self.fact, lambda d: q.holds(d.part)).filter(q.within(self.part))
        measures = {
            "rows": F.count(F.lit(1)),
            "amount": F.sum(self.amount).cast("double"),
            "average": F.sum(self.amount).cast("double") / F.count(self.amount),
            "members": F.countDistinct(self.member),
        }
        return rows.groupBy(*q.by).agg(*[measures[m].alias(m) for m in q.measures])

    def from_summary(self, q: Question) -> DataFrame:
        entry = self.ledger.latest()
        sums = self.ledger.rows(self.sums, lambda d: q.holds(d.part), entry).filter(q.within(self.part))
        measures = {"rows": F.sum("rows"), "amount": F.sum("amount").cast("double"), "average": F.sum("amount").cast("double") / F.sum("amounts")}
        plain = [m for m in q.measures if m != "members"]
        out = sums.groupBy(*q.by).agg(*[measures[m].alias(m) for m in plain] or [F.sum("rows").alias("_rows")])
        if "members" not in q.measures:
            return out
        sets = self.ledger.rows(self.sets, lambda d: q.holds(d.part), entry).filter(q.within(self.part))
        counts = sets.groupBy(*q.by).agg(F.countDistinct("member").alias("members")).withColumnsRenamed({c: f"_{c}" for c in q.by})
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in q.by], F.lit(True))
        joined = out.join(counts, same, "left") if q.by else out.join(counts, how="left")
        return joined.select(*q.by, *[F.coalesce("members", F.lit(0)).alias(m) if m == "members" else m for m in q.measures])
