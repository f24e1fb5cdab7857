"""License scan: ordered signature rules behind a keyword prefilter.

One pass over the texts.  Each text is tested for the rules' keywords; only rules whose
keyword occurs run their pattern, over the text's words with one space between them.
Detections then travel as narrow rows, and a window per document suppresses those that lie
inside another detection of the same or a better priority.  The texts are never shuffled.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, numbered, whole
from tidemark.llm.license_rules import BASE_PHRASES, keyword, root, rules

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIORITIES = 4
CONFIDENCE = (1.0, 0.9, 0.7, 0.4)  # of a detection, by priority


def _lower(text: Column) -> Column:
    """ASCII lower case.  Only two letters beyond ASCII have an ASCII letter in their lower case;
    where neither occurs, the faster function finds the same words."""
    exact = text.contains("\u212a") | text.contains("\u0130")
    return F.when(exact, ascii_lower(text)).otherwise(F.lower(text))


def _any_of(text: Column, literals: list[str]) -> Column:
    return reduce(or_, [text.contains(literal) for literal in literals])


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detections(docs: DataFrame, text: str = "text", rule_set=None) -> tuple[DataFrame, str]:
    """All detections of all rows, and the name of the column that numbers the rows.

    Returns one row per detection: the row number, the other columns of ``docs`` without the
    text, ``n_words``, ``rule`` (its place in the order), ``label``, ``priority``, ``start_word``,
    ``end_word`` (exclusive), ``matched`` and ``kept``.  A row without detections, so also a NULL or
    empty text, gives one row whose ``rule`` is NULL.  Equal texts give equal detections.
    """
    rule_set = rules() if rule_set is None else rule_set
    literals = [keyword(pattern) for _, _, pattern in rule_set]
    gates = sorted(set(literals))
    groups = [gates[i : i + 62] for i in range(0, len(gates), 62)]
    docs, row = numbered(docs)
    others = [c for c in docs.columns if c != text]
    lowered = docs.select(*others, _lower(whole(text)).alias("_lower"))
    rooted = _any_of(F.col("_lower"), sorted({root(k) for k in literals}))
    counted = lowered.select(
        *others, F.regexp_count("_lower", F.lit(WORD)).cast("bigint").alias("n_words"), F.when(rooted, F.col("_lower")).alias("_lower")
    )
    words = F.array_join(F.regexp_extract_all("_lower", F.lit(WORD), F.lit(0)), " ")
    joined = counted.select(*others, "n_words", F.concat(F.lit(" "), words, F.lit(" ")).alias("_norm"))

    # The rule table and the lookups are stated as text: built call by call they cost seconds.
    def gate(group: list[str]) -> Column:
        bits = [f"if(contains(_norm, '{literal}'), {1 << bit}L, 0L)" for bit, literal in enumerate(group)]
        return F.expr(f"if(_norm is null, 0L, {' | '.join(bits)})")

    gated = joined.select("*", *[gate(group).alias(f"_gate{i}") for i, group in enumerate(groups)])
    table = F.from_json(
        F.lit(
            json.dumps(
                [
                    {"rule": i, "group": gates.index(literal) // 62, "bit": 1 << (gates.index(literal) % 62), "pattern": f"(?<= )(?:{pattern})(?= )"}
                    for i, ((_, _, pattern), literal) in enumerate(zip(rule_set, literals))
                ]
            )
        ),
        "array<struct<rule int, `group` int, bit bigint, pattern string>>",
    )

    def open_(r: Column) -> Column:
        mask = F.col("_gate0")
        for i in range(1, len(groups)):
            mask = F.when(r["group"] == i, F.col(f"_gate{i}")).otherwise(mask)
        return mask.bitwiseAND(r["bit"]) != 0

    def run(r: Column) -> Column:
        """The rule's matches with the number of words between each and the one before it."""
        parts = F.arrays_zip(
            F.split("_norm", r["pattern"], -1).alias("gap"), F.regexp_extract_all("_norm", r["pattern"], F.lit(0)).alias("hit")
        )
        return F.transform(
            F.filter(parts, lambda p: p["hit"].isNotNull()),
            lambda p, i: F.struct(
                r["rule"].alias("rule"), i.alias("nth"), (_spaces(p["gap"]) - 1).alias("gap"), (_spaces(p["hit"]) + 1).alias("size"), p["hit"].alias("matched")
            ),
        )

    any_gate = F.lit(False)
    for i in range(len(groups)):
        any_gate = any_gate | (F.col(f"_gate{i}") != 0)
    hits = F.when(any_gate, F.flatten(F.transform(F.filter(table, open_), run)))
    found = gated.select(*others, "n_words", F.explode_outer(hits).alias("_hit")).select(*others, "n_words", "_hit.*")
    # All that follows needs the rows of one document together: one exchange of narrow rows.
    found = found.repartition(row)
    so_far = W.partitionBy(row, "rule").orderBy("nth")
    start = F.sum(F.col("gap") + F.col("size")).over(so_far) - F.col("size")
    found = found.withColumn("start_word", start).withColumn("end_word", F.col("start_word") + F.col("size"))
    priority = F.element_at(F.from_json(F.lit(json.dumps([r[1] for r in rule_set])), "array<int>"), F.col("rule") + 1)
    label = F.element_at(F.from_json(F.lit(json.dumps([r[0] for r in rule_set])), "array<string>"), F.col("rule") + 1)
    found = found.withColumn("priority", priority).withColumn("label", label)
    # In this order whatever contains a detection comes before it.
    before = (
        W.partitionBy(row).orderBy("start_word", F.desc("end_word"), "priority", "rule").rowsBetween(W.unboundedPreceding, -1)
    )
    covered = F.lit(False)
    for p in range(PRIORITIES):
        reach = F.max(F.when(F.col("priority") <= p, F.col("end_word"))).over(before)
        covered = covered | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end_word"), F.lit(False)))
    kept = F.when(F.col("rule").isNotNull(), ~covered)
    return found.select(*others, "n_words", "rule", "label", "priority", "start_word", "end_word", "matched", kept.alias("kept")), row


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its words, the places of the base phrases, and its license labels.

    NULL and empty texts have no words and no labels; their score is 0.  Repeated rows are
    scanned each for itself.  ``score`` is the confidence of the best detection that was kept.
    """
    found, row = detections(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    base = F.col("rule") < len(BASE_PHRASES)
    start = F.col("start_word").cast("bigint")
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    confidence = F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), F.col("priority") + 1)
    return (
        found.groupBy(row)
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, start)).alias("first_word"),
            F.max(F.when(base, start)).alias("last_word"),
            labels(base).alias("base_labels"),
            labels(base | F.col("kept")).alias("labels"),
            F.coalesce(F.max(F.when(F.col("kept") | base, confidence)), F.lit(0.0)).alias("score"),
            F.count(F.when(F.col("kept"), 1)).alias("n_kept"),
        )
        .drop(row)
    )
