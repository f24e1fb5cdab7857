"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on what the trees before leave unexplained; each of their paths is a rule,
a conjunction of comparisons.  A logistic model with a lasso penalty keeps few of the rules and
weighs them, and the whole model is compiled into one column expression over the statistics.

Statistics are computed in one pass over the texts and stored; learning and scoring both read
that narrow table.  The model is fitted on at most ``SAMPLE`` labelled rows, on the driver.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm.chars import PIECE
from tidemark.llm.common import whole
from tidemark.llm.sampling import bounded, labelled, to_pandas

SAMPLE = 20_000  # labelled rows the model is fitted on
TREES, DEPTH, CUTS = 40, 3, 16
LASSO = 1e-3
THRESHOLD = 0.3

STATISTICS = (
    "log_chars", "letters", "upper", "digits", "blanks", "marks", "symbols", "log_words", "word_length", "longest_word",
    "distinct_words", "top_word", "capital_words", "marked_words", "bare_marks", "lines", "distinct_lines", "line_length", "ended_lines",
    "repeated_pairs",
)


def _class_table() -> np.ndarray:
    """Kinds of code points: 0 symbol, 1 lower or uncased letter, 2 upper, 3 digit, 4 blank, 5 punctuation."""
    table = np.zeros(0x10000, np.uint8)
    for code in range(0x10000):
        c = chr(code)
        table[code] = 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 4 if c.isspace() else 5 if c in ".,;:!?'\"()-" else 0
    return table


_CLASSES = _class_table()


def statistics(text: str | None) -> list[float]:
    """The numbers a text is judged by; all 0 for NULL and empty texts."""
    text = text or ""
    if not text:
        return [0.0] * len(STATISTICS)
    kinds = np.zeros(6, np.int64)
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "replace"), np.uint32)
        kinds += np.bincount(_CLASSES[np.minimum(codes, 0xFFFF)], minlength=6)
    n = len(text)
    letters = max(1, kinds[1] + kinds[2])
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    k = max(1, len(lines))
    last = [w[-1] for w in words]
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log1p(n)), (kinds[1] + kinds[2]) / n, kinds[2] / letters, kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[0] / n,
        float(np.log1p(len(words))), sum(map(len, words)) / m, float(max(map(len, words), default=0)),
        len(counts) / m, max(counts.values(), default=0) / m,
        sum(w.isupper() and len(w) > 1 for w in words) / m, sum(not c.isalnum() and c not in ".,;:!?'\")" for c in last) / m,
        sum(not any(map(str.isalnum, w)) for w in words) / m,
        float(np.log1p(len(lines))), len(set(lines)) / k, n / k, sum(line.rstrip()[-1] in ".!?" for line in lines) / k,
        1 - len(pairs) / max(1, len(words) - 1),
    ]


def with_statistics(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` without the text, and its statistics."""
    schema = ", ".join(f"{name} double" for name in STATISTICS)

    @F.pandas_udf(schema)
    def udf(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS), dtype=float)

    others = [c for c in rows.columns if c != text]
    return rows.select(*others, udf(whole(text)).alias("_s")).select(*others, "_s.*")


# A rule is a tuple of (statistic, is greater, threshold).
Rule = tuple[tuple[int, bool, float], ...]


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: list[tuple[Rule, float]]  # with their weights

    def score(self) -> Column:
        """The probability of label 1 as an expression over the statistics."""
        total = f"{self.intercept!r}D"
        for rule, weight in self.rules:
            tests = " and ".join(f"{STATISTICS[i]} {'>' if above else '<='} {cut!r}D" for i, above, cut in rule)
            total += f" + if({tests}, {weight!r}D, 0D)"
        return F.expr(f"1 / (1 + exp(-({total})))")


def _grow(bins: np.ndarray, cuts: list[np.ndarray], target: np.ndarray, rows: np.ndarray, depth: int, path: Rule, out: list[Rule]) -> np.ndarray:
    """Splits ``rows`` where it explains most of ``target``; adds the paths and returns the fit."""
    fit = np.full(len(rows), target[rows].mean() if len(rows) else 0.0)
    if depth == 0 or len(rows) < 20:
        return fit
    y, best = target[rows], (1e-9, None)
    total, n = y.sum(), len(rows)
    for i, edges in enumerate(cuts):
        if len(edges):
            b = bins[rows, i]
            count = np.cumsum(np.bincount(b, minlength=len(edges) + 1))[:-1]
            sums = np.cumsum(np.bincount(b, weights=y, minlength=len(edges) + 1))[:-1]
            ok = (count >= 5) & (n - count >= 5)
            gain = np.where(ok, sums**2 / np.maximum(count, 1) + (total - sums) ** 2 / np.maximum(n - count, 1) - total**2 / n, 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (i, k))
    if best[1] is None:
        return fit
    i, k = best[1]
    high = bins[rows, i] > k
    for side in (False, True):
        rule = (*path, (i, side, float(cuts[i][k])))
        out.append(rule)
        fit[high == side] = _grow(bins, cuts, target, rows[high == side], depth - 1, rule, out)
    return fit


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for i, above, cut in rule:
        hit &= (x[:, i] > cut) == above
    return hit


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty, by accelerated proximal steps."""
    n, k = x.shape
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = (x - mean) / spread
    step = 4 / max(1e-9, np.linalg.norm(z, 2) ** 2 / n + 1)
    w, b, v, c, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30))) - y
        new = v - step * (z.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = c - step * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    return float(b - (w / spread) @ mean), w / spread


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = LASSO, seed: int = 7) -> Ensemble:
    """The ensemble for statistics ``x`` and labels ``y``; a constant when one label is missing."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    if len(set(y.tolist())) < 2:
        return Ensemble(float(np.log(rate / (1 - rate))), [])
    cuts = []
    for i in range(x.shape[1]):
        quantiles = np.unique(np.quantile(x[:, i], np.linspace(0, 1, CUTS + 1)[1:-1]))
        tails = np.unique(np.quantile(x[:, i], [0.01, 0.02, 0.98, 0.99]))
        cuts.append(np.unique(np.r_[quantiles, tails]))
    bins = np.stack([np.searchsorted(edges, x[:, i], side="left") for i, edges in enumerate(cuts)], 1)
    draw, rules = np.random.default_rng(seed), []
    log_odds = np.full(len(y), np.log(rate / (1 - rate)))
    for _ in range(trees):
        residual = y - 1 / (1 + np.exp(-log_odds))
        part = np.sort(draw.choice(len(y), min(len(y), max(20, len(y) // 2)), replace=False))
        grown: list[Rule] = []
        _grow(bins, cuts, residual, part, depth, (), grown)
        rules += grown
        # The step of the boosting: each leaf, which is a longest path, moves its rows.
        leaves = [r for r in grown if not any(len(o) > len(r) and o[: len(r)] == r for o in grown)]
        for leaf in leaves:
            rows = _covers(leaf, x)
            p = 1 / (1 + np.exp(-log_odds[rows]))
            log_odds[rows] += 0.3 * np.clip(residual[rows].sum() / ((p * (1 - p)).sum() + 1), -4, 4)
    rules = list(dict.fromkeys(rules))
    if not rules:  # too few rows to split
        return Ensemble(float(np.log(rate / (1 - rate))), [])
    covered = np.stack([_covers(r, x) for r in rules], 1).astype(float)
    _, first = np.unique(covered, axis=1, return_index=True)  # rules that cover the same rows count once
    rules, covered = [rules[i] for i in sorted(first)], covered[:, sorted(first)]
    intercept, weights = _lasso(covered, y, penalty)
    return Ensemble(intercept, [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Rows whose crc32(id as text) mod 5 is 0 are held out of learning; a NULL id is neither held
    out nor labelled.  ``score`` is the probability of label 1, for NULL and empty texts too, and
    ``predicted`` is 1 from ``THRESHOLD`` on.  Without labels every score is 0.5.
    """
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    stats = written(with_statistics(rows), "statistics")
    learn = labelled(stats.filter(~F.col("held_out")), labels.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else labels, label)
    frame = to_pandas(bounded(learn.select("doc_id", "label", *STATISTICS), sample, "doc_id", "label", *STATISTICS))
    model = fit(frame[list(STATISTICS)].to_numpy(float), frame["label"].to_numpy(float))
    return stats.select("doc_id", "held_out", model.score().alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
