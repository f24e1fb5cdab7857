"""Toxicity: undo obfuscation as a noisy channel, then score the restored text.

Disguised words ("1d10t", "stuuupid", "l o s e r") are decoded by Viterbi: every token that looks
tampered with becomes a lattice of the letters it may stand for, and the path that a character
trigram model of the corpus finds most likely, less the costs of the channel, is the word meant.
Untampered text passes as it is.

The trigram counts cover every text: they are added up per task and then per trigram.  The
scorer is a logistic model over character 5-grams of restored text, their presence and their
rate, fitted on at most ``SAMPLE`` labelled rows.  The tasks are sent 28 x 28 x 28 trigram weights and
``FEATURES`` gram weights, whatever the size of the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm.chars import letter_codes, pieces
from tidemark.llm.common import whole
from tidemark.llm.sampling import bounded, labelled

SAMPLE = 12_000  # labelled rows the scorer is fitted on; with FEATURES, about 100 MB on the driver
BUCKETS = 1 << 17  # hashed 5-grams
FEATURES = 500  # 5-grams that are weighed
GRAM = 5
THRESHOLD = 0.3

# Letters that digits and signs are commonly used for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
# Costs of the channel, as negative log probabilities.
SWAPPED, DROPPED_LEET, DROPPED_SIGN, DROPPED_REPEAT, DROPPED_SPACE, KEPT_SPACE = 1.0, 12.0, 2.5, 0.5, 0.2, 1.5
_SIGNS = re.escape("".join(c for c in LEET if not c.isdigit()) + ".*-_~^")
_SPACERS = " .*-_~"

_TOKEN = re.compile(rf"[^\W_](?:[\w{_SIGNS}]*[^\W_])?|[{_SIGNS}][^\W_][\w{_SIGNS}]*[^\W_]")
_SPACED = re.compile(rf"(?<!\w)(?:[\w@$!|+][{re.escape(_SPACERS)}]){{3,}}[\w@$!|+](?!\w)")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_MIXED = re.compile(r"[^\W\d_][0-9@$!|+€£.*\-_~^]+[^\W\d_]|(?<![\w])[0-9@$!|+€£][^\W\d_]{2}")


# --- the character model ------------------------------------------------------------------


def _symbol(c: str) -> int:
    """0 for a word border, 1-26 for a-z, 27 for any other letter."""
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def _symbols(codes: np.ndarray) -> np.ndarray:
    out = np.where(codes == 32, 0, 27)
    plain = (codes >= 97) & (codes <= 122)
    return np.where(plain, codes.astype(np.int64) - 96, out)


def trigram_counts(texts: DataFrame) -> np.ndarray:
    """Counts of symbol trigrams over the whole column ``text``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(28**3, np.int64)
        for batch in batches:
            for text in batch["text"]:
                for piece in pieces(text or ""):
                    s = _symbols(letter_codes(piece))
                    total += np.bincount(s[:-2] * 784 + s[1:-1] * 28 + s[2:], minlength=28**3)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    counts = np.zeros(28**3, np.int64)
    for gram, n in texts.mapInPandas(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n")).collect():
        counts[gram] = n
    return counts


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a symbol after two others, mixed with that after one."""
    tri = counts.reshape(28, 28, 28).astype(float)
    bi = tri.sum(axis=0)
    one = (bi + 0.5) / (bi + 0.5).sum(axis=1, keepdims=True)
    return np.log((tri + 2 * one) / (tri.sum(axis=2, keepdims=True) + 2))


# --- decoding -----------------------------------------------------------------------------


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest spelling behind ``token``: Viterbi over the lattice of what each sign may be."""
    token = token.lower()
    # A state is the last two symbols written; each keeps its best score and a back pointer.
    states: dict[tuple[int, int], tuple[float, int]] = {(0, 0): (0.0, -1)}
    trail: list[tuple[str, int]] = []  # what was written, and the entry before
    for i, c in enumerate(token):
        same = i > 0 and token[i - 1] == c
        run = same and (i > 1 and token[i - 2] == c or i + 1 < len(token) and token[i + 1] == c)
        letters = [(c, 0.0)] if c.isalpha() else []
        letters += [(other, SWAPPED) for other in LEET.get(c, "")]
        silent = DROPPED_REPEAT if run and c.isalpha() else None
        if not c.isalpha():
            silent = DROPPED_SPACE if c in _SPACERS else DROPPED_LEET if c in LEET else DROPPED_SIGN
            if c in _SPACERS or c not in LEET:
                letters.append((c, KEPT_SPACE))  # stays, as a word border
        after: dict[tuple[int, int], tuple[float, int]] = {}
        for (a, b), (score, back) in states.items():
            options = [((a, b), score - silent, back)] if silent is not None else []
            for written_, cost in letters:
                s = _symbol(written_)
                if s == 0 and b == 0:
                    key, gain = (a, b), 0.0
                else:
                    key, gain = (b, s), model[a, b, s]
                options.append((key, score + gain - cost, written_))
            for key, value, what in options:
                if key not in after or value > after[key][0]:
                    if isinstance(what, str):
                        trail.append((what, back))
                        what = len(trail) - 1
                    after[key] = (value, what)
        states = after
    _, at = max(((score + model[a, b, 0] if b else score), back) for (a, b), (score, back) in states.items())
    out = []
    while at >= 0:
        what, at = trail[at]
        out.append(what)
    return "".join(reversed(out))


def restorer(model: np.ndarray, remember: int = 50_000):
    """A function that restores whole texts; distinct tokens are decoded once while remembered."""
    known: dict[str, str] = {}

    def meant(match: re.Match) -> str:
        token = match[0]
        if len(token) < 2 or not (_TRIPLE.search(token) or _MIXED.search(token)):
            return token
        key = token.lower()
        if key not in known:
            if len(known) >= remember:
                known.clear()
            known[key] = decode(key, model)
        return known[key]

    def restore(text: str) -> str:
        if _SPACED.search(text):
            text = _SPACED.sub(lambda m: decode(m[0], model), text)
        if _TRIPLE.search(text) or _MIXED.search(text):
            text = _TOKEN.sub(meant, text)
        return text

    return restore


# --- scoring ------------------------------------------------------------------------------


def grams(text: str) -> np.ndarray:
    """Hash buckets of the 5-grams, repeats included."""
    out = []
    for piece in pieces(text):
        codes = letter_codes(piece)
        n = len(codes) - GRAM + 1
        if n > 0:
            h = np.zeros(n, np.uint32)
            for k in range(GRAM):
                h = (h ^ codes[k : k + n]) * np.uint32(2654435761)
                h ^= h >> np.uint32(15)
            out.append((h & np.uint32(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _features(text: str, slots: np.ndarray, k: int) -> np.ndarray:
    """Presence and rate of the chosen grams."""
    h = grams(text)
    counts = np.bincount(slots[h], minlength=k + 1)[1:] if len(h) else np.zeros(k, np.int64)
    return np.r_[counts > 0, np.log1p(1000 * counts / max(1, len(h)))].astype(np.float32)


@dataclass(frozen=True)
class Scorer:
    chosen: np.ndarray  # buckets
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str]) -> np.ndarray:
        k = len(self.chosen)
        slots = np.zeros(BUCKETS, np.int64)
        slots[self.chosen] = np.arange(1, k + 1)
        logits = np.array([_features(t, slots, k) @ self.weights for t in texts], float) + self.intercept
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 3e-3, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Ridge-penalised logistic weights by accelerated steps; ``x`` is scaled in place."""
    n, k = x.shape
    spread = np.maximum(x.std(axis=0), 1e-2)
    z = x
    z /= spread  # in place: the sample is held once
    draw = np.random.default_rng(3).normal(size=k).astype(np.float32)
    for _ in range(12):  # largest eigenvalue, for the step
        draw = z.T @ (z @ draw) / n
        top = float(np.linalg.norm(draw))
        draw /= max(top, 1e-12)
    step = 1 / (0.3 * top + 0.25 + ridge)
    w, b, v, c, t = np.zeros(k, np.float32), 0.0, np.zeros(k, np.float32), 0.0, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30))) - y
        new, new_b = v - step * (z.T @ error.astype(np.float32) / n + ridge * v), c - step * float(error.mean())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = (new + (t - 1) / t_next * (new - w)).astype(np.float32), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new.astype(np.float32), new_b, t_next
    return b, w / spread


def fit(learn: DataFrame, rows: int) -> Scorer:
    """Fits the scorer on the columns ``restored`` and ``label`` of a bounded, stored sample."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, BUCKETS))
        for batch in batches:
            for text, label in zip(batch["restored"], batch["label"]):
                h, n = np.unique(grams(text), return_counts=True)
                rate = np.log1p(1000 * n / max(1, n.sum()))
                for row, values in ((0, 1), (2, rate), (4, rate**2)):
                    total[row + label, h] += values
        at = np.flatnonzero(total.any(axis=0))
        yield pd.DataFrame({"gram": at} | {f"t{i}": total[i, at] for i in range(6)})

    columns = [f"t{i}" for i in range(6)]
    sums = learn.mapInPandas(summed, "gram bigint, " + ", ".join(f"{c} double" for c in columns)).groupBy("gram").agg(*[F.sum(c).alias(c) for c in columns])
    ones = learn.filter("label = 1").count()
    zeros = rows - ones
    rate = (ones + 0.5) / (rows + 1)
    if not ones or not zeros:
        return Scorer(np.zeros(0, np.int64), np.zeros(0, np.float32), float(np.log(rate / (1 - rate))))
    found = sums.toPandas().sort_values("gram")  # at most one row per bucket
    t = found[columns].to_numpy().T
    pull = lambda one, zero, one2, zero2: (one / ones - zero / zeros) / np.sqrt(np.maximum(one2 / ones - (one / ones) ** 2, 0) / ones + np.maximum(zero2 / zeros - (zero / zeros) ** 2, 0) / zeros + 1e-4 / rows + 1e-6)
    strength = np.maximum(np.abs(pull(t[1], t[0], t[1], t[0])), np.abs(pull(t[3], t[2], t[5], t[4])))
    strength[t[0] + t[1] < 4] = 0
    order = np.lexsort((found["gram"].to_numpy(), -strength))
    chosen = np.sort(found["gram"].to_numpy()[order[:FEATURES]])
    k = len(chosen)
    slots = np.zeros(BUCKETS, np.int64)
    slots[chosen] = np.arange(1, k + 1)

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [_features(r, slots, k).astype(np.float16).tobytes() for r in batch["restored"]], "label": batch["label"]})

    frame = learn.mapInPandas(embed, "x binary, label int").toPandas().sort_values(["label", "x"])
    y = frame["label"].to_numpy(float)
    x = np.empty((len(frame), 2 * k), np.float32)
    for i, v in enumerate(frame.pop("x")):
        x[i] = np.frombuffer(v, np.float16)
    intercept, weights = _logistic(x, y)
    return Scorer(chosen, weights, float(intercept))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Rows whose crc32(id as text) mod 4 is 2 are held out of learning; a NULL id is neither held
    out nor labelled.  ``score`` is the probability of label 1, for NULL and empty texts too, and
    ``predicted`` is 1 from ``THRESHOLD`` on.  Without labels every score is 0.5.  At most ``sample``
    labels are learned from, and at most twice as many rows where ids repeat.
    """
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), whole(text).alias("text"))
    model = log_model(trigram_counts(rows.select("text")))
    # The draw is made on ids before any text is read for learning.
    marks = labelled(rows.filter(~F.col("held_out")).select("doc_id"), labels.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else labels, label)
    marks = written(bounded(marks, sample, "doc_id", "label").groupBy("doc_id", "label").agg(F.count("*").alias("_times")), "toxic-sample")

    @F.pandas_udf("string")
    def restored(texts: pd.Series) -> pd.Series:
        restore = restorer(model)
        return pd.Series([restore(t) for t in texts], dtype=object)

    # Rows that repeat an id may be many more than the marks; they are drawn from by their texts.
    learn = written(rows.filter(~F.col("held_out")).select("doc_id", "text").join(marks, "doc_id"), "toxic-learning")
    learn = bounded(learn, 2 * sample, "doc_id", "label", "text")
    learn = written(learn.select(restored("text").alias("restored"), "label"), "toxic-restored")
    scorer = fit(learn, learn.count())

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restore = restorer(model)
        for texts in batches:
            yield pd.Series(scorer.scores([restore(t) for t in texts]))

    return rows.select("doc_id", "held_out", score("text").alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
