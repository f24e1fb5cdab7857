"""Language identification by nearest centroids of TF-IDF character n-grams.

A text becomes a unit vector: its hashed n-grams of one to three characters, weighted by
1 + log(count) and by inverse document frequency.  Each language has several centroids, found by
spherical k-means, and a text gets the language of the centroid with the largest cosine.  A
text that lies far further from every centroid than the texts the centroid was made of is
rejected.

Document frequencies come from all learning rows, added up per task and then per n-gram.  The
centroids are fitted on a bounded sample: at most ``SAMPLE`` learning rows, shared out evenly
between the languages.  What the tasks are sent is LANGUAGES x ``CENTROIDS`` x ``DIMENSIONS`` floats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.chars import letter_codes, pieces
from tidemark.llm.common import whole

DIMENSIONS = 4096  # hashed n-grams; a power of two
CENTROIDS = 4  # per language
SAMPLE = 4000  # learning rows the centroids are fitted on
REJECT = 0.15  # a text is rejected below this share of the cosine that 99 of 100 sample texts reach
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def ngram_counts(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of the hashed n-grams of the whole text."""
    out, mask = np.zeros(dimensions, np.int64), np.uint32(dimensions - 1)
    for piece in pieces(text or ""):
        codes = letter_codes(piece)
        grams = codes * np.uint32(2654435761)
        for n in (1, 2, 3):
            if n > 1:
                grams = grams[:-1] * np.uint32(40503) + codes[n - 1 :] * np.uint32(2246822519)
            h = grams ^ (grams >> np.uint32(15))
            h = h * np.uint32(2654435761)
            out += np.bincount((h >> np.uint32(12)) & mask, minlength=dimensions)
    return out


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors, one row each; a text without letters gives a zero row."""
    out = np.zeros((len(texts), len(idf)), np.float32)
    for i, text in enumerate(texts):
        if text:
            counts = ngram_counts(text, len(idf))
            row = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
            size = np.sqrt((row**2).sum())
            out[i] = row / size if size > 0 else 0
    return out


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    languages: list[str]  # of each centroid
    floors: np.ndarray  # the smallest cosine of each centroid that is not rejected

    def best(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each text."""
        names, cosines, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for at in range(0, len(texts), 256):
            part = texts[at : at + 256]
            near = vectors(part, self.idf) @ self.centroids.T if len(self.centroids) else np.zeros((len(part), 0))
            for i, text in enumerate(part):
                if not len(self.centroids) or not has_letter(text):
                    names.append(UNKNOWN)
                    continue
                k = int(near[i].argmax())
                names.append(self.languages[k])
                cosines[at + i] = min(1.0, max(0.0, float(near[i, k])))
                rejected[at + i] = near[i, k] < self.floors[k]
        return names, cosines, rejected


def _clusters(rows: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out starts; unit centroids and each row's cluster."""
    starts = [0]
    nearest = rows @ rows[0]
    while len(starts) < min(k, len(rows)):
        starts.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, rows @ rows[starts[-1]])
    centers, own = rows[starts].copy(), np.zeros(len(rows), int)
    for _ in range(rounds):
        own = (rows @ centers.T).argmax(axis=1)
        for c in range(len(centers)):
            if (own == c).any():
                mean = rows[own == c].mean(axis=0)
                centers[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centers, own


def draw_below(each: int, n: int) -> int | None:
    """The bound on a signed 64-bit hash that lets at least ``each`` of ``n`` rows through, at any n; None for all.

    So many more are let through that the draw all but never falls short; the first ``each`` count.
    """
    most = each + 6 * math.isqrt(each) + 16
    return None if most >= n else -(1 << 63) + -(-(most << 64) // n)


def fit(learn: DataFrame, dimensions: int = DIMENSIONS, centroids: int = CENTROIDS, sample: int = SAMPLE, reject: float = REJECT) -> Model:
    """Learns from the columns ``key``, ``text`` and ``lang``; rows without a language are left out.

    ``key`` and the text decide which rows are sampled.  Without any usable row the model knows no language.
    """
    learn = learn.filter(F.col("lang").isNotNull()).select("key", whole("text").alias("text"), "lang")

    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, rows = np.zeros(dimensions, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                seen += ngram_counts(text, dimensions) > 0
            rows += len(batch)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"gram": np.r_[-1, at], "n": np.r_[rows, seen[at]]})

    found = learn.select("text").mapInPandas(presence, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    rows, df = 0, np.zeros(dimensions)
    for gram, n in found:  # at most one row per dimension
        if gram < 0:
            rows = n
        else:
            df[gram] = n
    idf = np.log((1 + rows) / (1 + df)) + 0.1
    # An even share of the sample for each language, chosen by a hash of the row.
    sizes = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()}
    each = max(1, sample // max(1, len(sizes)))
    wanted = F.lit(False)
    for lang, n in sizes.items():
        own = F.col("lang") == lang
        wanted = wanted | (own if (bound := draw_below(each, n)) is None else own & (F.col("draw") < F.lit(bound)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", F.xxhash64("text")))
    drawn_rows = learn.withColumn("draw", F.xxhash64("key", "text", F.lit("language sample"))).filter(wanted)
    chosen = drawn_rows.withColumn("place", place).filter(F.col("place") <= each).select("lang", "text")

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                yield pd.DataFrame({"lang": [lang], "v": [vectors([text], idf)[0].astype(np.float16).tobytes()]})

    drawn = chosen.mapInPandas(embed, "lang string, v binary").toPandas()
    centers, names, floors = [], [], []
    for lang, part in sorted(drawn.groupby("lang"), key=lambda x: x[0]):
        rows_ = np.stack([np.frombuffer(v, np.float16) for v in part["v"]]).astype(np.float32)
        rows_ = rows_[rows_.any(axis=1)]
        if not len(rows_):
            continue
        got, own = _clusters(rows_, centroids)
        near = np.einsum("ij,ij->i", rows_, got[own])
        for c in range(len(got)):
            if (own == c).any():
                centers.append(got[c])
                names.append(lang)
                floors.append(reject * float(np.quantile(near, 0.01)))
    return Model(idf.astype(np.float32), np.array(centers, np.float32).reshape(-1, dimensions), names, np.array(floors, np.float32))


def predict(model: Model, text: Column) -> Column:
    """A struct of ``lang``, ``score`` (the cosine) and ``rejected``."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def udf(texts: pd.Series) -> pd.DataFrame:
        names, cosines, rejected = model.best(list(texts))
        return pd.DataFrame({"lang": names, "score": cosines, "rejected": rejected})

    return udf(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, rejected``.

    Rows whose crc32(id as text) mod 3 is 1 are held out of learning; a NULL id is not held out.
    ``lang_pred`` is a learned language, or ``und`` when the text is NULL, has no letter, or no
    language could be learned.  ``score`` is the cosine to the nearest centroid.
    """
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), held.alias("held_out"))
    model = fit(rows.filter(~F.col("held_out")).select(F.col("doc_id").alias("key"), "text", "lang"))
    found = rows.select("doc_id", "held_out", predict(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected; texts without a letter are."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = fit(docs.filter(~held).select(F.col(id_col).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")))
    if not len(model.centroids):

        @F.pandas_udf("boolean")
        def lettered(texts: pd.Series) -> pd.Series:
            return texts.map(has_letter)

        return docs.filter(lettered(F.col(text)))
    return docs.filter(~predict(model, F.col(text))["rejected"])
