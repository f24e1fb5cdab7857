"""Whitening of embeddings by exact integer statistics.

Entries become integers, so sums and products over the table are exact whatever the order of the
rows.  Tasks return a d x d matrix each; the scatter M = n sum(y y') - s s' (n^2 times the covariance)
is put together on the driver, which holds d^2 numbers and never a row.  Its characteristic
polynomial is worked out in one task per prime, and each component in a task of its own (``eigen``).
The table is read four times: sums, products, whitened covariance, result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidemark.llm import eigen
from tidemark.llm.common import fresh_name

MOST, SCALE, SHIFT = 32, 64, 1_000_000
_BITS = 96  # binary places of an eigenvalue of the scatter
_FIT = 2.0**62  # larger integers do not fit
_TOTAL = "decimal(38,0)"


@dataclass(frozen=True)
class Whitening:
    """What was learned: ``n`` vectors, their sums, and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: list[float]
    explained: list[float]
    identity_error: float

    @property
    def base(self) -> list[int]:
        """The integer below the mean; entries are counted from it so that they stay small."""
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """n times what is left of the mean."""
        return [s % self.n for s in self.sums]

    @property
    def weights(self) -> np.ndarray:
        return (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def _integers(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the places of the usable vectors and their integers, ``floor(64 c) + 1000000``."""
    out = {}
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy()
    for d in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == d)
        values = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        x = np.floor(values * SCALE)
        fine = (np.abs(x) < _FIT).all(axis=1)  # false where an entry is NULL, NaN or infinite
        if fine.any():
            out[d] = at[fine], x[fine].astype(np.int64) + SHIFT
    return out


def _added(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns."""
    largest = max(int(x.max()), -int(x.min()))
    return x.sum(axis=0).astype(object) if largest * len(x) < 2**62 else x.astype(object).sum(axis=0)


def _products(y: np.ndarray) -> np.ndarray:
    """Exact sums of the products of each two columns."""
    largest = max(int(y.max()), -int(y.min()), 1)
    rows = 2**53 // largest**2  # so many rows stay exact in doubles
    if not rows:
        y = y.astype(object)
        return y.T @ y
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), rows):
        part = y[at : at + rows].astype(float)
        total += np.rint(part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        for d, (_, x) in _integers(batch.column(0)).items():
            held = found.setdefault(d, [0, np.zeros(d, object)])
            held[0] += len(x)
            held[1] = held[1] + _added(x)
    for d, (n, sums) in found.items():
        yield _rows({"d": [d], "n": [n], "sums": [list(map(Decimal, sums))]}, "sums")


def _rows(columns: dict, decimals: str) -> pa.RecordBatch:
    """Integer columns, and one of lists of long integers."""
    kind = pa.list_(pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(v, kind) if k == decimals else pa.array(v, pa.int64()) for k, v in columns.items()], list(columns))


def _scatter(vectors: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """n^2 times the covariance, exact."""
    d = len(sums)
    base = np.array([s // n for s in sums], np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            for size, (_, x) in _integers(batch.column(0)).items():
                if size == d:
                    total += _products(x - base)
        if total.any():
            yield _rows({"i": list(range(d)), "row": [list(map(Decimal, row)) for row in total]}, "row")

    parts = vectors.mapInArrow(products, f"i bigint, row array<{_TOTAL}>")
    cells = parts.select("i", F.posexplode("row").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value"))
    rest = [s % n for s in sums]
    out = [[-a * b for b in rest] for a in rest]
    for cell in cells.collect():
        out[cell.i][cell.j] += n * int(cell.value)
    return out


def _polynomial(vectors: DataFrame, matrix: list[list[int]]) -> list[int]:
    spark = vectors.sparkSession
    primes = eigen.primes_for(matrix)

    def modular(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"p": batch["p"], "c": [eigen.polynomial_mod(matrix, int(p)) for p in batch["p"]]})

    spread = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    return eigen.combine({r.p: list(r.c) for r in spread.mapInPandas(modular, "p bigint, c array<bigint>").collect()})


def _components(vectors: DataFrame, matrix: list[list[int]], roots: list[tuple[int, int]]) -> np.ndarray:
    """One row per root; equal roots get orthogonal ones."""
    spark = vectors.sparkSession
    size: dict[int, int] = {}
    value = dict((group, root) for root, group in roots)
    for _, group in roots:
        size[group] = size.get(group, 0) + 1

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group in batch["g"].tolist():
                found = eigen.null_vectors(matrix, value[group], _BITS, size[group])
                yield pd.DataFrame({"g": [group] * len(found), "k": range(len(found)), "v": found.tolist()})

    spread = spark.createDataFrame([(g,) for g in size], "g bigint").repartition(min(len(size), spark.sparkContext.defaultParallelism), "g")
    rows = spread.mapInPandas(solved, "g bigint, k bigint, v array<double>").collect()
    return np.array([r.v for r in sorted(rows, key=lambda r: (r.g, r.k))])


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    k = len(model.eigenvalues)

    def covariance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))  # the last row: sums
        for batch in batches:
            for _, w, _ in _whitened(batch.column(0), model):
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    parts = vectors.mapInArrow(covariance, "i bigint, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    found = np.zeros((k + 1, k))
    for cell in cells:
        found[cell.i, cell.j] = cell.value
    mean = found[k] / model.n
    return float(np.abs(found[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _whitened(vectors: pa.Array, model: Whitening) -> Iterator[tuple[np.ndarray, np.ndarray, list[int] | np.ndarray]]:
    """Places, whitened vectors and deviations of the usable vectors."""
    d, n = len(model.sums), model.n
    found = _integers(vectors)
    if d not in found:
        return
    at, x = found[d]
    y = x - np.array(model.base, np.int64)
    rest = np.array(model.rest, np.int64)
    w = (y - rest / n) @ model.weights
    largest = max(int(y.max()), -int(y.min()))
    if (n * (largest + 1)) ** 2 * d < 2**62:
        deviation = ((n * y - rest) ** 2).sum(axis=1).astype(object)
    else:
        y = y.astype(object)
        deviation = ((y * n - rest.astype(object)) ** 2).sum(axis=1)
    yield at, w, deviation


def _fit_size(vectors: DataFrame) -> tuple[int, list[int]] | None:
    """Number and sums of the vectors of the most frequent length, the longer one of two."""
    parts = vectors.mapInArrow(_sums, f"d bigint, n bigint, sums array<{_TOTAL}>")
    counts = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if counts is None:
        return None
    each = parts.filter(F.col("d") == counts.d).select(F.posexplode("sums").alias("j", "value"))
    sums = each.groupBy("j").agg(F.sum("value").alias("value")).collect()
    return counts.n, [int(r.value) for r in sorted(sums, key=lambda r: r.j)]


def fit(vectors: DataFrame, vector: str | Column = "embedding", most: int = MOST) -> Whitening | None:
    """The whitening of a table's vectors; None if there is no usable vector.

    A vector is usable if it is not NULL and holds neither NULL nor non-finite entries, nor any whose
    integer does not fit 63 bits.  Vectors must have one length; where a table mixes lengths, the most
    frequent one counts (the longer of two equally frequent) and other vectors are left out.
    There are as many components as positive eigenvalues, at most ``most``.  Equal eigenvalues
    get any orthogonal components of their space.
    """
    vectors = vectors.select((F.col(vector) if isinstance(vector, str) else vector).cast("array<double>").alias("vector"))
    size = _fit_size(vectors)
    if size is None:
        return None
    n, sums = size
    matrix = _scatter(vectors, n, sums)
    trace = sum(matrix[i][i] for i in range(len(sums)))
    if not trace:
        return Whitening(n, sums, np.zeros((0, len(sums))), [], [], 0.0)
    roots = eigen.largest_roots(_polynomial(vectors, matrix), most, _BITS)
    components = _components(vectors, matrix, roots)
    values = [float(Fraction(root, n * n << _BITS)) for root, _ in roots]
    explained = [float(Fraction(root, trace << _BITS)) for root, _ in roots]
    model = Whitening(n, sums, components, values, explained, 0.0)
    return Whitening(n, sums, components, values, explained, _identity_error(vectors, model))


def transform(rows: DataFrame, model: Whitening | None, vector: str = "embedding") -> tuple[DataFrame, str]:
    """The rows with usable vectors, and the name of a column ``(deviation, whitened)`` added to them.

    ``whitened`` is an array with one entry per component, ``deviation`` the exact squared distance
    from the mean times n^2, NULL if it has more than 38 digits.
    """
    column = fresh_name(rows, "white")
    kind = f"struct<deviation: {_TOTAL}, whitened: array<double>>"
    if model is None:
        return rows.filter("false").withColumn(column, F.lit(None).cast(kind)), column
    source = fresh_name(rows, "vector")
    ready = rows.withColumn(source, F.col(vector).cast("array<double>"))
    schema = StructType(list(rows.schema.fields)).add(column, _parse_datatype_string(kind))
    width = len(model.eigenvalues)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, w, deviation in _whitened(batch.column(batch.num_columns - 1), model):
                kept = batch.take(pa.array(at))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * width), pa.array(w.ravel()))
                exact = pa.array([Decimal(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0))
                added = pa.StructArray.from_arrays([exact, lists], ["deviation", "whitened"])
                yield pa.RecordBatch.from_arrays([*kept.columns[:-1], added], [*kept.schema.names[:-1], column])

    return ready.mapInArrow(whiten, schema), column


def whitening_report(embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", most: int = MOST) -> DataFrame:
    """A row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Repeated rows are vectors of their own.  ``deviation`` is NULL where it does not fit a long.
    Without a usable vector, or if all are equal, there is no component and no row.
    """
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("embedding"))
    model = fit(rows, most=most)
    found, white = transform(rows, model)
    explained = F.array(*(F.lit(x) for x in model.explained)) if model and model.explained else F.array().cast("array<double>")
    each = found.select("vec_id", F.col(white)["deviation"].alias("deviation"), F.posexplode(F.col(white)["whitened"]).alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
