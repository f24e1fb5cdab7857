"""Global order and hot-key safe neighbours without single-task windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType

from tidemark.functions.scratch import written

RANGES = 4096  # ranges a histogram is made of
FEW = 10_000  # rows that the driver may sort


def global_row_number(df: DataFrame, *numberings: tuple[str, list[Column]], stored: bool = False) -> DataFrame:
    """Add 1-based positions in total orders.

    Each numbering is ``(name, order columns)``; the order must be total.  Rows are
    range-partitioned, numbered inside each range, and shifted by the number of rows
    in the ranges before it, so no task ever holds the whole input.  The ranged rows
    are written out: the counts and the numbering have to see the same ranges.  So is
    the input, unless the caller has ``stored`` it, as ranging reads it twice.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df if stored else written(df, "rank-input")
    for name, order in numberings:
        ranged = written(
            df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), f"rank-{name}"
        )
        counts = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
        # One row per range: at most `ranges` rows in this window.
        before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
        offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
        inside = F.row_number().over(W.partitionBy("_range").orderBy(*order))
        df = (
            ranged.withColumn("_inside", inside)
            .join(offsets, "_range")
            .withColumn(name, F.col("_inside") + F.col("_before"))
            .drop("_range", "_inside", "_before")
        )
    return df


@dataclass
class _Border:
    """The last row of a tile, somewhere among ``rows`` rows whose number lies in [low, high].

    ``place`` is its position among them.  Once the measure is known (``value``), low and
    high are keys.
    """

    measure: str
    place: int
    rows: int
    low: int
    high: int
    value: int | None = None

    @property
    def number(self) -> Column:
        return F.col(self.measure if self.value is None else "_tile_key")

    @property
    def holds(self) -> Column:
        inside = self.number.between(self.low, self.high)
        return inside if self.value is None else inside & (F.col(self.measure) == self.value)

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // RANGES)

    def same_range(self) -> tuple:
        return self.measure, self.value, self.low, self.high


def _as_long(column: str, kind) -> Column:
    """An integer in the order of the column."""
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, DecimalType):
        return (F.col(column) * F.lit(10**kind.scale).cast(f"decimal({kind.scale + 1},0)")).cast("bigint")
    if isinstance(kind, IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"{column}: dates, decimals and integers can be put in tiles, {kind.simpleString()} cannot")


def with_tiles(df: DataFrame, key: str, tiles: int, **measures: tuple[str, bool]) -> DataFrame:
    """``df`` with NTILE(``tiles``) columns: ``score=("amount", True)`` ranks by amount, descending.

    Ties go by ``key``, which must be a unique integer.  NULL is the smallest value.  Nothing is sorted and
    no row is numbered: a tile is known by its last row, so ``tiles - 1`` rows per measure decide.
    Histograms of all measures, made together, narrow down the ranges that hold
    these rows, by value and then by key, until they hold few enough rows to look at.  The
    number of histograms grows with the digits of a value, not with the rows; most data need one.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    codes = {name: F.when(F.lit(descending), -_as_long(c, kinds[c])).otherwise(_as_long(c, kinds[c])) for name, (c, descending) in measures.items()}
    code = {name: f"_code_{name}" for name in measures}
    seen = Observation()
    ends = [f(code[name]).alias(f"{what}_{name}") for name in measures for what, f in (("lo", F.min), ("hi", F.max))]
    stored = written(
        df.withColumns({code[name]: c for name, c in codes.items()}).observe(seen, F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"), *ends),
        "tiles",
    )
    known = seen.get
    rows = known["rows"]
    if not rows:
        return stored.drop(*code.values()).withColumns({name: F.lit(None).cast("int") for name in measures})
    borders: dict[str, list[_Border]] = {}
    nulls = {}
    for name, (_, descending) in measures.items():
        lo, hi = known[f"lo_{name}"] or 0, known[f"hi_{name}"] or 0
        nulls[code[name]] = hi + 1 if descending else lo - 1
        places = {k * (rows // tiles) + min(k, rows % tiles) for k in range(1, tiles)} - {0, rows}
        borders[name] = [_Border(code[name], place, rows, lo - 1, hi + 1) for place in sorted(places)]
    # NULL takes the place before the smallest number, as a key too.
    first_key, last_key = (known["lo"] or 0) - 1, known["hi"] or 0
    stored = stored.withColumn("_tile_key", F.coalesce(F.col(key).cast("bigint"), F.lit(first_key))).fillna(nulls)
    open_ = [b for found in borders.values() for b in found]
    while narrow := [b for b in open_ if b.rows > FEW and (b.value is None or b.low < b.high)]:
        _narrow(stored, narrow, first_key, last_key)
    last = _rows_at(stored, open_)
    tile = {name: sum((_after(last[id(b)], code[name]) for b in found), F.lit(1)) for name, found in borders.items()}
    return stored.withColumns({name: c.cast("int") for name, c in tile.items()}).drop("_tile_key", *code.values())


def _after(border: tuple[int, int], code: str) -> Column:
    value, at = border
    return ((F.col(code) > value) | (F.col(code) == value) & (F.col("_tile_key") > at)).cast("int")


def _distinct(borders: list[_Border]) -> list[_Border]:
    return list({b.same_range(): b for b in borders}.values())


def _narrow(stored: DataFrame, borders: list[_Border], first_key: int, last_key: int) -> None:
    """One histogram over the ranges of all ``borders``, which are then narrower."""
    for b in borders:
        if b.value is None and b.low == b.high:  # the value is known, the key is not
            b.value, b.low, b.high = b.low, first_key, last_key
    ranges = _distinct(borders)
    place = [F.when(b.holds, F.struct(F.lit(i).alias("i"), F.call_function("div", b.number - b.low, F.lit(b.width)).alias("at"))) for i, b in enumerate(ranges)]
    counts = stored.select(F.explode(F.array_compact(F.array(*place))).alias("p")).groupBy("p.i", "p.at").count().collect()  # RANGES rows a range at most
    found = {b.same_range(): sorted((r.at, r["count"]) for r in counts if r.i == i) for i, b in enumerate(ranges)}
    for b in borders:
        low, width = b.low, b.width
        for at, n in found[b.same_range()]:
            if b.place <= n:
                b.low, b.high, b.rows = low + at * width, min(b.high, low + (at + 1) * width - 1), n
                break
            b.place -= n


def _rows_at(stored: DataFrame, borders: list[_Border]) -> dict[int, tuple[int, int]]:
    """Value and key of the rows the borders mean; their ranges hold few rows."""
    ranges = _distinct(borders)
    held = [F.when(b.holds, F.struct(F.lit(i).alias("i"), F.col(b.measure).alias("value"), F.col("_tile_key").alias("at"))) for i, b in enumerate(ranges)]
    rows = stored.select(F.explode(F.array_compact(F.array(*held))).alias("p")).select("p.*").collect() if ranges else []
    found = {b.same_range(): sorted((r.value, r.at) for r in rows if r.i == i) for i, b in enumerate(ranges)}
    return {id(b): found[b.same_range()][b.place - 1] for b in borders}


def lead_in_blocks(df: DataFrame, key: str, order: list[str], block: dict[str, Column], value: str, out: str) -> DataFrame:
    """LEAD(value) per key, safe for a key that holds a large part of all rows.

    ``block`` names columns that never decrease along ``order`` and bound how many
    rows of one key share a block.  Neighbours are found inside a block; only the last
    row of a block needs the first value of the following one, and that is looked up
    among one row per (key, block).
    """
    for name, expr in block.items():
        df = df.withColumn(name, expr)
    names = [key, *block]
    inner = W.partitionBy(*names).orderBy(*order)
    wrapped = F.struct(F.col(value).alias("v"))
    heads = df.groupBy(*names).agg(F.min_by(wrapped, F.struct(*order)).alias("_head"))
    heads = heads.select(
        *[F.col(c).alias(f"_{c}") for c in names],
        F.lead("_head").over(W.partitionBy(key).orderBy(*block)).alias("_next_head"),
    )
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    return (
        df.withColumn("_next", F.lead(wrapped).over(inner))
        .join(heads, match, "left")
        .withColumn(out, F.coalesce("_next", "_next_head")["v"])
        .drop("_next", "_next_head", *block, *[f"_{c}" for c in names])
    )
