"""Benchmark decontamination by spaced seeds.

A mask picks six of up to eleven neighbouring words and ignores the others.  Every place of
every benchmark item and of every document is hashed under each mask; where hashes meet, the
words around the place are compared one by one, so substituted words are tolerated.

A document holds a leak of an item when ``WINDOW`` consecutive words of both, aligned without
insertions, agree in at least ``AGREE`` places.  The three masks are lossless for this: whatever
three words of the window are substituted, one mask still fits between them.  Items shorter
than the window must occur word for word.  Those that no mask fits are phrases of up to six words:
each is one seed, and documents are hashed at the lengths that occur among them.  ``shortest`` sets how
many words an item needs to be looked for at all; by default every item with a word is.

What every task is sent has a fixed size: a Bloom filter of ``FILTER_BITS`` bits over the seeds
of the benchmark.  It only spares rows; what passes it is joined with the seeds by a shuffle,
so a benchmark of any size gives the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.llm.common import fresh_name, stably_numbered, whole

MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 8, 9, 10), (0, 1, 3, 5, 9, 10))
WINDOW, AGREE = 15, 12
SHORTEST = 1
PHRASE = min(mask[-1] for mask in MASKS)  # items up to this many words fit no mask
FILTER_BITS = 1 << 23
_WORD = re.compile(r"[^\W_]+")
_HASH = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> np.ndarray:
    """Hashes of the words in lower case."""
    found = _WORD.findall((text or "").lower())
    return np.array([xxhash.xxh64_intdigest(w) for w in found], np.uint64)


def _mixed(tokens: np.ndarray, start: int, mask: tuple[int, ...]) -> np.ndarray:
    """A hash of the words that the mask picks, for every place where it fits."""
    n = len(tokens) - mask[-1]
    h = np.full(max(0, n), np.uint64(start))
    for offset in mask if n > 0 else ():
        h = (h ^ tokens[offset : offset + n]) * _HASH
        h ^= h >> np.uint64(29)
    return h


def seeds(tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each mask that fits: its span, and the hash of every place."""
    for k, mask in enumerate(MASKS):
        h = _mixed(tokens, k + 1, mask)
        if len(h):
            yield mask[-1] + 1, h


def phrases(tokens: np.ndarray, lengths: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each length: it, and the hash of the words at every place."""
    for length in lengths:
        h = _mixed(tokens, 100 + length, tuple(range(length)))
        if len(h):
            yield length, h


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a seed in the filter."""
    size = np.uint64(FILTER_BITS - 1)
    return (h >> np.uint64(20)) & size, (h >> np.uint64(41)) & size


def _context(tokens: np.ndarray, at: int, span: int) -> tuple[int, np.ndarray]:
    """Where the seed lies in the words around it, and those words."""
    lo = max(0, at - WINDOW + 1)
    return at - lo, tokens[lo : at + span + WINDOW - 1].view(np.int64)


_SEED = "seed bigint, item_id bigint, size int, item_at int, item_words array<bigint>, position array<bigint>"


def _item_seeds(shortest: int):
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item_id"], batch["text"]):
                tokens = words(text)
                if len(tokens) < max(1, shortest):
                    continue
                for span, h in phrases(tokens, [len(tokens)]) if len(tokens) <= PHRASE else seeds(tokens):
                    first, second = _bits(h)
                    around = [_context(tokens, at, span) for at in range(len(h))]
                    yield pd.DataFrame(
                        {
                            "seed": h.view(np.int64),
                            "item_id": item,
                            "size": len(tokens),
                            "item_at": [a for a, _ in around],
                            "item_words": [w for _, w in around],
                            "position": list(np.stack([first, second], 1).view(np.int64)),
                        }
                    )

    return made


def _agreement(doc_at, doc_words, item_at, item_words, size) -> tuple[int, int, int]:
    """Around a seed: the most words that agree in a window, and the start and end, from the seed
    on, of what the windows that agree enough cover."""
    left, right = min(doc_at, item_at), min(len(doc_words) - doc_at, len(item_words) - item_at)
    same = np.asarray(doc_words[doc_at - left : doc_at + right]) == np.asarray(item_words[item_at - left : item_at + right])
    width, needed = (WINDOW, AGREE) if size >= WINDOW else (size, size)
    if len(same) < width:
        return 0, 0, 0
    total = np.r_[0, np.cumsum(same)]
    agree = total[width:] - total[:-width]
    enough = np.flatnonzero(agree >= needed)
    return (int(agree.max()), int(enough[0]) - left, int(enough[-1]) - left + width) if len(enough) else (0, 0, 0)


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """One row per document and leaked item: ``doc_id, item_id, n_items, first_word, last_word, n_agree``.

    ``item_id`` is the smallest id of the ``n_items`` items that share the passage; the words are
    counted from 0.  NULL and empty texts hold no leak, and an empty benchmark finds none.  Rows
    that repeat an id are searched each for itself and reported under that id once.
    """
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), whole(item_text).alias("text"))
    # Passages that several items share meet the documents once.
    shared = ["seed", "size", "item_at", "item_words"]
    known = written(items.mapInPandas(_item_seeds(shortest), _SEED).groupBy(*shared, "position").agg(F.min("item_id").alias("item_id"), F.count_distinct("item_id").alias("n_items")), "seeds")
    place = known.select(F.explode("position").alias("p")).select((F.col("p") + 1).alias("p"))
    maps = place.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    passes = np.zeros(FILTER_BITS // 8, np.uint8)
    for b, bits in maps.collect():  # at most FILTER_BITS in all
        passes[(b - 1) * 4096 : b * 4096] = np.frombuffer(bits, np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(passes)
    lengths = sorted(r.size for r in known.filter(F.col("size") <= PHRASE).select("size").distinct().collect())  # at most PHRASE

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sent.value
        test = lambda at: (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
        for batch in batches:
            found = []
            for doc, content in zip(batch["doc_id"], batch["text"]):
                tokens = words(content)
                for span, h in seeds(tokens):
                    first, second = _bits(h)
                    maybe = np.flatnonzero(test(first))
                    for at in maybe[test(second[maybe]) == 1].tolist():
                        inside, around = _context(tokens, at, span)
                        found.append((h[at].astype(np.int64), doc, at, inside, around))
                for length, h in phrases(tokens, lengths):
                    first, second = _bits(h)
                    maybe = np.flatnonzero(test(first))
                    maybe = maybe[test(second[maybe]) == 1]
                    # Of a phrase that recurs, the first and the last place tell all that is asked.
                    _, ahead = np.unique(h[maybe], return_index=True)
                    _, behind = np.unique(h[maybe][::-1], return_index=True)
                    for at in maybe[sorted({*ahead.tolist(), *(len(maybe) - 1 - behind).tolist()})].tolist():
                        found.append((h[at].astype(np.int64), doc, at, 0, tokens[at : at + length].view(np.int64)))
            if found:
                yield pd.DataFrame(found, columns=["seed", "doc_id", "at", "doc_at", "doc_words"])

    id_type = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text).alias("text"))
    hits = rows.mapInPandas(candidates, f"seed bigint, doc_id {id_type}, at int, doc_at int, doc_words array<bigint>")

    @F.pandas_udf("agree int, lo int, hi int")
    def compare(doc_at: pd.Series, doc_words: pd.Series, item_at: pd.Series, item_words: pd.Series, size: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_agreement(*x) for x in zip(doc_at, doc_words, item_at, item_words, size)], columns=["agree", "lo", "hi"])

    met = hits.join(known.drop("position"), "seed").withColumn("c", compare("doc_at", "doc_words", "item_at", "item_words", "size"))
    return (
        met.filter("c.agree > 0")
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("n_items").alias("n_items"),
            F.min(F.col("at") + F.col("c.lo")).cast("bigint").alias("first_word"),
            F.max(F.col("at") + F.col("c.hi") - 1).cast("bigint").alias("last_word"),
            F.max("c.agree").alias("n_agree"),
        )
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id", item_text: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """The rows of ``docs`` that hold no leak of the benchmark."""
    rows, row = stably_numbered(docs)
    found = leaks(rows.select(F.col(row).alias("_row"), F.col(text).alias("_whole")), benchmark, "_row", "_whole", item_col, item_text, shortest)
    gone = fresh_name(rows, "gone")
    dirty = found.select(F.col("doc_id").alias(gone)).distinct()
    return rows.join(dirty, rows[row] == dirty[gone], "left_anti").drop(row)


def item_classes(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``item_id, member_id``: the items that share a passage with the item ``leaks`` names for it.

    A leak of ``item_id`` with ``n_items`` above 1 is one of members listed here.
    """
    items = benchmark.select(F.col(item_col).cast("bigint").alias("member_id"), whole(item_text).alias("text"))
    made = items.withColumnRenamed("member_id", "item_id").mapInPandas(_item_seeds(shortest), _SEED)
    made = made.select("seed", "size", "item_at", "item_words", F.col("item_id").alias("member_id"))
    shared = ["seed", "size", "item_at", "item_words"]
    least = made.groupBy(*shared).agg(F.min("member_id").alias("item_id"))
    return least.join(made, shared).select("item_id", "member_id").distinct()
