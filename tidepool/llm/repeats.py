"""Where spans of a fixed number of symbols (words or bytes) repeat, over all texts of a table.

A window is ``span`` consecutive symbols of one text. Each window is led by the
k-mer in it with the least hash, the first one if there are several, and a
*path* is a maximal run of consecutive windows with the same leader. Equal
windows have equal leaders at equal places, so windows are only ever compared
under one leader hash, and one row stands for a whole path:

1. leader hashes that occur once are gone after one count;
2. a leader hash whose paths are all equal repeats as a whole;
3. of the others, equal paths become one row with a count, and only the
   distinct paths that occur once are compared piece by piece.

Counts are aggregated before their shuffle and joined back to the places
(document, start) they came from. A place is (id, hash of the text, start), so
repeated rows count as repeats and share their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing
from tidepool.llm.common import slices, written

SLICE = 2 << 20
PLACE_BITS = 24
PLACES = "id long, h long, start int, n int, a long, c long"
WINDOWS = "id long, h long, start int, key long, count long"


@dataclass(frozen=True)
class Unit:
    """Symbols (``word`` or ``byte``), symbols in a window, symbols in a k-mer."""

    symbol: str
    span: int
    kmer: int

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol hashes of all texts, offsets of the texts among them, bytes of all texts)."""
        data, offsets = hashing.text_bytes(texts)
        if self.symbol == "byte":
            return hashing.BYTE_HASHES[data], offsets, data
        starts, ends, offsets = hashing.word_spans(data, offsets)
        return hashing.word_hashes(data, starts, ends), offsets, data


def documents(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, h, text): what the operators on repeats read of a table."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(whole).alias("h"), whole.alias("text"))


def kmer_values(sums: np.ndarray, kmer: int) -> np.ndarray:
    """Hashes of all k-mers, from the symbols' prefix sums."""
    x = sums[kmer:] - sums[:-kmer]
    x *= hashing.powers(len(x), inverse=True)
    x += hashing.U(kmer)
    return hashing.mix(x)


def leaders(values: np.ndarray, wide: int) -> np.ndarray:
    """The place of the least of the ``wide`` values from each place on, the first if several are least.

    Only the upper 40 bits of the values count, so that a value and its place
    fit into one number wherever fewer than 2**24 places are looked at.
    """
    low = hashing.U(PLACE_BITS)
    if len(values) < 1 << PLACE_BITS:
        packed = (values >> low << low) | np.arange(len(values), dtype=hashing.U)
        return (hashing.sliding_minima(packed, wide) & hashing.U((1 << PLACE_BITS) - 1)).astype(np.int64)
    value, place, have = values >> low, np.arange(len(values)), 1
    while have < wide:
        step = min(have, wide - have)
        left = value[:-step] <= value[step:]
        place = np.where(left, place[:-step], place[step:])
        value = np.where(left, value[:-step], value[step:])
        have += step
    return place


def paths(symbols: np.ndarray, offsets: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """(text, start, windows, leader hash, hash of the path) of every path."""
    count = len(symbols) - unit.span + 1
    if count < 1:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, hashing.U, hashing.U))
    sums = hashing.prefix_sums(symbols)
    values = kmer_values(sums, unit.kmer)
    place = leaders(values, unit.span - unit.kmer + 1)
    # Windows that do not cross texts, and among them those with which a path begins.
    inside = np.ones(count, dtype=bool)
    for end in offsets[1:-1].tolist():
        inside[max(0, end - unit.span + 1):end] = False
    begins = inside.copy()
    begins[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    begins[offsets[:-1][offsets[:-1] < count]] |= inside[offsets[:-1][offsets[:-1] < count]]
    start = np.flatnonzero(begins)
    if not len(start):
        return paths(symbols[:0], offsets[:1], unit)
    text = np.searchsorted(offsets, start, side="right") - 1
    last = np.minimum(np.r_[start[1:], count] - 1, offsets[1:][text] - unit.span)
    return text, start, last - start + 1, values[place[start]], hashing.span_hashes(sums, start, last + unit.span)


def _paths(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 2, SLICE):
            symbols, offsets, _ = unit.read(part.column(2))
            text, start, n, a, c = paths(symbols, offsets, unit)
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(at), part.column(1).take(at), pa.array((start - offsets[text]).astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(a.view(np.int64)), pa.array(c.view(np.int64))], ["id", "h", "start", "n", "a", "c"])


@dataclass
class Repeats:
    """``whole``: places (id, h, start, n) of paths that repeat; ``once``: distinct paths (a, c, count, sources, place) still to compare."""

    whole: DataFrame
    once: DataFrame


def repeated_paths(docs: DataFrame, unit: Unit) -> Repeats:
    """Compact the paths of ``docs`` (id, h, text)."""
    all_paths = docs.mapInArrow(lambda it: _paths(it, unit), PLACES)
    leaders = written(all_paths.groupBy("a").agg(F.count("*").alias("count"), F.min("c").alias("least"), F.max("c").alias("most"))
                      .filter("count > 1").select("a", (F.col("least") == F.col("most")).alias("alike")), "leaders")
    places = written(all_paths.join(leaders, "a"), "paths")
    place = F.struct("id", "h", "start", "n")
    distinct = written(places.filter("not alike").groupBy("a", "c").agg(F.count("*").alias("count"), F.min(place).alias("place")), "distinct-paths")
    again = places.filter("not alike").join(distinct.filter("count > 1").select("a", "c"), ["a", "c"])
    columns = ["id", "h", "start", "n"]
    return Repeats(places.filter("alike").select(columns).unionAll(again.select(columns)), distinct)


def with_sources(docs: DataFrame, once: DataFrame, *more: str) -> DataFrame:
    """(id, h, text, list of (start, n, a, count, ...)): the texts that distinct paths are read from."""
    of = once.select("place.id", "place.h", F.struct("place.start", "place.n", "a", "count", *more).alias("path"))
    of = of.groupBy("id", "h").agg(F.collect_list("path").alias("paths")).withColumnRenamed("id", "of").withColumnRenamed("h", "oh")
    return docs.join(of, docs["id"].eqNullSafe(F.col("of")) & (docs["h"] == F.col("oh"))).select("id", "h", "text", "paths")


def window_rows(ids, hs, start: np.ndarray, n: np.ndarray, a: np.ndarray, count: np.ndarray, first: np.ndarray, sums: np.ndarray,
                unit: Unit) -> pa.RecordBatch:
    """A row for each window of each path; ``first``: the path's place among the symbols that ``sums`` belong to."""
    own = np.repeat(np.arange(len(n)), n)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = first[own] + step
    key = hashing.mix(hashing.span_hashes(sums, at, at + unit.span) + a.view(hashing.U)[own])
    take = pa.array(own)
    return pa.RecordBatch.from_arrays([ids.take(take), hs.take(take), pa.array((start[own] + step).astype(np.int32)), pa.array(key.view(np.int64)),
                                       pa.array(count[own])], ["id", "h", "start", "key", "count"])


def repeated_windows(windows: DataFrame) -> DataFrame:
    """Places (id, h, start, n = 1) of the windows, of paths that occur once, that other paths or places have, too."""
    place = F.struct("id", "h", "start")
    keys = windows.groupBy("key").agg(F.max("count").alias("count"), F.min(place).alias("least"), F.max(place).alias("most"))
    keys = written(keys.filter((F.col("count") > 1) | ~F.col("least").eqNullSafe(F.col("most"))).select("key"), "repeated-keys")
    return windows.filter("count = 1").join(keys, "key").select("id", "h", "start", F.lit(1).alias("n"))


def covered(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``docs`` with ``spans``, the places (start, symbols) that repeat in each text; NULL if none does."""
    of = places.groupBy("id", "h").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    of = of.withColumnRenamed("id", "of").withColumnRenamed("h", "oh")
    return docs.join(of, docs["id"].eqNullSafe(F.col("of")) & (docs["h"] == F.col("oh")), "left").select("id", "text", "spans")


def removed_mask(length: int, spans) -> np.ndarray:
    """Which of ``length`` symbols the spans (start, symbols) cover."""
    edge = np.zeros(length + 1, dtype=np.int64)
    if spans:
        start = np.array([s["start"] for s in spans])
        np.add.at(edge, start, 1)
        np.add.at(edge, start + np.array([s["n"] for s in spans]), -1)
    return np.cumsum(edge[:-1]) > 0
