"""Hierarchical packing of documents into token windows of several sizes.

Tasks tokenise whole texts, add the end id, and cut a document only where it is
longer than the longest window: whole windows are sequences of their own, the
rest of it is a piece like any other. The pieces, without their ids, are written
and dealt by hash to packing groups of about ``group_windows`` windows. In a group:

1. Each piece is routed to the shortest tier that it fits in: windows of 512,
   1024, 2048 and 4096 tokens.
2. The short tiers are packed from the longest: a piece that fills its window
   is one; otherwise the piece that exactly fills up the rest is looked for
   among those not placed yet, but for the shortest, which are kept for step 3.
   A short window is closed only when it is full, as one with a gap would have
   to be padded to the longest size.
3. The longest tier takes its own pieces, and its gaps are filled with what the
   short tiers have left, from the longest piece down, each into the gap that it
   leaves the smallest. What fits in no gap opens a window of the longest size.
4. The windows of each tier are dealt to step groups in turn and back again by
   their attention cost (sum of squared piece lengths), so that every step has
   its share of each tier and steps are level.

Defined results: a NULL or empty text is a document of the end id alone;
repeated rows are documents of their own; a NULL id is kept; a very long text
is many windows, dealt out one by one; an empty table gives no rows; only the
named columns are used.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import slices, written
from tidepool.llm.tokens import opened

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, number long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_group long"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    tokenizer, number = opened(path), 0
    for batch in batches:
        for part in slices(batch, 1):
            ids, ends = tokenizer.encode(part.column(1).fill_null(""))
            rows, start = [], 0
            for doc, end in zip(part.column(0).to_pylist(), ends.tolist()):
                own = np.append(ids[start:end], np.int32(end_id)).astype("<u4")
                for at in range(0, len(own), window):
                    piece = own[at:at + window]
                    rows.append((doc, at, len(piece), zlib.crc32(piece.tobytes()), len(own), number))
                    number += 1
                start = end
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], PIECES.replace(" long", "").split(", "))


def token_pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text",
                 window: int = 4096, end_id: int = 2) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, number): the pieces of every document."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(lambda it: _pieces(it, tokenizer, window, end_id), PIECES)


def best_fit(lengths: np.ndarray, window: int, filled: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window number, offset) of each piece, lengths in falling order; and what each window holds, beginning with ``filled``."""
    where, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    filled = list(filled or [])
    by_gap: dict[int, list[int]] = {}
    for w, held in enumerate(filled):
        if held < window:
            by_gap.setdefault(window - held, []).append(w)
    gaps = sorted(by_gap)  # the gaps there are, in order
    for i, length in enumerate(lengths.tolist()):
        k = bisect.bisect_left(gaps, length)
        if k < len(gaps):
            gap = gaps[k]
            w = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap], gaps[k]
        else:
            w = len(filled)
            filled.append(0)
        where[i], offset[i] = w, filled[w]
        filled[w] += length
        if gap := window - filled[w]:
            if gap not in by_gap:
                bisect.insort(gaps, gap)
                by_gap[gap] = []
            by_gap[gap].append(w)
    return where, offset, np.array(filled, dtype=np.int64)


def full_windows(lengths: np.ndarray, size: int, free: np.ndarray, spare: int) -> list[list[int]]:
    """Windows of ``size`` that pieces of its tier (longer than half of it) fill exactly, alone or with one more; ``free`` pieces are taken off.

    Pieces shorter than ``spare`` fill up none: they are what closes the last gaps of long windows.
    """
    tier = [i for i in np.flatnonzero(free & (lengths <= size) & (2 * lengths > size)).tolist()]
    by_length: dict[int, list[int]] = {}
    for i in np.flatnonzero(free & (2 * lengths <= size) & (lengths >= spare)).tolist()[::-1]:
        by_length.setdefault(int(lengths[i]), []).append(i)
    out = []
    for i in tier:
        rest = size - int(lengths[i])
        if rest == 0:
            out.append([i])
        elif by_length.get(rest):
            out.append([i, by_length[rest].pop()])
    for w in out:
        free[w] = False
    return out


def pack_tiers(lengths: np.ndarray, window: int, tiers: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window number, offset) of each piece, lengths in falling order; (size, held tokens) of each window."""
    where, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    free = np.ones(len(lengths), dtype=bool)
    size, held = [], []
    for tier in sorted(tiers, reverse=True):
        for w in full_windows(lengths, tier, free, window // 64):
            where[w], offset[w] = len(size), np.r_[0, np.cumsum(lengths[w])[:-1]]
            size.append(tier)
            held.append(tier)
    left = np.flatnonzero(free)
    own = left[2 * lengths[left] > window]  # the longest tier's pieces have a window each
    other = left[2 * lengths[left] <= window]
    where[own] = len(size) + np.arange(len(own))
    at, off, filled = best_fit(lengths[other], window, lengths[own].tolist())
    where[other], offset[other] = len(size) + at, off
    return where, offset, np.array([*size, *[window] * len(filled)], dtype=np.int64), np.array([*held, *filled], dtype=np.int64)


def _pack(key: tuple, pieces: pd.DataFrame, window: int, tiers: tuple[int, ...], steps: int) -> pd.DataFrame:
    # Longest pieces first.
    pieces = pieces.sort_values(["length", "doc_id", "start", "number"], ascending=[False, True, True, True], ignore_index=True)
    length = pieces["length"].to_numpy()
    where, offset, size, _ = pack_tiers(length, window, tiers)
    cost = np.bincount(where, weights=length.astype(float) ** 2, minlength=len(size))
    step = np.empty(len(size), dtype=np.int64)
    begun = 0
    for tier in np.unique(size)[::-1]:  # each tier goes on where the one before it ended
        own = np.flatnonzero(size == tier)
        lap, at = np.divmod(np.arange(len(own)) + begun, steps)
        step[own[np.lexsort((own, -cost[own]))]] = np.where(lap % 2 == 0, at, steps - 1 - at)
        begun += len(own)
    first = int(key[0]) << 24
    return pieces.drop(columns=["number", "pack"]).assign(
        sequence_id=first + where, offset=offset, tier=size[where], step_group=int(key[0]) * steps + step[where])


def pack_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", window: int = 4096,
                   end_id: int = 2, tiers: tuple[int, ...] | None = None, group_windows: int = 1024, steps: int = 16) -> DataFrame:
    """One row per piece: its document, place and checksum, its sequence, offset, tier (the sequence's size) and step group.

    ``tiers``: sizes of short windows, at most half of ``window`` each; unless given, an eighth, a quarter and a half of it.
    """
    tiers = (window // 8, window // 4, window // 2) if tiers is None else tiers
    if any(2 * t > window for t in tiers):
        raise ValueError("a short window has at most half the size of the longest")
    pieces = written(token_pieces(df, tokenizer, id_col, text, window, end_id), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (window * group_windows)))
    dealt = pieces.withColumn("pack", F.pmod(F.xxhash64("doc_id", "start", "number"), F.lit(groups)))
    return dealt.groupBy("pack").applyInPandas(lambda key, pdf: _pack(key, pdf, window, tiers, steps), PACKED)
