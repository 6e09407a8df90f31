"""Bitmaps of bounded size that tell which rows cannot matter before anything is shuffled.

A bitmap may say yes to a fingerprint that is not there, never no to one that
is; what it lets through is joined or counted exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.hashing import U

#: Bound of a bitmap (16 MB); it has 32 bits for each fingerprint up to that.
MOST_BITS = 1 << 27


class Bitmap:
    """Whether a fingerprint may be among given ones."""

    def __init__(self, bits: int, words: np.ndarray):
        self.shift, self.words = U(65 - bits.bit_length()), words

    def may_hold(self, prints: np.ndarray) -> np.ndarray:
        at = prints >> self.shift
        return (self.words[at >> U(6)] >> (at & U(63))) & U(1) == 1


def bitmap_of(frequent: DataFrame) -> Bitmap | None:
    """The bitmap of the fingerprints in column ``print``, put together by words of 64 bits; None where there are none."""
    n = frequent.count()
    if not n:
        return None
    bits = max(1 << 12, min(MOST_BITS, 1 << (32 * n - 1).bit_length()))
    at = F.shiftrightunsigned("print", 65 - bits.bit_length())
    rows = (frequent.select(F.shiftright(at, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    words = np.zeros(bits >> 6, dtype=U)
    words[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(U)
    return Bitmap(bits, words)
