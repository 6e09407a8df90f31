"""Phrase collocations by Rabin-Karp fingerprints.

A word's fingerprint, and from the words' ones that of every run of 1 to 5
words in a piece, is a difference of two prefix polynomials (numpy, modulo
2**64); the language is mixed in. Fingerprints are counted level by level: a run
of k words is counted only where both its runs of k - 1 words may be frequent,
which a bitmap of bounded size tells (it may say yes too often, never no), so
the long tail of rare runs is not shuffled and nothing frequent is lost. Rows are
summed in the block of text, in the task, and after the shuffle.

Fingerprints alone decide nothing: for runs whose fingerprint is frequent, a last
pass compares every occurrence in a block with the words at the place of the
fingerprint's first one there (unequal ones become runs of their own) and sends
the text with its count. Counts are summed by text, so a collision costs a little
work and no exactness. Only frequent phrases are ever made into text.

Shuffles hold (fingerprint, count) for each level and (text, count) of frequent
runs at the end. The places stay in their blocks; a driver holds bitmaps of at
most ``bitmaps.MOST_BITS`` bits (16 MB) and no fingerprints.

Stated cases. NULL texts are empty, NULL languages ``und``. Long texts are hashed
in blocks cut between words. Repeated rows count as often as they are there. An
empty table gives an empty result. Ties of scores go to more occurrences, then to
the lower phrase in UTF-8 order. Scores are exact (decimals of 38 digits). Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm.bitmaps import Bitmap, bitmap_of
from tidepool.llm.common import slices, written
from tidepool.llm.hashing import BYTE_HASHES, U, mix, prefix_sums, span_hashes, text_bytes

#: Bytes that are hashed at once, about; a worker holds some 75 bytes of working tables for each.
BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: of a word; 1: between words; 2: between pieces.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 32]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2


class _Block:
    """The words of a block: their texts, fingerprints, pieces and languages; the first ``seen`` words belong to the block before."""

    def __init__(self, data, starts, ends, piece, lang, seen, n):
        self.seen, self.n, self.piece, self.lang = seen, n, piece, lang
        a = int(starts[0])
        low = _LOWER[data[a:int(ends[-1])]]
        self._low, self._starts, self._ends = low, starts - a, ends - a
        self._sums = prefix_sums(span_hashes(prefix_sums(BYTE_HASHES[low]), starts - a, ends - a))

    def runs(self, k: int) -> np.ndarray:
        """First words of the runs of k words in one piece that are not of the block before."""
        i = np.arange(max(0, self.seen - k + 1), len(self.piece) - k + 1)
        return i[self.piece[i] == self.piece[i + k - 1]] if len(i) else i

    def prints(self, i: np.ndarray, k: int, salts: np.ndarray) -> np.ndarray:
        return mix(span_hashes(self._sums, i, i + k) ^ salts[self.lang[i]])

    def words(self) -> pa.Array:
        """The words' texts, each distinct one once, by their numbers."""
        sizes = self._ends - self._starts
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        solid = np.zeros(len(self._low) + 1, dtype=np.int8)
        np.add.at(solid, self._starts, 1)
        np.add.at(solid, self._ends, -1)
        body = self._low[np.cumsum(solid[:-1]) > 0]
        return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))).dictionary_encode()


def _blocks(texts: pa.Array, langs: np.ndarray, overlap: int, size: int = BLOCK) -> Iterator[_Block]:
    data, offsets = text_bytes(texts)
    kind = _KIND[data]
    solid = kind == 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (np.r_[True, ~solid[:-1]] | edge[:-1])) if len(data) else np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(solid & (np.r_[~solid[1:], True] | edge[1:])) + 1 if len(data) else starts
    text = np.searchsorted(offsets, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + text  # both only grow: equal sums mean the same piece
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + size)))
        a = max(0, at - overlap)
        yield _Block(data, starts[a:to], ends[a:to], piece[a:to], langs[text[a:to]], at - a, to - at)
        at = to


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _read(batches, overlap: int) -> Iterator[tuple[_Block, pa.Array, np.ndarray]]:
    """(block, names of the languages, their salts) of all texts."""
    for batch in batches:
        for piece in slices(batch, 1, BLOCK):
            langs = piece.column(0).dictionary_encode()
            names = langs.dictionary
            salts = np.array([_salt(x) for x in names.to_pylist()], dtype=U)
            for block in _blocks(piece.column(1), langs.indices.to_numpy(zero_copy_only=False), overlap):
                yield block, names, salts


def _may_be_frequent(block: _Block, k: int, salts, bitmap: Bitmap | None) -> np.ndarray:
    i = block.runs(k)
    if k > 1 and len(i):
        i = i[bitmap.may_hold(block.prints(i, k - 1, salts))]
        i = i[bitmap.may_hold(block.prints(i + 1, k - 1, salts))]
    return i


def _count_prints(k: int, bitmap, batches) -> Iterator[pa.RecordBatch]:
    for block, _, salts in _read(batches, k - 1):
        i = _may_be_frequent(block, k, salts, bitmap and bitmap.value)
        if len(i):
            prints, n = np.unique(block.prints(i, k, salts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(n)], ["print", "n"])


def verified(prints: np.ndarray, i: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places, counts) of the distinct runs: those with equal fingerprints are compared with the first one's words."""
    firsts, counts = [], []
    while len(i):
        _, first, group, n = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
        same = np.ones(len(i), dtype=bool)
        for j in range(k):
            same &= ids[i + j] == ids[i[first][group] + j]
        firsts.append(i[first])
        counts.append(np.bincount(group[same], minlength=len(n)))
        prints, i = prints[~same], i[~same]
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(firsts), np.concatenate(counts)) if firsts else (none, none)


def _count_texts(bitmaps: list, batches) -> Iterator[pa.RecordBatch]:
    """(lang, size, phrase, n) of the runs whose fingerprints may be frequent; size 0: all words of a language."""
    for block, names, salts in _read(batches, len(bitmaps) - 1):
        encoded = block.words()
        ids, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
        code, n = np.unique(block.lang[block.seen:], return_counts=True)
        none = pa.nulls(len(code), pa.string())
        yield pa.RecordBatch.from_arrays([names.take(pa.array(code)), pa.array(np.zeros(len(code), np.int32)), none, pa.array(n)], _TEXTS)
        for k, bitmap in enumerate(bitmaps, 1):
            i = _may_be_frequent(block, k, salts, bitmaps[k - 2].value if k > 1 else None)
            prints = block.prints(i, k, salts)
            fine = bitmap.value.may_hold(prints)
            first, n = verified(prints[fine], i[fine], k, ids)
            if len(first):
                phrase = pc.binary_join_element_wise(*[distinct.take(pa.array(ids[first + j])) for j in range(k)], " ")
                lang = names.take(pa.array(block.lang[first]))
                yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(first), k, np.int32)), phrase, pa.array(n)], _TEXTS)


_TEXTS = ["lang", "size", "phrase", "n"]


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, size, phrase, n): all runs of 1 to ``longest`` words with at least ``least`` occurrences; size 0 has a language's words."""
    given = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spark, bitmaps = docs.sparkSession, []
    for k in range(1, longest + 1):
        counts = given.mapInArrow(lambda it, k=k, b=bitmaps[-1] if bitmaps else None: _count_prints(k, b, it), "print long, n long")
        frequent = written(counts.groupBy("print").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("print"), f"prints-{k}")
        bitmap = bitmap_of(frequent)
        if bitmap is None:
            break
        bitmaps.append(spark.sparkContext.broadcast(bitmap))
    maps = bitmaps or [spark.sparkContext.broadcast(Bitmap(1 << 12, np.zeros(64, dtype=U)))]
    texts = given.mapInArrow(lambda it: _count_texts(maps, it), "lang string, size int, phrase string, n long")
    return written(texts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("size") == 0)),
                   "phrases")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by the score of their weakest cut.

    A cut after k words scores floor(1000 a n / (l r)) with the occurrences of
    the phrase and its two parts and the words of the language. Phrases inside a
    longer frequent one with as many occurrences are left out.
    """
    found = frequent_phrases(docs, least, longest, text, lang)
    phrases = found.filter("size >= 1")
    parts = phrases.filter(F.col("size") < longest).select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("f"))
    words = F.split("phrase", " ", -1)
    # A longer phrase that covers all occurrences covers them word by word, so one word more is enough to look at.
    longer = phrases.filter("size > 2").select(
        F.col("lang").alias("of"), F.col("n").alias("covered"),
        F.explode(F.array(F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "),
                          F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "))).alias("part"))
    covered = longer.groupBy("of", "part").agg(F.max("covered").alias("covered"))
    candidates = phrases.filter("size >= 2")
    met = candidates.join(covered, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")), "left").drop("of", "part")
    free_ = met.filter(F.coalesce(F.col("covered") < F.col("n"), F.lit(True))).select("lang", "size", "phrase", F.col("n").alias("a"))
    cuts = (free_.select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("tail")))
    heads = parts.select(F.col("of").alias("ho"), F.col("part").alias("hp"), F.col("f").alias("l"))
    tails = parts.select(F.col("of").alias("to"), F.col("part").alias("tp"), F.col("f").alias("r"))
    total = found.filter("size = 0").select(F.col("lang").alias("no"), F.col("n"))
    known = (cuts.join(heads, (F.col("lang") == F.col("ho")) & (F.col("head") == F.col("hp")))
             .join(tails, (F.col("lang") == F.col("to")) & (F.col("tail") == F.col("tp")))
             .join(total, F.col("lang") == F.col("no")))
    above = (F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", above.cast("decimal(38,0)"), (F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")).cast("decimal(38,0)"))
    best = known.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
