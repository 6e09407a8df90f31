"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, everything else is a blank; n-grams of 1 to 3
characters are hashed to 2**16 features. Document frequencies are counted over
all documents that may be learned from. The model is trained with the
follow-the-regularised-leader rule (FTRL-proximal) under an elastic net, on a
sample that is bounded by ``sample_rows`` (about as many documents of each
language, those with the smallest hashes), and a temperature is fitted to a
part of the sample that is kept out of the training. A feature's weight and its
inverse document frequency are one number at prediction, so a text is scored by
one look-up for each n-gram, whole texts at any length.

Defined results: a text that is NULL or holds no letter is ``und`` with score
0; a NULL id is neither held out nor learned from; without a labelled document
every text is ``und``; languages beyond a block's number are learned in several
blocks, those without a row in the sample not at all; repeated rows count once in
the sample and are rows of the result; an empty table gives no rows; only the named columns are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidepool.llm.common import slices, written

BITS = 16
SLICE = 1 << 20
SCALE = 100.0  # a term frequency is SCALE * count / n-grams of the text
_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case (a blank for what is no letter) and letter or not, by code point."""
    if not _TABLES:
        lower, letter = np.full(0x110000, 32, dtype=np.uint32), np.zeros(0x110000, dtype=bool)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                low = c.lower()
                lower[i], letter[i] = ord(low) if len(low) == 1 else i, True
        _TABLES.extend((lower, letter))
    return _TABLES[0], _TABLES[1]


def _grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(features at each place for n = 1, 2, 3; start of each text; letters in each text). Two blanks end a text."""
    lower, letter = _tables()
    joined = "".join([f"{t or ''}\n\n" for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    starts = np.r_[0, np.cumsum([len(t or "") + 2 for t in texts])[:-1]].astype(np.int64)
    low = lower[codes]
    grams, mixed = [], np.zeros(len(low), dtype=np.uint32)
    for n in range(3):
        ahead = np.r_[low[n:], np.full(n, 32, dtype=np.uint32)] if n else low
        mixed = (mixed ^ (ahead + np.uint32(0x9E37 * (n + 1)))) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
        grams.append(((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)).astype(np.uint16))
    return grams, starts, np.add.reduceat(letter[codes], starts, dtype=np.int64)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, docs = np.zeros(1 << BITS, dtype=np.int64), 0
    for batch in batches:
        for part in slices(batch, 0, SLICE):
            grams, starts, _ = _grams(part.column(0).to_pylist())
            for a, b in zip(starts, [*starts[1:], len(grams[0])]):
                seen = np.zeros(1 << BITS, dtype=bool)
                for g in grams:
                    seen[g[a:b]] = True
                counts += seen
            docs += part.num_rows
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[docs, counts[at]])], ["feature", "docs"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, features, frequencies) of sampled texts."""
    for batch in batches:
        for part in slices(batch, 1, SLICE):
            grams, starts, _ = _grams(part.column(1).to_pylist())
            rows = [np.unique(np.concatenate([g[a:b] for g in grams]), return_counts=True) for a, b in zip(starts, [*starts[1:], len(grams[0])])]
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(2), pa.array([x.astype(np.int32) for x, _ in rows], pa.list_(pa.int32())),
                pa.array([(n * (SCALE / n.sum())).astype(np.float32) for _, n in rows], pa.list_(pa.float32()))], ["lang", "h", "at", "tf"])


@dataclass
class Block:
    """Some languages, and after them one that stands for all others where there are more blocks than this.

    Weights (times the inverse document frequency, over the temperature) are
    kept as places and values of those that are not 0.
    """

    langs: list[str]
    rows: int
    at: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, langs: list[str], weights: np.ndarray) -> Block:
        at = np.flatnonzero(weights)
        return cls(langs, len(weights), at.astype(np.uint32), weights.ravel()[at].astype(np.float32))

    def weights(self) -> np.ndarray:
        table = np.zeros(self.rows << BITS, dtype=np.float32)
        table[self.at] = self.value
        return table.reshape(self.rows, 1 << BITS)


@dataclass
class LanguageModel:
    """Blocks of languages; a text has the language with the highest share in its own block."""

    blocks: list[Block]
    _dense: np.ndarray | None = None

    @property
    def langs(self) -> list[str]:
        return [x for b in self.blocks for x in b.langs]

    @property
    def weights(self) -> np.ndarray:
        """All weights as one table; for looking at small models."""
        return np.concatenate([b.weights() for b in self.blocks]) if self.blocks else np.zeros((0, 1 << BITS), dtype=np.float32)

    def __getstate__(self):
        return {"blocks": self.blocks, "_dense": None}

    def _table(self, block: Block) -> np.ndarray:
        if len(self.blocks) > 1:
            return block.weights()  # one table at a time
        if self._dense is None:
            self._dense = block.weights()
        return self._dense

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.blocks:
            return ["und"] * len(texts), np.zeros(len(texts))
        grams, starts, letters = _grams(texts)
        scale = SCALE / (3.0 * np.diff(np.r_[starts, len(grams[0])]))
        best, score = np.full(len(texts), "und", dtype=object), np.full(len(texts), -1.0)
        for block in self.blocks:
            logits = np.stack([sum(np.add.reduceat(w[g], starts, dtype=np.float64) for g in grams) for w in self._table(block)]) * scale
            p = np.exp(logits - logits.max(axis=0))
            own = p[:len(block.langs)]
            k, share = own.argmax(axis=0), own.max(axis=0) / p.sum(axis=0)
            ahead = share > score  # ties stay with the block before
            best[ahead], score[ahead] = np.array(block.langs, dtype=object)[k[ahead]], share[ahead]
        return [x if n else "und" for x, n in zip(best, letters)], np.where(letters > 0, score, 0.0)


def train_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, features: int, epochs: int = 4, alpha: float = 0.2,
               beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights (classes, features) after passes of FTRL-proximal over (class, features, values)."""
    z, n = np.zeros((classes, features)), np.zeros((classes, features))

    def weights(at) -> np.ndarray:
        zi, ni = z[:, at], n[:, at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for k, at, x in rows:
            w = weights(at)
            s = w @ x
            p = np.exp(s - s.max())
            p /= p.sum()
            p[k] -= 1.0
            g = p[:, None] * x[None, :]
            grown = n[:, at] + g * g
            z[:, at] += g - (np.sqrt(grown) - np.sqrt(n[:, at])) / alpha * w
            n[:, at] = grown
    return weights(slice(None))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search on its logarithm."""
    def loss(u: float) -> float:
        s = logits / np.exp(u)
        top = s.max(axis=1)
        return float(np.mean(top + np.log(np.exp(s - top[:, None]).sum(axis=1)) - s[np.arange(len(s)), labels]))

    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    while b - a > 1e-4:
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = 2000,
          block_langs: int = 64, calibrate: float = 0.2) -> LanguageModel:
    """Learn from the rows of ``df`` that have a text and a language.

    The sample holds about ``sample_rows`` rows whatever the number of
    languages; with more languages than that some have no row in it and are not
    learned. More than ``block_langs`` languages are learned in blocks, each
    with one class more for the sampled rows of all other blocks, so that the
    driver's tables and a task's have at most ``block_langs`` + 1 classes.
    """
    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.lit("sample"), F.col(id_col)).alias("h"),
                     F.xxhash64(text).alias("t")).filter("text is not null and lang is not null")
    counted = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")  # stays a table: labels may be anything
    several, = counted.agg(F.count("*")).first()
    if not several:
        return LanguageModel([])
    found = rows.select("text").mapInArrow(_document_counts, "feature long, docs long").groupBy("feature").agg(F.sum("docs").alias("docs"))
    found = found.toArrow()  # at most one row for each feature; the number of documents stands at feature -1
    docs = np.zeros(1 + (1 << BITS))
    docs[found["feature"].to_numpy()] = found["docs"].to_numpy()
    idf = np.log((1.0 + docs[-1]) / (1.0 + docs[:-1])) + 1.0

    # Rows that no share could take are left before the join; the largest share is that of the rarest language.
    share = counted.select(F.col("lang").alias("of"), F.least(F.lit(1.0), F.lit(sample_rows / several) / F.col("n")).alias("share"))
    most, = share.agg(F.max("share")).first()
    place = F.shiftrightunsigned("h", 11) / float(2**53)
    sampled = (rows.filter(place < most).join(share, F.col("lang") == F.col("of")).filter(place < F.col("share"))
               .groupBy("h", "t").agg(F.min("lang").alias("lang"), F.min("text").alias("text")))
    got = sampled.select("lang", "text", "h").mapInArrow(_features, "lang string, h long, at array<int>, tf array<float>")
    got = got.toArrow().combine_chunks()  # arrays, about sample_rows of them
    named = got["lang"].to_pylist()
    langs, made = sorted(set(named)), []
    if named:
        at, tf = got["at"].chunk(0), got["tf"].chunk(0)
        ends, at, tf = at.offsets.to_numpy(), at.values.to_numpy(), tf.values.to_numpy()
        order = sorted(range(len(named)), key=lambda i: (got["h"][i].as_py(), named[i], ends[i + 1] - ends[i]))
        number = {x: k for k, x in enumerate(langs)}
        made = [(number[named[i]], a := at[ends[i]:ends[i + 1]], idf[a] * tf[ends[i]:ends[i + 1]]) for i in order]
    held = [x for i, x in enumerate(made) if i % 100 < 100 * calibrate]
    learn = [x for i, x in enumerate(made) if i % 100 >= 100 * calibrate] or made
    blocks = []
    for first in range(0, len(langs), block_langs):
        own = langs[first:first + block_langs]
        classes = len(own) + (len(own) < len(langs))

        def inside(k: int) -> int:
            return k - first if 0 <= k - first < len(own) else len(own)

        w = train_ftrl([(inside(k), a, x) for k, a, x in learn], classes, 1 << BITS)
        warm = temperature(np.stack([w[:, a] @ x for _, a, x in held]), np.array([inside(k) for k, _, _ in held])) if held else 1.0
        blocks.append(Block.of(own, w * idf[None, :] / warm))
    return LanguageModel(blocks)


def predict(df: DataFrame, model: LanguageModel, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``df`` with the language and its score; columns of these names are replaced, the others pass through."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # the weights that are not 0, of at most sample_rows languages
    kept = df.drop(lang_out, score_out)
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, SLICE):
                if part.num_rows:
                    langs, scores = shared.value.predict(part.column(at).to_pylist())
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs), pa.array(scores)], [*part.schema.names, lang_out, score_out])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(lang_out, StringType()), StructField(score_out, DoubleType())]))


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from the training: crc32 of its id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
