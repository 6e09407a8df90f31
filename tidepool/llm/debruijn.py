"""Substring deduplication on a compacted de Bruijn graph of words.

The edges of the graph are the windows of ``span`` words (k-mers of tokens),
its nodes the overlaps between them. Edges that follow one another under one
minimizer are a path, and equal nonbranching paths are compacted into one row
by Spark joins (``repeats``), so most of the graph is never expanded; where the
paths of a minimizer branch, their edges are compared one by one. The sources'
coordinates then say which words of which documents a repeated edge covers, and
consecutive ones are joined into long repeated spans.

Defined results: a NULL or empty text has no words and keeps the empty string;
a text of fewer than ``span`` words keeps all; repeated rows repeat each other;
a NULL id is an id; an empty table gives no rows; only the named columns are
used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing, repeats
from tidepool.llm.common import slices, written

KEPT = "doc_id long, n_words long, n_removed long, n_spans long, kept string"


def _windows(batches: Iterator[pa.RecordBatch], unit: repeats.Unit) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 2, repeats.SLICE):
            symbols, offsets, _ = unit.read(part.column(2))
            lists = part.column(3)
            text = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            start, n, a, count = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            own = pa.array(text)
            yield repeats.window_rows(part.column(0).take(own), part.column(1).take(own), start, n, a, count, offsets[text] + start,
                                      hashing.prefix_sums(symbols), unit)


def repeated_spans(docs: DataFrame, unit: repeats.Unit) -> DataFrame:
    """Places (id, h, start, n words) that repeated windows cover."""
    found = repeats.repeated_paths(docs, unit)
    windows = written(repeats.with_sources(docs, found.once).mapInArrow(lambda it: _windows(it, unit), repeats.WINDOWS), "edges")
    places = found.whole.unionAll(repeats.repeated_windows(windows))
    return places.withColumn("n", F.col("n") + unit.span - 1)


def _keep(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1, repeats.SLICE):
            rows = []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                w = text.encode().split()  # splits at the six blanks of ASCII, as the words are defined
                gone = repeats.removed_mask(len(w), spans)
                kept = b" ".join([x for x, g in zip(w, gone.tolist()) if not g] if spans else w)
                rows.append((len(w), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(w) else 0,
                             kept.decode() if whole else hashlib.sha256(kept).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, zip(*rows))], ["doc_id", "n_words", "n_removed", "n_spans", "kept"])


def drop_repeated_words(df: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = 35, kmer: int = 12,
                        digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans and ``kept``: the words left, joined by a blank, or their SHA-256."""
    docs = repeats.documents(df, id_col, text)
    places = repeated_spans(docs, repeats.Unit("word", span, kmer))
    return repeats.covered(docs, places).mapInArrow(lambda it: _keep(it, not digest), KEPT).withColumnRenamed("doc_id", id_col)
