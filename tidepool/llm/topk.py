"""Exact top-k by distributed histogram selection.

Every query is scored against every vector. No score is kept: a pass over the
vectors counts, for each query, its scores in the bins of a histogram, Spark
adds the histograms up, and the next pass splits the bin that holds the k-th
highest score. When each located bin is one score wide, or holds a handful of
scores, a last pass keeps what lies at or above it, at most k rows per query
and task (higher scores first, then smaller ids, which cannot drop a row of
the answer), and a window breaks ties.

Queries are taken in blocks of a bounded number of bytes (``block_bytes``),
ordered by id; a block and its histogram state are what is broadcast and what
the driver holds. A pass reads the vectors once for a whole block.

Defined results: components become floor(scale * x), x as double; a vector
that is NULL or empty, holds NULL, NaN or an infinity, or whose id is NULL,
takes no part; vectors of different lengths have no score with each other; the
rows that carry the query's own id are never its candidates; a query id on
several rows is asked once, with its smallest vector; a repeated candidate row
counts as often as it is there; an empty table gives no rows; further columns
are ignored. Scores are exact integers; one that does not fit 64 bits raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm.common import written

BINS = 256


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v): the vectors that take part, as integers."""
    v = F.col("v")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & (F.size(v) > 0) & finite)
            .select("id", F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x)).alias("v")))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of a batch for each vector length in it."""
    ids, vecs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    flat, ends = vecs.values.to_numpy(zero_copy_only=False), vecs.offsets.to_numpy()
    sizes = np.diff(ends)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield ids[at], flat[(ends[at][:, None] + np.arange(dim)[None, :])]


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products; floats are used only where every sum is exact in them."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < 2.0**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if bound < 2.0**62:
        return q @ c.T
    exact = q.astype(object) @ c.T.astype(object)
    if max(abs(int(x)) for x in exact.ravel()) >= 2**63:
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


class _Block:
    """One block of queries and, per query, the histogram's low end and bin width."""

    def __init__(self, ids: np.ndarray, vectors: list[list[int]], lo: np.ndarray, width: np.ndarray):
        self.ids, self.lo, self.width = ids, lo, width
        sizes = np.array([len(v) for v in vectors])
        self.by_dim = {int(d): (at, np.array([vectors[i] for i in at], dtype=np.int64))
                       for d in np.unique(sizes) for at in [np.flatnonzero(sizes == d)]}

    def against(self, ids: np.ndarray, vecs: np.ndarray, step: int = 2048) -> Iterator[tuple]:
        """(places of queries, candidate ids, scores, own) piece by piece."""
        if vecs.shape[1] in self.by_dim:
            at, q = self.by_dim[vecs.shape[1]]
            for i in range(0, len(ids), step):
                part = ids[i:i + step]
                yield at, part, _scores(q, vecs[i:i + step]), self.ids[at][:, None] == part[None, :]


def _histograms(block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    b = block.value
    counts = np.zeros((len(b.ids), BINS), dtype=np.int64)
    for batch in batches:
        for ids, vecs in _rows(batch):
            for at, _, s, own in b.against(ids, vecs):
                k = (s - b.lo[at][:, None]) // b.width[at][:, None]
                use = (k >= 0) & (k < BINS) & ~own
                key = (at[:, None] * BINS + k)[use]
                counts += np.bincount(key, minlength=counts.size).reshape(counts.shape)
    q, k = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(k.astype(np.int64)), pa.array(counts[q, k])], ["q", "bin", "n"])


def _above(block, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    b = block.value
    for batch in batches:
        for ids, vecs in _rows(batch):
            for at, cand, s, own in b.against(ids, vecs):
                i, j = np.nonzero((s >= b.lo[at][:, None]) & ~own)
                q, c, s = b.ids[at][i], cand[j], s[i, j]
                order = np.lexsort((c, -s, q))
                q, c, s = q[order], c[order], s[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                yield pa.RecordBatch.from_arrays([pa.array(x[rank < k]) for x in (q, c, s)], ["query_id", "vec_id", "score"])


def _locate(counts: DataFrame, need: DataFrame) -> DataFrame:
    """Per query the highest bin at which the running count from the top reaches what is needed."""
    run = W.partitionBy("q").orderBy(F.desc("bin"))
    total = counts.groupBy("q", "bin").agg(F.sum("n").alias("n")).join(need, "q")
    total = total.withColumn("cum", F.sum("n").over(run))
    return (total.filter((F.col("cum") >= F.col("need")) & (F.col("cum") - F.col("n") < F.col("need")))
            .select("q", "bin", "n", (F.col("need") - F.col("cum") + F.col("n")).alias("need")))


def exact_top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
                scale: int = 256, block_bytes: int = 8 << 20, settle: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query row of ``df``."""
    spark = df.sparkSession
    vectors = integer_vectors(df, id_col, vec_col, scale)
    queries = written(integer_vectors(df.filter(is_query), id_col, vec_col, scale)
                      .groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    norm, = vectors.agg(F.max(square)).first()
    dim, = queries.agg(F.max(F.size("v"))).first()
    out = None
    if norm is not None and dim is not None:
        size = max(1, block_bytes // (8 * dim + 24 * BINS))
        last = None
        while True:
            rows = (queries if last is None else queries.filter(F.col("id") > last)).orderBy("id").limit(size).collect()
            if not rows:
                break
            last = rows[-1]["id"]
            part = written(_block_top_k(spark, vectors, rows, k, int(norm) + 2, settle), "topk")
            out = part if out is None else out.unionAll(part)
    if out is None:
        out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _block_top_k(spark, vectors: DataFrame, rows: list, k: int, bound: int, settle: int) -> DataFrame:
    """The candidates at or above each query's located score; ``bound``: no score is further from 0."""
    ids, vecs = np.array([r["id"] for r in rows], dtype=np.int64), [r["v"] for r in rows]
    n = len(ids)
    lo = np.full(n, max(-bound, -(2**62)), dtype=np.int64)
    first = 1
    while first * BINS < 2 * bound and first < 2**54:
        first *= BINS  # powers of BINS: the bins of a pass fill the bin they split
    width = np.full(n, first, dtype=np.int64)
    need, open_ = np.full(n, k, dtype=np.int64), np.ones(n, dtype=bool)
    while open_.any():
        block = spark.sparkContext.broadcast(_Block(ids[open_], [vecs[i] for i in np.flatnonzero(open_)], lo[open_], width[open_]))
        counts = vectors.mapInArrow(lambda it, b=block: _histograms(b, it), "q long, bin long, n long")
        left = spark.createDataFrame(list(enumerate(need[open_].tolist())), "q long, need long")
        found = {r["q"]: r for r in _locate(counts, left).collect()}
        block.unpersist()
        for q, i in enumerate(np.flatnonzero(open_)):
            if (r := found.get(q)) is None:  # fewer than k candidates: all of them are the answer
                lo[i], open_[i] = -(2**63), False
                continue
            lo[i] += r["bin"] * width[i]
            need[i] = r["need"]
            open_[i] = width[i] > 1 and r["n"] > settle
            width[i] = max(1, width[i] // BINS) if open_[i] else width[i]
    block = spark.sparkContext.broadcast(_Block(ids, vecs, lo, width))
    return vectors.mapInArrow(lambda it, b=block: _above(b, k, it), "query_id long, vec_id long, score long")
