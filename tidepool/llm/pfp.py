"""Exact substring deduplication of bytes by prefix-free parsing.

A rolling hash triggers phrase ends at the places where it is least within a
window, so equal texts are cut alike wherever they are, and every window holds
a trigger. A phrase reaches from its first byte through its trigger to the end
of the last window that starts in it. The dictionary of distinct phrases, with
counts, is made by Spark (``repeats``): a phrase that occurs again repeats as a
whole, at any number of copies, and a trigger that occurs once ends the search
for its windows. What is left are distinct phrases around an equal trigger.
Among these, two suffixes of the corpus that start in them share what the
dictionary's side (before the trigger, read backwards) and the parse's side
(from the trigger on) have in common. Both sides are sorted, as in a suffix
array, and common extensions come from the neighbours' longest common
prefixes: where both together reach ``span`` bytes, these bytes repeat.

A trigger with more than ``most`` distinct phrases is spread over all tasks
instead: their windows are compared by hash, each a row. Results are the same.

Defined results: a NULL text is empty; a text shorter than ``span`` keeps all;
repeated rows repeat each other; matches never cross texts; a NULL id is an
id; an empty table gives no rows; only the named columns are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing, repeats
from tidepool.llm.common import slices, written

PHRASES = "id long, h long, start int, n int, a long, count long, trigger int, bytes binary"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _phrases(batches: Iterator[pa.RecordBatch], unit: repeats.Unit) -> Iterator[pa.RecordBatch]:
    """The bytes of the distinct phrases, and where in them the trigger is."""
    for batch in batches:
        for part in slices(batch, 2, repeats.SLICE):
            symbols, offsets, data = unit.read(part.column(2))
            values = repeats.kmer_values(hashing.prefix_sums(symbols), unit.kmer) >> hashing.U(repeats.PLACE_BITS)
            lists = part.column(3)
            text = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            start, n, a, count = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            at = offsets[text] + start
            trigger = np.fromiter((values[x:x + unit.span - unit.kmer + 1].argmin() for x in at.tolist()), np.int32, len(at))
            own, whole = pa.array(text), data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(own), part.column(1).take(own), pa.array(start), pa.array(n), pa.array(a), pa.array(count),
                 pa.array(trigger), pa.array([whole[x:x + k + unit.span - 1] for x, k in zip(at.tolist(), n.tolist())], pa.binary())],
                [x.split()[0] for x in PHRASES.split(", ")])


def neighbours(sides: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each string, longest common prefix of each rank with the next): a suffix array of the sides."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    rank = np.empty(len(sides), dtype=np.int64)
    rank[order] = np.arange(len(sides))
    common = np.zeros(max(0, len(sides) - 1), dtype=np.int64)
    for r in range(len(sides) - 1):
        x, y = sides[order[r]], sides[order[r + 1]]
        k = min(len(x), len(y))
        if x[:k] == y[:k]:
            common[r] = k
        else:
            differ = np.frombuffer(x, np.uint8, k) != np.frombuffer(y, np.uint8, k)
            common[r] = int(differ.argmax())
    return rank, common


def extensions(rank: np.ndarray, common: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Longest common prefixes of all pairs: the least of the neighbours' between their ranks."""
    m = len(rank)
    by_rank = np.zeros((m, m), dtype=np.int64)
    for r in range(m):
        run = np.minimum.accumulate(common[r:])
        by_rank[r, r + 1:] = run
        by_rank[r + 1:, r] = run
    out = by_rank[np.ix_(rank, rank)]
    out[np.arange(m), np.arange(m)] = sizes
    return out


def _shared(bucket: pd.DataFrame, span: int) -> pd.DataFrame:
    """Places (id, h, start, n bytes) that phrases with an equal trigger share."""
    bucket = bucket.drop_duplicates(["id", "h", "start", "a"]).sort_values("a", kind="stable", ignore_index=True)
    a, trigger, whole = bucket["a"].to_numpy(), bucket["trigger"].to_numpy().astype(np.int64), bucket["bytes"].tolist()
    place, rows, starts, sizes = bucket["start"].to_numpy().astype(np.int64) + trigger, [], [], []
    edges = np.r_[0, np.flatnonzero(np.diff(a)) + 1, len(a)]
    for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if y - x < 2:
            continue
        before = [bytes(b[:t])[::-1] for b, t in zip(whole[x:y], trigger[x:y].tolist())]
        after = [bytes(b[t:]) for b, t in zip(whole[x:y], trigger[x:y].tolist())]
        left = extensions(*neighbours(before), np.array([len(b) for b in before]))
        right = extensions(*neighbours(after), np.array([len(b) for b in after]))
        reach = left + right
        reach[np.arange(y - x), np.arange(y - x)] = 0
        i, j = np.nonzero(reach >= span)
        rows.append(x + i)
        starts.append(place[x + i] - left[i, j])
        sizes.append(reach[i, j])
    if not rows:
        return pd.DataFrame({"id": [], "h": [], "start": [], "n": []})
    own = bucket.iloc[np.concatenate(rows)]
    out = pd.DataFrame({"id": own["id"].to_numpy(), "h": own["h"].to_numpy(), "start": np.concatenate(starts), "n": np.concatenate(sizes)})
    return out.drop_duplicates()


def _spread(batches: Iterator[pa.RecordBatch], unit: repeats.Unit) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 7, repeats.SLICE // 8):
            data, offsets = hashing.text_bytes(part.column(7).cast(pa.binary()).view(pa.string()))
            sums = hashing.prefix_sums(hashing.BYTE_HASHES[data])
            start, n, a, count = (part.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
            yield repeats.window_rows(part.column(0), part.column(1), start, n, a, count, offsets[:-1], sums, unit)


def repeated_bytes(docs: DataFrame, unit: repeats.Unit, most: int = 64, bucket: int = 4096) -> DataFrame:
    """Places (id, h, start, n bytes) that repeat."""
    found = repeats.repeated_paths(docs, unit)
    per = written(found.once.groupBy("a").agg(F.count("*").alias("phrases")), "triggers")
    once = found.once.join(per, "a")
    phrases = written(repeats.with_sources(docs, once.filter(F.col("phrases") <= most)).mapInArrow(lambda it: _phrases(it, unit), PHRASES), "phrases")
    hot = written(repeats.with_sources(docs, once.filter(F.col("phrases") > most)).mapInArrow(lambda it: _phrases(it, unit), PHRASES), "hot-phrases")
    buckets = max(1, round((phrases.count() or 1) / bucket))
    shared = phrases.groupBy(F.pmod(F.xxhash64("a"), F.lit(buckets)).alias("b")).applyInPandas(
        lambda pdf: _shared(pdf, unit.span), "id long, h long, start int, n int")
    windows = written(hot.mapInArrow(lambda it: _spread(it, unit), repeats.WINDOWS), "hot-windows")
    whole = found.whole.unionAll(repeats.repeated_windows(windows))
    return whole.withColumn("n", F.col("n") + unit.span - 1).unionAll(shared)


def _keep(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1, repeats.SLICE):
            data, offsets = hashing.text_bytes(part.column(1))
            rows = []
            for a, b, spans in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column(2).to_pylist()):
                gone = repeats.removed_mask(b - a, spans)
                kept = (data[a:b][~gone] if spans else data[a:b]).tobytes()
                runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
                rows.append((b - a, int(gone.sum()), runs, kept if whole else None, hashlib.sha256(kept).hexdigest()))
            if rows:
                n, removed, runs, kept, digest = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(removed), pa.array(runs), pa.array(kept, pa.binary()),
                                                  pa.array(digest)], [x.split()[0] for x in KEPT.split(", ")])


def drop_repeated_bytes(df: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = 400, kmer: int = 32,
                        digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the bytes left (NULL with ``digest``) and their SHA-256."""
    docs = repeats.documents(df, id_col, text)
    places = repeated_bytes(docs, repeats.Unit("byte", span, kmer))
    return repeats.covered(docs, places).mapInArrow(lambda it: _keep(it, not digest), KEPT).withColumnRenamed("doc_id", id_col)
