"""Sharding, whitening and collocations against plain versions."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.util import awkward_docs, clashing, frame
from tidepool.llm import collocations, sharding, whitening


# ---- op11 -------------------------------------------------------------------

def plain_interleave(rows, shards, seed):
    """(doc_id, source, n_chars, shard, slot) by the rule, ties by the columns compared."""
    none_first = lambda x: (x is not None, x if x is not None else 0)
    code = lambda x: hashlib.md5(f"{seed}:{'' if x is None else x}".encode()).hexdigest()
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((code(r[0]), none_first(r[0]), none_first(r[4]), r))
    line = []
    for source, rs in by.items():
        rs.sort(key=lambda x: x[:3])
        line += [(float(Fraction(2 * i + 1, 2 * len(rs))), *x[:3], (source is not None, source or ""), x[3]) for i, x in enumerate(rs)]
    line.sort(key=lambda x: x[:5])
    n, out = len(line), []
    for p, x in enumerate(line):
        shard = p * shards // n
        out.append((x[5][0], x[5][3], x[5][4], shard, p - -(-shard * n // shards)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shards,seed", [(1, 0), (7, 3), (500, 0)])
def test_shards_match_a_plain_version(spark, shards, seed):
    got = sharding.interleave(clashing(frame(spark)).drop("slot"), shards, seed, order=("doc_id", "n_chars"))
    rows = sorted(((r.doc_id, r.source, r.n_chars, r.shard, r.slot) for r in got.collect()), key=repr)
    assert rows == plain_interleave(awkward_docs(), shards, seed)


def test_shards_hold_the_mixture_whatever_the_layout(spark):
    # One source with a third of all rows, one with a row, ids with many copies.
    docs = spark.range(9000).select((F.col("id") % 4000).alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, "one")
                                    .otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"), F.col("id").alias("own"))
    got = sharding.interleave(docs, 40, 5, order=("doc_id", "own"))
    rows = got.collect()
    per = Counter(r.shard for r in rows)
    assert set(per) == set(range(40)) and max(per.values()) - min(per.values()) <= 1
    for source, n in Counter(r.source for r in rows).items():
        in_shard = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(in_shard[s] - n / 40) < 2 for s in range(40)), source
    for s in range(40):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(per[s]))
    again = sharding.interleave(docs.repartition(13, "own"), 40, 5, order=("doc_id", "own"))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))
    other = sharding.interleave(docs, 40, 6, order=("doc_id", "own"))
    assert sorted(map(tuple, rows)) != sorted(map(tuple, other.collect()))


def test_no_rows_and_written_shards(spark, tmp_path):
    assert sharding.interleave(frame(spark, []), 40).count() == 0
    got = sharding.interleave(frame(spark), 3)
    sharding.write_shards(got, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {"shard=0", "shard=1", "shard=2"} <= {p.name for p in (tmp_path / "out").iterdir()}
    assert sorted(map(repr, got.select(sorted(got.columns)).collect())) == sorted(map(repr, back.select(sorted(got.columns)).collect()))
    with pytest.raises(ValueError):
        sharding.interleave(frame(spark), 0)


# ---- op12 -------------------------------------------------------------------

def plain_whitening(rows, count, scale=64, shift=1_000_000):
    """{(id, place): whitened} up to sign, deviations, shares; exact means."""
    fine = [(i, [int(np.floor(scale * c)) + shift for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    dim = Counter(len(v) for _, v in fine).most_common(1)[0][0]
    fine = [(i, v) for i, v in fine if len(v) == dim]
    distinct = sorted({tuple(v) for _, v in fine})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = lambda v: np.array([float(Fraction(n * x - s, n)) for x, s in zip(v, sums)])
    a = np.array([centred(v) for v in distinct])
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [k for k in range(min(count, dim)) if values[k] > values[0] * 1e-12]
    out = [(i, [float(centred(v) @ vectors[:, k] / np.sqrt(values[k])) for k in keep], sum((n * x - s) ** 2 for x, s in zip(v, sums)))
           for i, v in fine]
    return n, out, [values[k] / values.sum() for k in keep]


VECTORS = "vec_id long, embedding array<float>"


def some_vectors(kind, n=300, dim=9):
    r = np.random.default_rng(4)
    a = r.normal(size=(n, dim)) * np.linspace(1, 40, dim)
    if kind == "constant":
        a[:, 3] = 7.5
    if kind == "dependent":
        a = np.round(a * 64) / 64
        a[:, 5] = a[:, 1] + a[:, 2]
    if kind == "narrow":
        a = 5000 + a * 0.02
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(a.astype(np.float32))]
    return rows + [(n + i, rows[0][1]) for i in range(n // 2)] + [
        (None, rows[1][1]), (1, rows[2][1]), (-1, None), (-2, []), (-3, [None, *rows[0][1][1:]]), (-4, [float("nan"), *rows[0][1][1:]]),
        (-5, [float("inf"), *rows[0][1][1:]]), (-6, rows[0][1][:-1])]


@pytest.mark.parametrize("kind", ["plain", "constant", "dependent", "narrow"])
def test_whitening_matches_eigenvectors(spark, kind):
    rows = some_vectors(kind)
    df = spark.createDataFrame(rows, VECTORS).repartition(5).withColumns({c: F.lit("x") for c in ("x", "n", "component", "deviation")})
    model = whitening.fit(df, components=16)
    n, want, shares = plain_whitening(rows, 16)
    assert model.n == n and model.identity_error < 1e-9 and model.passes >= 2
    np.testing.assert_allclose(model.explained, shares, rtol=1e-6)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got = sorted(((r.vec_id, r.whitened, r.deviation) for r in whitening.transform(df, model).collect()), key=key)
    want = sorted(want, key=key)
    assert [(i, d) for i, _, d in got] == [(i, d) for i, _, d in want]
    g, w = np.array([x[1] for x in got]), np.array([x[1] for x in want])
    signs = np.sign((g * w).sum(0))  # either sign, the same for all rows
    np.testing.assert_allclose(g * signs, w, atol=1e-5)


def test_whitening_of_little_or_nothing(spark):
    assert whitening.fit(spark.createDataFrame([], VECTORS)) is None
    assert whitening.transform(spark.createDataFrame([], VECTORS), None).count() == 0
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], VECTORS)
    model = whitening.fit(same)
    assert (model.n, model.explained) == (1, [])
    assert [(r.vec_id, r.whitened, r.deviation) for r in whitening.transform(same, model).orderBy("vec_id").collect()] == [(1, [], 0), (2, [], 0)]
    far = spark.createDataFrame([(1, [1e14, 1.0]), (2, [0.0, 2.0]), (3, [3.0, 2.0])], VECTORS)
    assert [r.deviation for r in whitening.transform(far, whitening.fit(far)).collect()] == [None, None, None]


# ---- op13 -------------------------------------------------------------------

def plain_collocations(rows, least, longest, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = {(g, p[i:i + m]) for (g, p), a in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if a >= cand[g, p[i:i + m]]}
    out = []
    for (g, p), a in cand.items():
        if (g, p) not in inside:
            score, k = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p)))
            out.append((g, -score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]], n[g]))
    got, seen = [], Counter()
    for g, s, a, p, l, r, m in sorted(out):
        seen[g] += 1
        if seen[g] <= top:
            got.append((g, seen[g], p.decode(), -a, l, r, m, -s))
    return got


@pytest.mark.parametrize("least,longest,top", [(2, 5, 10 ** 6), (5, 3, 40), (100, 5, 2000)])
def test_collocations_match_a_plain_version(spark, least, longest, top):
    rows = awkward_docs() + [(900 + i, "New York, new  york\tcity hall! the Big city hall; the big", "en", "a", 1) for i in range(120)]
    got = collocations.collocations(clashing(frame(spark, rows)).repartition(3), least, longest, top)
    assert sorted(map(tuple, got.collect())) == sorted(plain_collocations(rows, least, longest, top))


def test_no_collocations(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(1, "a b c", "en", "s", 5)])).count() == 0


@pytest.mark.parametrize("size", [1, 7, 40, 1 << 20])
def test_runs_do_not_depend_on_blocks(size):
    texts = pa.array(["The cat. the  cat sat", None, "", " \t", "sat the cat", "x" * 90 + " the cat\nsat"])
    got, salts = Counter(), np.array([11, 12], dtype=np.uint64)
    langs = np.array([0, 0, 0, 0, 1, 1])
    for k in range(1, 6):
        for block in collocations._blocks(texts, langs, k - 1, size):
            got.update(zip([k] * 99, block.prints(block.runs(k), k, salts).tolist()))
    whole = Counter()
    for k in range(1, 6):
        block, = collocations._blocks(texts, langs, 0, 1 << 30)
        whole.update(zip([k] * 99, block.prints(block.runs(k), k, salts).tolist()))
    assert got == whole and sum(n for (k, _), n in whole.items() if k == 2) == 1 + 2 + 2 + 2


def test_working_tables_stay_small():
    """A worker's tables for 4 MB of texts stay under 100 MB beside the texts (before: 134), and nothing is lost between blocks."""
    import tracemalloc
    one = " ".join(f"w{i}" for i in range(1000)) + "."
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 800), pa.array([one] * 800)], ["lang", "text"])
    n = Counter()
    tracemalloc.start()
    for out in collocations._count_prints(1, None, iter([batch])):
        n.update(dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist())))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(n) == 1000 and set(n.values()) == {800}
    assert peak < 100 << 20


def test_colliding_runs_are_told_apart():
    ids = np.array([0, 1, 0, 1, 2, 1, 0, 1])
    i = np.arange(7)
    first, n = collocations.verified(np.zeros(7, dtype=np.uint64), i, 2, ids)  # all fingerprints equal
    assert Counter({(ids[a], ids[a + 1]): c for a, c in zip(first.tolist(), n.tolist())}) == Counter(zip(ids.tolist(), ids[1:].tolist()))
