"""Operators whose results are held against brute force: repeats of words and bytes, Jaccard components."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.util import WORD, awkward_docs, clashing, frame, rows_of
from tidepool.llm import debruijn, graphs, hashing, jaccard, pfp, repeats


def small_alphabet(seed=5):
    """Texts in which repeats of every kind overlap, with runs, copies, NULLs and repeated rows."""
    r, rows = random.Random(seed), []
    for i in range(120):
        text = "".join(r.choice("ab") for _ in range(r.randint(0, 60)))
        if rows and r.random() < 0.4:
            text = text[:20] + (r.choice(rows)[1] or "")[:30]
        if r.random() < 0.1:
            text = "a" * r.randint(0, 40)
        rows.append((i if r.random() < 0.95 else None, text if r.random() < 0.97 else None))
    return rows + rows[:8]


def removed(units, span):
    """For each list of symbols, whether each is covered by a window that starts elsewhere, too."""
    seen = Counter(tuple(u[x:x + span]) for u in units for x in range(len(u) - span + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for x in range(len(u) - span + 1):
            if seen[tuple(u[x:x + span])] > 1:
                gone[x:x + span] = [True] * span
        out.append(gone)
    return out


def runs(gone):
    return sum(g and not before for g, before in zip(gone, [False, *gone]))


@pytest.mark.parametrize("span,kmer", [(4, 2), (7, 3), (5, 5)])
def test_repeated_words_match_brute_force(spark, span, kmer):
    rows = [(i, t and " ".join(t)) for i, t in small_alphabet()]
    units = [WORD.findall(t or "") for _, t in rows]
    want = [(i, len(u), sum(g), runs(g), " ".join(w for w, x in zip(u, g) if not x)) for (i, _), u, g in zip(rows, units, removed(units, span))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = debruijn.drop_repeated_words(clashing(df), span=span, kmer=kmer)
    assert rows_of(got) == sorted(want, key=repr)


@pytest.mark.parametrize("span,kmer,most", [(12, 4, 64), (12, 4, 1), (9, 3, 2)])
def test_repeated_bytes_match_brute_force(spark, span, kmer, most):
    rows = small_alphabet()
    units = [(t or "").encode() for _, t in rows]
    want = [(i, len(u), sum(g), runs(g), hashlib.sha256(bytes(b for b, x in zip(u, g) if not x)).hexdigest())
            for (i, _), u, g in zip(rows, units, removed(units, span))]
    docs = repeats.documents(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    places = pfp.repeated_bytes(docs, repeats.Unit("byte", span, kmer), most)
    got = repeats.covered(docs, places).mapInArrow(lambda it: pfp._keep(it, False), pfp.KEPT).drop("kept")
    assert rows_of(got) == sorted(want, key=repr)


def test_repeats_of_awkward_documents(spark):
    rows = awkward_docs()
    words, texts = [WORD.findall(r[1] or "") for r in rows], [(r[1] or "").encode() for r in rows]
    got = rows_of(debruijn.drop_repeated_words(clashing(frame(spark)), digest=True))
    want = [(r[0], len(w), sum(g), runs(g), hashlib.sha256(" ".join(x for x, y in zip(w, g) if not y).encode()).hexdigest())
            for r, w, g in zip(rows, words, removed(words, 35))]
    assert got == sorted(want, key=repr)
    got = {(r["doc_id"], r["n_bytes"]): r for r in pfp.drop_repeated_bytes(clashing(frame(spark)), span=100).collect()}
    for r, u, g in zip(rows, texts, removed(texts, 100)):
        kept = bytes(b for b, x in zip(u, g) if not x)
        assert bytes(got[r[0], len(u)]["kept"]) == kept and got[r[0], len(u)]["n_spans"] == runs(g)


def test_a_passage_goes_when_it_holds_400_bytes_however_many_words(spark):
    r, docs, planted = random.Random(11), [], {}

    def text(words):
        return [f"{r.getrandbits(32):x}"[:r.randint(2, 8)] for _ in range(words)]

    for k, size in enumerate([330, 380, 397, 398, 400, 401, 500]):
        passage = " ".join(text(120))[:size].strip().ljust(size, "z")
        assert len(passage.split()) > 50
        for side in (0, 1):  # the blanks at both sides repeat, too
            planted[2 * k + side] = size + 2
            docs.append((2 * k + side, " ".join([*text(60), passage, *text(60)])))
    docs += [(100 + k, " ".join(text(150))) for k in range(10)]
    got = {row["doc_id"]: row for row in pfp.drop_repeated_bytes(spark.createDataFrame(docs, "doc_id long, text string"), digest=True).collect()}
    gone = removed([t.encode() for _, t in docs], 400)
    assert {i: (got[i]["n_removed"], got[i]["n_spans"]) for i, _ in docs} == {i: (sum(g), runs(g)) for (i, _), g in zip(docs, gone)}
    for i, _ in docs:
        assert (got[i]["n_removed"] >= planted.get(i, 400)) == (planted.get(i, 0) >= 400)


def test_repeats_of_nothing(spark):
    assert debruijn.drop_repeated_words(frame(spark, [])).count() == 0
    assert pfp.drop_repeated_bytes(frame(spark, [])).count() == 0
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0


def test_leaders_agree_above_and_below_the_place_bound(monkeypatch):
    values = hashing.mix(np.arange(3000, dtype=hashing.U) % hashing.U(700))
    small = repeats.leaders(values, 37)
    value = values >> hashing.U(repeats.PLACE_BITS)
    assert small.tolist() == [x + int(value[x:x + 37].argmin()) for x in range(len(values) - 36)]


def families(seed=3):
    r, out = random.Random(seed), []
    vocabulary = [f"w{k}" for k in range(300)]
    for _ in range(10):
        base = [r.choice(vocabulary) for _ in range(r.randint(20, 90))]
        for _ in range(r.choice([2, 5, 30, 50])):
            w = base[:]
            for _ in range(r.randint(0, r.choice([2, 4, 8]))):
                w[r.randrange(len(w))] = f"x{r.randint(0, 9999)}"
            out.append(" ".join(w))
    base = [r.choice(vocabulary) for _ in range(60)]
    for _ in range(70):  # differences that several texts share
        w = base[:]
        for k in r.sample(range(60), r.randint(0, 5)):
            w[k] = f"y{k % 7}"
        out.append(" ".join(w))
    out += [None, "", "a b", "A b", "a b c", "a B C d", "a b c d e", "É b c d", "é b c d"]
    r.shuffle(out)
    rows = [(k if r.random() < 0.98 else None, t) for k, t in enumerate(out)]
    return rows + rows[:6]


def plain_components(rows, size, percent):
    sets, of = [], defaultdict(list)
    for k, (_, text) in enumerate(rows):
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[a:a + size]) for a in range(max(1, len(w) - size + 1))} if w else set())
        for x in sets[-1]:
            of[x].append(k)
    above = list(range(len(rows)))

    def top(a):
        while above[a] != a:
            a = above[a]
        return a

    both = Counter((v[a], v[b]) for v in of.values() for a in range(len(v)) for b in range(a + 1, len(v)))
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            above[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(((i, len(sets[k]), least.get(top(k))) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("size,percent", [(4, 85), (3, 70)])
def test_components_match_brute_force(spark, size, percent):
    rows = families()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard.jaccard_components(clashing(df), size=size, percent=percent)) == plain_components(rows, size, percent)


def test_left_over_pairs_in_any_class_order(spark):
    """Two sets that share four lists, which two other components lead by number in some of them only."""
    shared, parts, want = [], [], []
    for case, order in enumerate(itertools.permutations(range(5))):
        a, b, c, q, r = (10 * case + k for k in order)
        shared += [(10 * case + t, x, 100, 4, 12, 8 + t) for t in range(4) for x in (a, b, q if t < 2 else r)]
        parts += [(a, a), (b, min(b, c)), (c, min(b, c)), (q, q), (r, r)]
        want.append((min(a, b), max(a, b)))
    shared = spark.createDataFrame(shared, "token long, cls long, n int, need int, head int, pos int")
    known = spark.createDataFrame([], "x long, y long, differ array<long>")
    got = jaccard._left_over(shared, spark.createDataFrame(parts, "cls long, part long"), known, 85)
    assert sorted(tuple(sorted(r)) for r in got.collect()) == want


def test_one_of_each_component_stays(spark):
    rows = [(*r, "en", "a", 1) for r in families()]
    got = jaccard.one_of_each(frame(spark, rows), size=4, percent=85).collect()
    found = plain_components([r[:2] for r in rows], 4, 85)
    wordy = Counter(c for _, n, c in found if n)
    assert Counter(r["doc_id"] for r in got if r["text"]) == Counter({c: 1 for c in wordy if c is not None}) + Counter(
        {None: wordy[None]} if wordy[None] else {})
    assert sum(1 for r in got if not r["text"]) == sum(1 for r in rows if not r[1])


def test_connected_components_match_union_find(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)] + [(100 + k, 101 + k) for k in range(40)]
    above = {x: x for e in edges for x in e if e[0] != e[1]}

    def top(a):
        while above[a] != a:
            a = above[a]
        return a

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
    got = graphs.components(spark.createDataFrame(edges, "x long, y long"))
    assert rows_of(got) == sorted(((x, top(x)) for x in above), key=repr)
    assert graphs.components(spark.createDataFrame([], "x long, y long")).count() == 0


@given(st.lists(st.lists(st.sampled_from("abcdefgh"), max_size=60), min_size=2, max_size=6))
@settings(max_examples=60, deadline=None)
def test_marks_never_rule_out_what_is_shared(texts):
    column = pa.array([" ".join(t) for t in texts])
    sets, signs = jaccard.shingle_sets(column, 3), jaccard.marks(column, 3)
    for s, a in zip(sets, signs):
        assert jaccard.most_shared(len(s), len(s), a, a) == len(s)
        for t, b in zip(sets, signs):
            both = len(np.intersect1d(s, t))
            assert both <= jaccard.most_shared(len(s), len(t), a, b) <= min(len(s), len(t))


def test_marks_rule_out_texts_without_a_common_shingle():
    column = pa.array([" ".join(f"{side}{i}" for i in range(n)) for side, n in (("a", 500), ("b", 500), ("b", 590))])
    a, b, longer = jaccard.marks(column, 5)
    assert jaccard.most_shared(496, 496, a, b) < 300
    assert jaccard.most_shared(496, 586, a, longer) < 330
    assert jaccard.most_shared(496, 586, b, longer) == 496


def test_shingles_of_a_batch_take_little_memory():
    """Tables for 4 MB of texts stay under 42 MB beside them (before: 56), and all texts are counted."""
    import tracemalloc
    one = " ".join(f"w{i}" for i in range(1000))
    batch = pa.RecordBatch.from_arrays([pa.array([one] * 800)], ["text"])
    tracemalloc.start()
    out, = jaccard._counts(iter([batch]), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(out.column(1).to_pylist()) == 800 * 996
    assert peak < 42 << 20


def test_freed_memory_is_given_back():
    """After a batch, a process holds about as much as before it (kept by the allocator before: more than 60 MB)."""
    from tidepool.llm import common

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) / 1024

    if common._TRIM is None:
        pytest.skip("no malloc_trim here")
    batch = pa.RecordBatch.from_arrays([pa.array(["a b"] * 10)], ["text"])
    common.give_back()
    before, last = held(), None
    for _ in common.slices(batch, 0):
        rows = [bytes(1000) for _ in range(100_000)]
        last = bytes(1000)  # keeps the end of the heap in use
        del rows
    assert last and held() < before + 30
