"""Operators against brute force on random small inputs (hypothesis)."""

from collections import defaultdict
from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepool.operators import network as net
from tidepool.operators.clean import fill_down, first_per_key
from tidepool.operators.places import classify_points

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

names = st.sampled_from(["a", "b", "b-c", "c", "d-", "e", None])
feats = st.sampled_from(["f1", "f2", "f3", "f4", None])


@SETTINGS
@given(st.lists(st.tuples(names, feats), min_size=0, max_size=40))
def test_cooccurrence_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "item string, feature string")
    got = {(r.item1, r.item2): r.n for r in net.cooccurrence(df, "item", "feature").collect()}
    by_feat = defaultdict(set)
    for i, f in rows:
        if i is not None and f is not None:
            by_feat[f].add(i)
    want = defaultdict(int)
    for items in by_feat.values():
        for a, b in combinations(sorted(items), 2):
            want[(a, b)] += 1
    assert got == dict(want)


@SETTINGS
@given(st.lists(st.tuples(names, feats), min_size=0, max_size=60), st.sampled_from([1, 2, 5]))
def test_salted_cooccurrence_equals_plain(spark, rows, hot):
    df = spark.createDataFrame(rows, "item string, feature string")
    plain = {tuple(r) for r in net.cooccurrence(df, "item", "feature").collect()}
    salted = {tuple(r) for r in net.cooccurrence(df, "item", "feature", hot_items=hot).collect()}
    assert plain == salted


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from("xyz"))),
                min_size=1, max_size=60),
       st.sampled_from([1, 2, 3, 7, 1000]), st.sampled_from([0, 1, 2]), st.sampled_from([1, 97]))
def test_fill_down_matches_sequential_scan(spark, rows, chunk, levels, stride):
    data = [(i * stride, u, v) for i, (u, v) in enumerate(rows)]   # stride: sparse ids
    df = spark.createDataFrame(data, "seq long, grp int, v string")
    got = {r.seq: r.v for r in fill_down(df, "v", "grp", "seq", chunk=chunk, levels=levels).collect()}
    last = {}
    want = {}
    for i, u, v in data:
        if v is not None:
            last[u] = v
        want[i] = last.get(u)
    assert got == want


def _inside(px, py, edges):
    n = 0
    for x1, y1, x2, y2 in edges:
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            n += 1
    return n % 2 == 1


coords = st.floats(-1, 1, allow_nan=False).map(lambda v: round(v, 3))


@SETTINGS
@given(st.lists(st.tuples(coords, coords), min_size=3, max_size=7),
       st.lists(st.tuples(coords, coords), min_size=1, max_size=30),
       st.sampled_from([0.05, 0.3, 2.0]))
def test_point_in_polygon_matches_brute_force(spark, ring, pts, band):
    edges = [(1, *ring[i], *ring[(i + 1) % len(ring)]) for i in range(len(ring))]
    e = spark.createDataFrame(edges, "poly_id int, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "vec_id long, x double, y double")
    got = {r.vec_id: r.inside for r in classify_points(p, e, band=band).collect()}
    want = {i: _inside(x, y, [r[1:] for r in edges]) for i, (x, y) in enumerate(pts)}
    assert got == want


def test_first_per_key_keeps_smallest(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("j", 2, "b")], "key string, o int, v string")
    got = {r.key: (r.o, r.v) for r in first_per_key(df, "key", ["o"]).collect()}
    assert got == {"k": (1, "a"), "j": (2, "b")}


def test_rescale_bounds_and_flat(spark):
    df = spark.createDataFrame([(1,), (4,), (10,)], "v int")
    got = sorted(r.symbol_size for r in net.rescale(df, "v", (5.0, 100.0)).collect())
    assert got[0] == 5.0 and got[-1] == 100.0
    flat = spark.createDataFrame([(3,), (3,)], "v int")
    assert {r.symbol_size for r in net.rescale(flat, "v", (4.0, 80.0)).collect()} == {42.0}


@SETTINGS
@given(st.lists(st.tuples(coords, coords), min_size=3, max_size=6),
       st.lists(st.tuples(coords, coords), min_size=3, max_size=6),
       st.lists(st.tuples(coords, coords), min_size=1, max_size=25))
def test_point_in_polygons_broadcast_or_not(spark, ring1, ring2, pts):
    import tidepool.operators.places as places
    edges = [(1, *ring1[i], *ring1[(i + 1) % len(ring1)]) for i in range(len(ring1))]
    edges += [(2, *ring2[i], *ring2[(i + 1) % len(ring2)]) for i in range(len(ring2))]
    e = spark.createDataFrame(edges, "poly_id int, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "vec_id long, x double, y double")
    want = {i: _inside(x, y, [r[1:] for r in edges if r[0] == 1]) or _inside(x, y, [r[1:] for r in edges if r[0] == 2])
            for i, (x, y) in enumerate(pts)}
    got = {r.vec_id: r.inside for r in classify_points(p, e, band=0.2).collect()}
    assert got == want
    twice = classify_points(p.unionAll(p), e, band=0.2).collect()  # equal points stay rows of their own
    assert len(twice) == 2 * len(pts) and all(r.inside == want[r.vec_id] for r in twice)
    original = places.bounded_broadcast
    places.bounded_broadcast = lambda df, **kw: df   # a shuffle join
    try:
        rows = {r.vec_id: r.inside for r in places.classify_points(p, e, band=0.2).collect()}
    finally:
        places.bounded_broadcast = original
    assert rows == want
