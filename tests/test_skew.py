"""One key holding a third of all rows: results stay exact on every path."""

import random
from collections import Counter, defaultdict
from itertools import combinations


from tidepool.operators import network as net
from tidepool.operators import text
from tidepool.operators.clean import disambiguate_names, fill_down
from tidepool.plans.verify import plan_text


def _links(seed=7):
    rnd = random.Random(seed)
    rows = [(f"i{k}", "HOT") for k in range(300)]                       # one feature, a third of the rows
    rows += [(f"i{rnd.randrange(400)}", f"f{rnd.randrange(150)}") for _ in range(600)]
    return rows


def test_hot_feature_pairs_exact_and_salted(spark):
    rows = _links()
    df = spark.createDataFrame(rows, "item string, feature string")
    out = net.cooccurrence(df, "item", "feature", hot_items=50)
    assert "_bl" in plan_text(out)                                     # the salted path is planned
    by_feat = defaultdict(set)
    for i, f in rows:
        by_feat[f].add(i)
    want = Counter()
    for items in by_feat.values():
        for a, b in combinations(sorted(items), 2):
            want[(a, b)] += 1
    got = {(r.item1, r.item2): r.n for r in out.collect()}
    assert got == dict(want)


def test_hot_user_fill_down(spark):
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else rnd.randrange(1, 40)              # user 0 holds a third
        data.append((i, user, rnd.choice(["a", "b", None, None, None])))
    df = spark.createDataFrame(data, "seq long, grp int, v string")
    got = {r.seq: r.v for r in fill_down(df, "v", "grp", "seq", chunk=64).collect()}
    last, want = {}, {}
    for i, u, v in data:
        if v is not None:
            last[u] = v
        want[i] = last.get(u)
    assert got == want


def test_hot_token_counts(spark):
    docs = [(d, " ".join(["sea"] * 50 + [f"w{d % 7}", f"x{d}"])) for d in range(60)]
    df = spark.createDataFrame(docs, "page_id long, text string")
    grams = text.unigrams(df, keep=["page_id"])
    got = {r.ngram: (r.n, r.pages) for r in text.ngram_counts(grams).collect()}
    occ, pages = Counter(), defaultdict(set)
    for d, t in docs:
        for w in t.split(" "):
            occ[w] += 1
            pages[w].add(d)
    assert got == {w: (occ[w], len(pages[w])) for w in occ}


def test_hot_name_disambiguation(spark):
    rows = [(k, "Big Lab", "FR" if k % 2 else "JP") for k in range(300)]
    rows += [(k, f"Lab{k % 9}", "US") for k in range(300, 900)]
    df = spark.createDataFrame(rows, "id long, name string, cc string")
    got = Counter(r.name for r in disambiguate_names(df, "name", "cc").collect())
    assert got["Big Lab (FR)"] == 150 and got["Big Lab (JP)"] == 150
    assert sum(v for k, v in got.items() if k.startswith("Lab")) == 600


def test_fill_down_levels_follow_id_range(spark):
    from tidepool.operators.clean import _levels_for
    dense = spark.range(1000).withColumnRenamed("id", "seq")
    sparse = spark.range(1000).selectExpr("id * 1000003 AS seq")
    assert _levels_for(dense, "seq", 16) == 1          # 999 // 16 = 62 blocks >= 16 -> one level up
    assert _levels_for(dense, "seq", 1 << 16) == 0
    assert _levels_for(sparse, "seq", 16) >= 3
