"""Golden micro-fixture: hand-checked expected values for the network slice."""

import pytest

from tidepool.operators import network as net
from tidepool.operators.clean import disambiguate_names

ROWS = [
    ("W1", "FR", "Alpha Institute", "I1", "r1"),
    ("W1", "JP", "Beta University", "I2", "r2"),
    ("W1", "JP", "Beta University", "I2", "r2"),
    ("W2", "FR", "Alpha Institute", "I1", "r1"),
    ("W2", "US", "National Museum", "I3", "r3"),
    ("W2", "GB", "National Museum", "I4", "r4"),
    ("W3", "JP", "Beta University", "I2", "r2"),
    ("W3", "FR", "Alpha Institute", "I5", "r5"),
    ("W3", "FR", "Alpha Institute", "I1", "r1"),
    ("W4", "US", "National Museum", "I3", "r3"),
    ("W5", None, "Gamma Lab", "I6", "r6"),
    ("W6", "JP", "Beta University", "I2", "r2"),
]
SCHEMA = "id string, country_code string, display_name string, institution_id string, ror string"


@pytest.fixture(scope="module")
def mini(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).dropna("any").distinct()
    return disambiguate_names(df, "display_name", "country_code")


def test_clean_and_disambiguate(mini):
    assert mini.count() == 10
    names = {r.display_name for r in mini.select("display_name").distinct().collect()}
    assert names == {"Alpha Institute", "Beta University", "National Museum (US)", "National Museum (GB)"}


def test_pairs(mini):
    got = {(r.item1, r.item2): r.n for r in net.cooccurrence(mini, "display_name", "id").collect()}
    assert got == {
        ("Alpha Institute", "Beta University"): 2,
        ("Alpha Institute", "National Museum (GB)"): 1,
        ("Alpha Institute", "National Museum (US)"): 1,
        ("National Museum (GB)", "National Museum (US)"): 1,
    }


def test_works_degree_rescale(mini):
    works = net.distinct_counts(mini, "display_name", "id")
    assert {r.name: r.works for r in works.collect()} == {
        "Alpha Institute": 3, "Beta University": 3, "National Museum (GB)": 1, "National Museum (US)": 2}
    deg = net.weighted_degree(net.cooccurrence(mini, "display_name", "id"), "item1", "item2", "n")
    d = {r.name: r.total_collaborations for r in deg.collect()}
    assert d == {"Alpha Institute": 4, "Beta University": 2, "National Museum (GB)": 2,
                 "National Museum (US)": 2}
    assert sum(d.values()) == 10
    sized = {r.name: round(r.symbol_size, 6) for r in net.rescale(works, "works").collect()}
    assert sized == {"Alpha Institute": 100.0, "Beta University": 100.0,
                     "National Museum (US)": 52.5, "National Museum (GB)": 5.0}


def test_country_pairs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).dropna("any").distinct()
    got = {(r.item1, r.item2): r.n for r in net.cooccurrence(df, "country_code", "id").collect()}
    assert got == {("FR", "JP"): 2, ("FR", "GB"): 1, ("FR", "US"): 1, ("GB", "US"): 1}


def test_directed_pairs_are_symmetric(mini):
    d = net.cooccurrence(mini, "display_name", "id", directed=True)
    got = {(r.item1, r.item2): r.n for r in d.collect()}
    assert all(got[(b, a)] == n for (a, b), n in got.items())
    assert len(got) == 8


def test_fixture_triangle_centroid(spark):
    from tidepool.operators.places import centroid
    from tidepool.plans import fixtures as fx
    rows = [(1, -0.2, -0.2, 0.2, -0.2), (1, 0.2, -0.2, 0.0, 0.25), (1, 0.0, 0.25, -0.2, -0.2)]
    r = centroid(spark.createDataFrame(rows, "poly_id int, x1 double, y1 double, x2 double, y2 double")).first()
    assert (r.poly_id, r.area, r.cx, r.cy) == (1, 0.09, 0.0, -0.05)
