"""Every analog query equals its DuckDB oracle (rows, columns, types, values)."""

import pytest

from tidepool.plans.oracle import ORACLE

from .conftest import SF_CHECK


@pytest.fixture(scope="module")
def results(spark):
    from tidepool.plans.verify import compare
    return compare(spark, SF_CHECK)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(results, name):
    r = results[name]
    assert r.get("ok"), r


def test_every_query_has_an_oracle():
    import __spark_entry__ as entry
    from tidepool.plans.analogs import QUERIES
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 49


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["source", "target"]
    assert len(rows) == 10
