"""Size-checked broadcast."""

from tidepool.functions.joins import bounded_broadcast
from tidepool.plans.verify import plan_text


def _probe(spark):
    return spark.range(1000).selectExpr("id", "repeat('x', 100) AS pad")


def test_small_side_is_broadcast(spark):
    big = spark.range(100000).withColumnRenamed("id", "k")
    small = bounded_broadcast(_probe(spark))
    plan = plan_text(big.join(small, big.k == small.id))
    assert "BroadcastHashJoin" in plan


def test_row_bound_refuses(spark):
    side = bounded_broadcast(_probe(spark), max_rows=10)
    big = spark.range(100000).withColumnRenamed("id", "k")
    plan = plan_text(big.join(side, big.k == side.id).hint("no_broadcast_hash"))
    assert "ResolvedHint (strategy=broadcast)" not in plan
    assert side.count() == 1000


def test_byte_bound_refuses(spark):
    side = bounded_broadcast(_probe(spark), max_bytes=1000)
    assert "ResolvedHint" not in plan_text(side, "extended") and side.count() == 1000
    assert "ResolvedHint" in plan_text(bounded_broadcast(_probe(spark), max_bytes=10 << 20), "extended")


def test_checked_sides_leave_nothing_cached(spark):
    bounded_broadcast(_probe(spark)).count()
    assert not spark.sparkContext._jsc.getPersistentRDDs()
