"""Equivalence classes: connected components of an edge table, and name variants of one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", node: str = "node", root: str = "root") -> DataFrame:
    """(node, root): the smallest node of each node's component, for all nodes of the edges.

    Star contraction: a round of large stars ties every neighbour above a node
    to the node's least neighbour, a round of small stars ties those up to the
    node to it; the edges shrink to one star a component in a number of rounds
    that grows with the logarithm of the longest chain. A round is two grouped
    minima (combined map-side, so a hub is no large group) and joins of the
    edges with them; a hub's rows are split by AQE's skew join, as one row lies
    on the other side. Each round is written and ends the lineage before it. The
    driver sees two numbers of a round. NULL ends are left out; a node whose only
    edge is to itself is its own component.
    """
    e = edges.select(F.col(a).alias("_u"), F.col(b).alias("_v")).where(F.col("_u").isNotNull() & F.col("_v").isNotNull())
    nodes = materialize(e.select(F.explode(F.array("_u", "_v")).alias(node)).distinct())
    links = materialize(e.where(F.col("_u") != F.col("_v"))
                        .select(F.greatest("_u", "_v").alias("_u"), F.least("_u", "_v").alias("_v")).distinct())
    seen = None
    while True:
        # Large stars: each neighbour above the node goes to the least of the node and its neighbours.
        both = links.unionByName(links.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        least = both.groupBy("_u").agg(F.min("_v").alias("_m")).select("_u", F.least("_u", "_m").alias("_m"))
        large = both.where(F.col("_v") > F.col("_u")).join(least, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).distinct()
        # Small stars: each neighbour below the node, and the node, go to the least of them.
        low = materialize(large)
        least = low.groupBy("_u").agg(F.min("_v").alias("_m"))
        small = low.join(least, "_u").select(F.explode(F.array("_u", "_v")).alias("_u"), F.col("_m").alias("_v"))
        links = materialize(small.where(F.col("_u") != F.col("_v")).distinct())
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("_u", "_v").cast("decimal(20,0)")).alias("s")).first()
        if (state["n"], state["s"]) == seen:
            break
        seen = (state["n"], state["s"])
    return (nodes.join(links, nodes[node] == links["_u"], "left")
            .select(F.col(node), F.coalesce("_v", F.col(node)).alias(root)))


def variant_classes(records: DataFrame, name: str = "name", source: Sequence[str] = ("source", "id")) -> DataFrame:
    """(name, place_id, canonical): one id for all names of a place, over several gazetteers.

    Names are one place when one source record (equal in all ``source``
    columns) carries both, or a chain of records and names leads from one to the
    other. ``place_id`` is the place's smallest source record, its columns joined
    by a line feed's neighbour (unit separator); ``canonical`` the name in most
    records, the smallest of equally common ones. Records without a name or
    with a NULL in ``source`` are left out; repeated records count once.
    """
    r = records.select(F.col(name).cast("string").alias("_name"), F.concat(*[
        c for i, s in enumerate(source) for c in (([F.lit("\x1f")] if i else []) + [F.col(s).cast("string")])]).alias("_rec"))
    r = materialize(r.dropna().distinct())
    # Records sort before names, so the root of a component is its smallest record.
    ends = r.select(F.concat(F.lit("0"), F.col("_rec")).alias("a"), F.concat(F.lit("1"), F.col("_name")).alias("b"))
    parts = connected_components(ends)
    named = parts.where(F.col("node").startswith("1")).select(F.expr("substring(node, 2)").alias("_of"), F.expr("substring(root, 2)").alias("place_id"))
    uses = materialize(r.groupBy("_name").agg(F.count(F.lit(1)).alias("_n")).join(named, F.col("_name") == F.col("_of"))
                       .select(F.col("_name").alias("name"), "place_id", "_n"))
    best = uses.groupBy("place_id").agg(F.min(F.struct((-F.col("_n")).alias("_n"), "name")).alias("_best"))
    return uses.drop("_n").join(best, "place_id").select("name", "place_id", F.col("_best.name").alias("canonical"))
