"""Collaboration networks: pairs, degree, entity tables, graph parts.

All operators are ``DataFrame -> DataFrame``, for use with
``df.transform(partial(op, ...))``. They are lazy but for the tables that
``materialize`` and ``bounded_broadcast`` write while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.joins import bounded_broadcast
from tidepool.functions.scalars import rescale_column, unordered_pair
from tidepool.operators.select import exact_quantile
from tidepool.session import materialize


def cooccurrence(df: DataFrame, item: str, feature: str, *, directed: bool = False,
                 out: Sequence[str] = ("item1", "item2", "n"),
                 hot_items: int | None = None) -> DataFrame:
    """Number of features shared by each pair of items.

    (item, feature) is made distinct first, so an item listed twice on one
    feature counts once; NULL items or features are dropped. Each unordered
    pair is returned once with ``item1 < item2`` (``directed=True`` returns both
    directions, as the pair-counting library does).

    Plan: one shuffle of the distinct (item, feature) rows, reused for both
    sides of an equi self-join on ``feature``; the count is partially
    aggregated before its shuffle. A feature shared by very many items is a
    skewed join key. AQE's skew-join splits such a partition on both sides;
    with ``hot_items`` set, the distinct links are written once, and features
    holding more items than that are also salted explicitly: a hot feature
    with k items gets s = ceil(k / hot_items) buckets, its items are hashed
    into them, and the join key becomes (feature, bucket of item1, bucket of
    item2). Its k*k/2 pairs are then emitted by s*s tasks of about
    ``hot_items`` items a side, each pair in exactly one block. No pair is
    dropped or capped, and the input is read once.
    """
    i1, i2, n = out
    e = links(df, item, feature)
    if hot_items is None:
        pairs = _pair_join(e, e, ["_feat"], i1, i2)
    else:
        e = materialize(e)
        sizes = e.groupBy("_feat").agg(F.count(F.lit(1)).alias("_k"))
        hot = materialize(sizes.where(F.col("_k") > hot_items).select(
            "_feat", F.ceil(F.col("_k") / F.lit(hot_items)).cast("int").alias("_s")))
        if hot.isEmpty():  # nothing to salt: the plain self-join
            pairs = _pair_join(e, e, ["_feat"], i1, i2)
        else:
            cold_e = e.join(hot, "_feat", "left_anti")
            hot_e = e.join(hot, "_feat").withColumn("_b", F.pmod(F.xxhash64("_item"), F.col("_s")).cast("int"))
            buckets = F.sequence(F.lit(0), F.col("_s") - 1)
            left = hot_e.select("_item", "_feat", F.col("_b").alias("_bl"), F.explode(buckets).alias("_br"))
            right = hot_e.select("_item", "_feat", F.explode(buckets).alias("_bl"), F.col("_b").alias("_br"))
            pairs = _pair_join(cold_e, cold_e, ["_feat"], i1, i2).unionByName(
                _pair_join(left, right, ["_feat", "_bl", "_br"], i1, i2))
    pairs = pairs.groupBy(i1, i2).agg(F.count(F.lit(1)).alias(n))
    if directed:
        pairs = pairs.unionByName(pairs.select(F.col(i2).alias(i1), F.col(i1).alias(i2), n))
    return pairs


def _pair_join(left: DataFrame, right: DataFrame, keys: list[str], i1: str, i2: str) -> DataFrame:
    a = left.select(F.col("_item").alias(i1), *keys)
    b = right.select(F.col("_item").alias(i2), *keys)
    return a.join(b, keys).where(F.col(i1) < F.col(i2)).select(i1, i2)


def links(df: DataFrame, item: str, feature: str) -> DataFrame:
    """Distinct non-NULL (item, feature) links as ``(_item, _feat)``.

    Hash-partitioned on both columns, so a hot item or feature is spread
    over tasks while duplicates are removed (partially map-side first).
    """
    return (df.select(F.col(item).alias("_item"), F.col(feature).alias("_feat"))
            .where(F.col("_item").isNotNull() & F.col("_feat").isNotNull())
            .distinct())


def undirected(edges: DataFrame, a: str, b: str, weight: str | None = None) -> DataFrame:
    """Collapse an edge list to one row per unordered pair.

    For foreign edge lists that hold both directions; the pair key is a
    struct (least, greatest), never a joined string. NULL endpoints are
    dropped. With ``weight`` the largest weight of the pair is kept.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = e.withColumn("_p", unordered_pair(a, b))
    aggs = [F.max(weight).alias(weight)] if weight else []
    grouped = e.groupBy("_p").agg(*aggs) if aggs else e.select("_p").distinct()
    return grouped.select(F.col("_p.lo").alias(a), F.col("_p.hi").alias(b),
                          *([weight] if weight else []))


def weighted_degree(edges: DataFrame, src: str, dst: str, weight: str,
                    name: str = "name", out: str = "total_collaborations") -> DataFrame:
    """Sum of edge weights per node over both endpoints (wide -> long, sum)."""
    long = edges.unpivot([weight], [src, dst], "_end", name).drop("_end")
    return long.groupBy(name).agg(F.sum(weight).cast("bigint").alias(out))


def distinct_counts(df: DataFrame, key: str, id_col: str, name: str = "name",
                    out: str = "works", approx_rsd: float | None = None) -> DataFrame:
    """Distinct ``id_col`` per ``key``.

    Exact by default (two-level aggregate, de-duplicated map-side on
    (key, id) first). With ``approx_rsd`` a HyperLogLog++ sketch per key is
    used instead: one shuffle of fixed-size sketches, for web-scale counts
    where a small relative error is acceptable.
    """
    agg = (F.countDistinct(id_col) if approx_rsd is None
           else F.approx_count_distinct(id_col, rsd=approx_rsd))
    return df.groupBy(F.col(key).alias(name)).agg(agg.alias(out))


def entity_table(degree: DataFrame, works: DataFrame, attrs: DataFrame,
                 name: str = "name") -> DataFrame:
    """One row per entity: attributes, total collaborations, distinct works.

    Inner joins: an entity missing from any part is dropped (the reference
    drops rows with missing values after these joins).
    """
    return degree.join(works, name).join(attrs, name)


def rescale(df: DataFrame, col: str, to: tuple[float, float] = (5.0, 100.0),
            out: str = "symbol_size", digits: int | None = None) -> DataFrame:
    """Add ``out`` = ``col`` linearly mapped onto ``to`` (midpoint when flat),
    optionally rounded half-up to ``digits`` places (exactly for integers)."""
    return df.withColumn(out, rescale_column(df, col, to[0], to[1], digits))


def graph_nodes(entities: DataFrame, name: str, category: str, value: str,
                threshold: float | str = "median", to: tuple[float, float] = (5.0, 100.0),
                label_above: float = 16.0, digits: int | None = None) -> DataFrame:
    """Nodes above a size threshold, sized onto ``to``, with a label flag.

    ``threshold`` is a number (keep value >= threshold), ``"median"`` (exact
    median of ``value`` over all entities, by ``exact_quantile``) or
    ``"median_approx"`` (``percentile_approx``, a fixed-size sketch).
    """
    # One row per entity, read by the median, the min/max and the result:
    # written once to the checkpoint folder instead of recomputed three times.
    ents = materialize(entities.select(F.col(name).alias("name"), F.col(category).alias("category"),
                                       F.col(value).alias("value")))
    if threshold == "median":
        cut = F.lit(exact_quantile(ents, "value")).cast("double")
    elif threshold == "median_approx":
        cut = ents.select(F.percentile_approx("value", 0.5, 10000)).scalar()
    else:
        cut = F.lit(threshold)
    kept = ents.where(F.col("value") >= cut)
    sized = rescale(kept, "value", to, "symbol_size", digits)
    return sized.withColumn("show_label", F.col("symbol_size") > F.lit(label_above))


def graph_links(edges: DataFrame, nodes: DataFrame, src: str = "item1", dst: str = "item2",
                node_name: str = "name") -> DataFrame:
    """Edges whose two ends are both kept nodes, as distinct (source, target).

    Degree was computed over all edges before thresholding, so a node's degree
    can exceed its visible edges (kept on purpose). The node set is a semi-join
    filter, broadcast only when its size is checked to be small.
    """
    keep = bounded_broadcast(nodes.select(F.col(node_name).alias("_n")).distinct())
    e = edges.select(F.col(src).alias("source"), F.col(dst).alias("target"))
    e = e.join(keep, e["source"] == keep["_n"], "left_semi")
    e = e.join(keep, e["target"] == keep["_n"], "left_semi")
    return e.distinct()


def graph_categories(nodes: DataFrame, category: str = "category") -> DataFrame:
    """Distinct node categories, as the ``name`` column of the legend."""
    return nodes.select(F.col(category).alias("name")).distinct()


def ego_network(edges: DataFrame, node: str, src: str = "item1", dst: str = "item2",
                weight: str | None = "n") -> DataFrame:
    """Edges touching one node (its one-hop neighbourhood)."""
    cols = [F.col(src).alias("source"), F.col(dst).alias("target")]
    if weight:
        cols.append(F.col(weight))
    return edges.where((F.col(src) == node) | (F.col(dst) == node)).select(*cols)


def ego_pairs(df: DataFrame, item: str, feature: str, node: str) -> DataFrame:
    """``ego_network`` of the co-occurrence graph, straight from the links.

    Only the features of ``node`` are looked at, and their items are counted:
    no pair of two other items is ever formed.
    """
    e = links(df, item, feature)
    own = e.where(F.col("_item") == node).select("_feat")
    near = e.join(own, "_feat", "left_semi").where(F.col("_item") != node)
    return near.groupBy("_item").agg(F.count(F.lit(1)).alias("n")).select(
        F.least("_item", F.lit(node)).alias("source"), F.greatest("_item", F.lit(node)).alias("target"), "n")


def graph_elements(nodes: DataFrame, edges: DataFrame, categories: DataFrame) -> DataFrame:
    """All elements of a graph as rows: kind, name, category, value, symbol_size, source, target."""
    none, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    n = nodes.select(F.lit("node").alias("kind"), F.col("name").cast("string").alias("name"), F.col("category").cast("string").alias("category"),
                     F.col("value").cast("double").alias("value"), F.col("symbol_size").cast("double").alias("symbol_size"),
                     none.alias("source"), none.alias("target"))
    e = edges.select(F.lit("link").alias("kind"), none.alias("name"), none.alias("category"), number.alias("value"),
                     number.alias("symbol_size"), F.col("source").cast("string").alias("source"), F.col("target").cast("string").alias("target"))
    c = categories.select(F.lit("category").alias("kind"), F.col("name").cast("string").alias("name"), none.alias("category"),
                          number.alias("value"), number.alias("symbol_size"), none.alias("source"), none.alias("target"))
    return n.unionByName(e).unionByName(c)
