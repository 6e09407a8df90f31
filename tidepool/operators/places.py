"""Places: gazetteer union, polygon centroids, point-in-polygon labels.

Polygons are edge rows ``(poly_id, x1, y1, x2, y2)``; no spatial library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.functions.joins import bounded_broadcast
from tidepool.session import materialize


def compile_places(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """Union gazetteers (columns may differ) and keep one row per place key.

    For each key the row with the most filled columns wins, ties by the
    source order; done as a grouped ``max(struct)``, not a window.
    """
    tagged = []
    for i, s in enumerate(sources):
        tagged.append(s.withColumn("_src", F.lit(-i)))
    u = tagged[0]
    for s in tagged[1:]:
        u = u.unionByName(s, allowMissingColumns=True)
    rest = [c for c in u.columns if c not in (key, "_src")]
    filled = sum((F.col(c).isNotNull().cast("int") for c in rest), F.lit(0))
    best = F.max(F.struct(filled.alias("_f"), F.col("_src"), *[F.col(c) for c in rest])).alias("_b")
    return u.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in rest])


def centroid(edges: DataFrame, poly: str = "poly_id") -> DataFrame:
    """Area and centroid of each place from its edges.

    Closed rings with an area: area-weighted (shoelace sums). Lines, that is
    edges whose ends do not meet again, and flat rings: length-weighted, area
    0. Points (edges of length 0): the plain mean.
    """
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    # A ring's edges begin and end at the same places: a sum over hashes of the places tells.
    open_ = F.sum(F.xxhash64("x1", "y1").cast("decimal(20,0)") - F.xxhash64("x2", "y2").cast("decimal(20,0)")) != 0
    sums = edges.groupBy(poly).agg(
        F.sum(cross).alias("_c"), F.sum(length).alias("_l"), F.count(F.lit(1)).alias("_n"), open_.alias("_open"),
        *[F.sum((F.col(f"{a}1") + F.col(f"{a}2")) * w).alias(f"_{a}{k}")
          for a in "xy" for k, w in (("c", cross), ("l", length), ("n", F.lit(1.0)))])
    flat = F.col("_open") | (F.round(F.col("_c") / 2, 6) == 0)

    def mean(a: str):
        line = F.when(F.col("_l") > 0, F.try_divide(f"_{a}l", 2 * F.col("_l"))).otherwise(F.col(f"_{a}n") / (2 * F.col("_n")))
        return F.when(flat, line).otherwise(F.try_divide(f"_{a}c", 3 * F.col("_c")))

    return sums.select(poly, F.when(flat, F.lit(0.0)).otherwise(F.round(F.col("_c") / 2, 6)).alias("area"),
                       F.round(mean("x"), 6).alias("cx"), F.round(mean("y"), 6).alias("cy"))


# Where in a cell its reference point lies: off any round number, so that no given edge passes through it.
REFERENCE = 0.41421356237309515


def _span(lo, hi):
    """The whole numbers from ``lo`` to ``hi``; none where ``lo`` is above."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def classify_points(points: DataFrame, edges: DataFrame, point_id: str = "vec_id", x: str = "x",
                    y: str = "y", poly: str = "poly_id", band: float = 0.1,
                    inside_label: str = "EEZ", outside_label: str = "ABNJ",
                    block: int = 16, most_edges: int = 64) -> DataFrame:
    """Label each point inside/outside the polygons (closed rings of edges) by a grid of cells and ray casting.

    A ray from the point towards +x crosses an edge when the edge spans the
    point's y and meets the ray right of the point; an odd count for some
    polygon means inside.

    The plane is cut into cells of width and height ``band``, on two levels:

    * boundary cells: those that an edge passes through. A ray along the
      middle of each row of cells tells whether the reference point of a
      boundary cell lies inside, and whether the uncrossed cells between two
      boundary cells do;
    * inside cells: uncrossed cells within some polygon, kept as blocks of
      ``block`` cells of a row where a whole block is inside, as cells else.

    A point in an inside cell is inside, whatever the other polygons. Points
    elsewhere meet only the edges in their own cell: the crossings on the way
    from the point to the cell's reference point, along the row and then the
    column, are added to what is known of that. Rows of the index hold at most
    ``most_edges`` edges of one polygon in one cell; a polygon with more there
    has more rows, whose crossings are added up. The index of edges is built for
    cells with undecided points alone. Equal points are decided once and stay
    rows of their own; points without coordinates are outside.
    """
    h = float(band)
    cell = lambda v: F.floor(v / h).cast("bigint")
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    e = edges.select(F.col(poly).alias("_p"), *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).dropna()
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    e = e.repartition(F.col("_p"), cell(low))  # an edge becomes many rows: by many tasks, also where few read the edges
    pad = F.lit(1e-9) * (F.abs(x1) + F.abs(x2) + F.abs(y1) + F.abs(y2) + 1)
    rows = e.withColumn("_pad", pad).withColumn("_r", F.explode(F.sequence(cell(low - F.col("_pad")), cell(high + F.col("_pad")))))
    x_at = lambda v: F.try_divide((x2 - x1) * (v - y1), y2 - y1) + x1
    ends = [x_at(F.greatest(low, F.col("_r") * h)), x_at(F.least(high, (F.col("_r") + 1) * h))]
    left, right = F.least(x1, x2), F.greatest(x1, x2)
    cells = rows.withColumn("_c", F.explode(F.sequence(
        cell(F.coalesce(F.greatest(left, F.least(right, *ends)), left) - F.col("_pad")),
        cell(F.coalesce(F.least(right, F.greatest(left, *ends)), right) + F.col("_pad"))))).drop("_pad")

    # Along the middle of each row: crossings by cell, and those right of the cell's reference point.
    middle = (F.col("_r") + REFERENCE) * h
    met = rows.where((y1 > middle) != (y2 > middle)).withColumn("_x", x_at(middle)).withColumn("_c", cell(F.col("_x")))
    marks = cells.select("_p", "_r", "_c", F.lit(0).alias("_n"), F.lit(0).alias("_m")).unionByName(
        met.select("_p", "_r", "_c", F.lit(1).alias("_n"), (F.col("_x") > (F.col("_c") + REFERENCE) * h).cast("int").alias("_m")))
    line = W.partitionBy("_p", "_r").orderBy(F.desc("_c"))
    beyond = F.coalesce(F.sum("_n").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    grid = materialize(marks.groupBy("_p", "_r", "_c").agg(F.sum("_n").alias("_n"), F.sum("_m").alias("_m"))
                       .select("_p", "_r", "_c", F.lag("_c").over(line).alias("_next"), beyond.alias("_beyond"),
                               ((beyond + F.col("_m")) % 2).cast("int").alias("_odd")))

    gap = grid.where((F.col("_next") - F.col("_c") > 1) & (F.col("_beyond") % 2 == 1)).select(
        "_r", (F.col("_c") + 1).alias("_a"), (F.col("_next") - 1).alias("_z"))
    gap = gap.withColumns({"_ba": F.ceil(F.col("_a") / block).cast("bigint"), "_bz": (F.floor((F.col("_z") + 1) / block) - 1).cast("bigint")})
    whole = F.col("_ba") <= F.col("_bz")
    single = F.when(whole, F.concat(_span(F.col("_a"), F.col("_ba") * block - 1), _span((F.col("_bz") + 1) * block, F.col("_z")))) \
        .otherwise(_span(F.col("_a"), F.col("_z")))
    inner = gap.select("_r", F.explode(F.concat(
        F.transform(_span(F.col("_ba"), F.col("_bz")), lambda c: F.struct(F.lit(True).alias("_block"), c.alias("_at"))),
        F.transform(single, lambda c: F.struct(F.lit(False).alias("_block"), c.alias("_at"))))).alias("_k"))
    inner = bounded_broadcast(inner.select(F.col("_r").alias("_kr"), "_k._block", "_k._at").distinct())

    spots = points.select(F.col(x).alias("_x"), F.col(y).alias("_y")).dropna().distinct()
    spots = spots.withColumns({"_r": cell(F.col("_y")), "_c": cell(F.col("_x"))})
    one, many = inner.where("NOT _block"), inner.where("_block")
    hit = [one.select(F.col("_kr").alias("_r"), F.col("_at").alias("_c"), F.lit(True).alias("_one")),
           many.select(F.col("_kr").alias("_r"), F.col("_at").alias("_b"), F.lit(True).alias("_many"))]
    known = materialize(spots.withColumn("_b", F.floor(F.col("_c") / block).cast("bigint"))
                        .join(hit[0], ["_r", "_c"], "left").join(hit[1], ["_r", "_b"], "left")
                        .select("_x", "_y", "_r", "_c", (F.col("_one").isNotNull() | F.col("_many").isNotNull()).alias("_in")))
    open_ = known.where("NOT _in").drop("_in")

    near = cells.join(bounded_broadcast(open_.select("_r", "_c").distinct()), ["_r", "_c"], "left_semi")
    place = F.row_number().over(W.partitionBy("_p", "_r", "_c").orderBy("x1", "y1", "x2", "y2")) - 1
    packs = (near.withColumn("_pack", F.floor(place / most_edges)).groupBy("_p", "_r", "_c", "_pack")
             .agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_edges"))
             .join(grid.select("_p", "_r", "_c", "_odd"), ["_p", "_r", "_c"])
             .withColumn("_odd", F.when(F.col("_pack") == 0, F.col("_odd")).otherwise(0)))
    rx, ry = (F.col("_c") + REFERENCE) * h, middle

    def crosses(s):
        at_x = (s["x2"] - s["x1"]) * (F.col("_y") - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"]
        at_y = (s["y2"] - s["y1"]) * (rx - s["x1"]) / (s["x2"] - s["x1"]) + s["y1"]
        along = F.when((s["y1"] > F.col("_y")) != (s["y2"] > F.col("_y")), ((F.col("_x") < at_x) != (rx < at_x)).cast("int")).otherwise(0)
        up = F.when((s["x1"] > rx) != (s["x2"] > rx), ((F.col("_y") < at_y) != (ry < at_y)).cast("int")).otherwise(0)
        return along + up

    cast = open_.join(packs, ["_r", "_c"]).select("_x", "_y", "_p", (F.col("_odd") + F.aggregate(
        "_edges", F.lit(0), lambda acc, s: acc + crosses(s))).alias("_n"))
    found = cast.groupBy("_x", "_y", "_p").agg(F.sum("_n").alias("_n")).where("_n % 2 = 1").select("_x", "_y").distinct()
    spots_in = bounded_broadcast(known.where("_in").select("_x", "_y").unionByName(found).withColumn("_in", F.lit(True)))
    j = points.join(spots_in, (F.col(x) == F.col("_x")) & (F.col(y) == F.col("_y")), "left")
    inside = j.select(point_id, x, y, F.coalesce("_in", F.lit(False)).alias("inside"))
    return inside.withColumn("place", F.when(F.col("inside"), F.lit(inside_label))
                             .otherwise(F.lit(outside_label)))
