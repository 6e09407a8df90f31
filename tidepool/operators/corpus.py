"""Citation graphs and corpus comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import materialize


def citation_expand(cites: DataFrame, seeds: DataFrame, citing: str = "citing", cited: str = "cited",
                    seed: str = "work", out: str = "work") -> DataFrame:
    """Seeds, the works they reference, and the works citing them (one hop).

    The edges need not be distinct: they are filtered first, in one pass that
    tells which end of an edge is a seed, and the works are made distinct once.
    """
    s = materialize(seeds.select(F.col(seed).alias("_s")).distinct())
    a, b = s.select(F.col("_s").alias("_a")), s.select(F.col("_s").alias("_b"))
    met = (cites.select(F.col(citing).alias("_from"), F.col(cited).alias("_to"))
           .join(a, F.col("_from") == F.col("_a"), "left").join(b, F.col("_to") == F.col("_b"), "left")
           .where(F.col("_a").isNotNull() | F.col("_b").isNotNull()))
    ends = met.select(F.explode(F.array(F.when(F.col("_a").isNotNull(), F.col("_to")),
                                        F.when(F.col("_b").isNotNull(), F.col("_from")))).alias(out)).where(F.col(out).isNotNull())
    return s.select(F.col("_s").alias(out)).unionByName(ends).distinct()


def citations_received(cites: DataFrame, cited: str = "cited", out: str = "citations") -> DataFrame:
    """Incoming citations per work."""
    return cites.groupBy(F.col(cited).alias("work")).agg(F.count(F.lit(1)).alias(out))


def compare_corpora(a: DataFrame, b: DataFrame, key: str, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Keys in both corpora, only in the first, only in the second.

    Both sides are reduced to distinct keys, tagged, and grouped once (no
    full outer join needed).
    """
    ta = a.select(F.col(key).alias("_k")).distinct().withColumn("_a", F.lit(True)).withColumn("_b", F.lit(False))
    tb = b.select(F.col(key).alias("_k")).distinct().withColumn("_a", F.lit(False)).withColumn("_b", F.lit(True))
    flags = ta.unionByName(tb).groupBy("_k").agg(F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))
    membership = (F.when(F.col("_a") & F.col("_b"), F.lit("both"))
                  .when(F.col("_a"), F.lit(f"{names[0]}_only")).otherwise(F.lit(f"{names[1]}_only")))
    return flags.groupBy(membership.alias("membership")).agg(F.count(F.lit(1)).alias("terms"))


def compare_groups(df: DataFrame, key: str, group: str, a: str, b: str) -> DataFrame:
    """``compare_corpora`` for two groups of one frame (e.g. two languages):
    one grouped pass of per-key presence flags, partially aggregated map-side,
    then the membership counts."""
    d = df.where(F.col(group).isin(a, b))
    flags = d.groupBy(F.col(key).alias("_k")).agg(F.bool_or(F.col(group) == a).alias("_a"),
                                                 F.bool_or(F.col(group) == b).alias("_b"))
    membership = (F.when(F.col("_a") & F.col("_b"), F.lit("both"))
                  .when(F.col("_a"), F.lit(f"{a}_only")).otherwise(F.lit(f"{b}_only")))
    return flags.groupBy(membership.alias("membership")).agg(F.count(F.lit(1)).alias("terms"))


def compare_works(df: DataFrame, key: str, group: str, work: str, a: str, b: str) -> DataFrame:
    """(membership, terms, works): names in both corpora or one only, and the distinct works that hold such a name.

    A work with names of several parts counts in each. Flags per name are one
    combined aggregate; links of (name, work) are made distinct first, without a
    shuffle where ``df`` is dealt by work.
    """
    links = materialize(df.where(F.col(group).isin(a, b)).select(F.col(key).alias("_k"), F.col(group).alias("_g"), F.col(work).alias("_w")).distinct())
    flags = links.groupBy("_k").agg(F.bool_or(F.col("_g") == a).alias("_a"), F.bool_or(F.col("_g") == b).alias("_b"))
    part = (F.when(F.col("_a") & F.col("_b"), F.lit("both")).when(F.col("_a"), F.lit(f"{a}_only")).otherwise(F.lit(f"{b}_only")))
    named = materialize(flags.select("_k", part.alias("membership")))
    terms = named.groupBy("membership").agg(F.count(F.lit(1)).alias("terms"))
    works = (links.join(named, "_k").select("membership", "_w").distinct().groupBy("membership").agg(F.count("_w").alias("works")))
    return terms.join(works, "membership")


# Log2 of a theta sketch's nominal entries: a relative error of 1 / sqrt(2 ** size) for one sketch, of the union for set operations.
SKETCH_SIZE = 14


def sketch_corpora(df: DataFrame, group: str, keys: dict[str, str], size: int = SKETCH_SIZE, snapshot: str | None = None) -> DataFrame:
    """(corpus, snapshot, kind, theta, hll): sketches of the distinct values of each column in ``keys`` (kind to column).

    One for each value of ``group`` (the corpus) and of the column ``snapshot``,
    if there is one. To be written once per snapshot (``write_table``): counts, unions,
    intersections and differences of corpora then come from the sketches, and
    the corpora are not read again. Sketches have a fixed size and are merged
    map-side.
    """
    parts = []
    for kind, column in keys.items():
        taken = F.col(snapshot).cast("string") if snapshot else F.lit(None).cast("string")
        v = df.where(F.col(group).isNotNull() & F.col(column).isNotNull()).groupBy(F.col(group).cast("string").alias("corpus"), taken.alias("snapshot"))
        parts.append(v.agg(F.theta_sketch_agg(F.col(column), size).alias("theta"), F.hll_sketch_agg(F.col(column), size).alias("hll"))
                     .select("corpus", "snapshot", F.lit(kind).alias("kind"), "theta", "hll"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def merge_sketches(sketches: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """The sketches of several snapshots of the same corpora as one per (corpus, kind)."""
    return sketches.groupBy("corpus", "kind").agg(F.theta_union_agg("theta", size).alias("theta"), F.hll_union_agg("hll").alias("hll"))


def compare_sketches(sketches: DataFrame, a: str, b: str, size: int = SKETCH_SIZE) -> DataFrame:
    """(kind, membership, estimate, bound): sizes of both, a only, b only and either, from stored sketches.

    ``bound`` is three standard errors: 3 / sqrt(2 ** size) of the union. A
    corpus without a sketch is empty.
    """
    sides = sketches.where(F.col("corpus").isin(a, b)).groupBy("kind").agg(
        *[F.max(F.when(F.col("corpus") == c, F.col("theta"))).alias(n) for c, n in ((a, "_a"), (b, "_b"))])
    sides = sides.select("kind", F.coalesce("_a", F.theta_difference("_b", "_b")).alias("_a"), F.coalesce("_b", F.theta_difference("_a", "_a")).alias("_b"))
    either = F.theta_sketch_estimate(F.theta_union("_a", "_b", size))
    parts = F.array(*[F.struct(F.lit(n).alias("membership"), e.alias("estimate")) for n, e in (
        ("both", F.theta_sketch_estimate(F.theta_intersection("_a", "_b"))), (f"{a}_only", F.theta_sketch_estimate(F.theta_difference("_a", "_b"))),
        (f"{b}_only", F.theta_sketch_estimate(F.theta_difference("_b", "_a"))), ("either", either))])
    return (sides.select("kind", either.alias("_u"), F.inline(parts))
            .select("kind", "membership", "estimate", (F.col("_u") * 3 / F.sqrt(F.lit(float(2 ** size)))).alias("bound")))
