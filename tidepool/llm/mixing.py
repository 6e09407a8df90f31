"""Mixing sources to target weights by Pareto order sampling.

Native DataFrame functions only. Each source gets a target in words. Whole
copies that its target certainly holds go to every document; of the rest, an
unequal-probability sample of fixed size in words is drawn: documents are
ranked by random odds divided by inclusion odds, and taken in rank order while
they fit in the words left; while the rest of these is over ``slack`` of the
target, it goes to the document, below its most copies, whose size is nearest.
Inclusion probabilities grow with size ** size_power and add up to the words
left; documents whose probability reaches 1 are certain, too.

Only the table of sizes is used after the texts are counted. Ranks come from
running sums in (source, log-odds bin) groups and a sum over the bins, so a
source with a third of all rows is spread over its bins.

Defined results: a NULL or empty text has size 0 and none of it is taken; a
NULL source is a source of its own, the last; repeated rows are documents of
their own; an empty table gives no rows; only the named columns are used.
Random numbers are hashes of the id, the size and ``seed``, and sums are sums
of integers and decimals, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm.common import numbered, words, written

#: Bins per unit of log odds; random log odds spread over some 20 units, so no bin has over 0.5 % of a source.
BINS = 64


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, target) of a table (source, size).

    Sources in code point order, NULL last, have ``weights`` in turn. They
    share the total by weight; targets stop at ``most`` times the source's
    size, and what is above is shared by weight among the others again.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    by = written(numbered(by, F.col("source").asc_nulls_last()).select("source", "source_size", order.alias("weight")), "mix-sources")
    cap = most * F.col("source_size")
    total, level = by.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:  # the level only rises, and with it the sources at their cap
        full = cap < level * F.col("weight")
        capped, open_ = by.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_ or (total - capped) / open_ <= level:
            break
        level = (total - capped) / open_
    return by.select("source", "source_size", F.least(cap, level * F.col("weight")).alias("target"))


def _inclusion(docs: DataFrame, targets: DataFrame, power: float) -> DataFrame:
    """``targets`` with ``whole`` copies, words ``left`` and the factor of the inclusion probabilities."""
    per = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    per = per.withColumn("left", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))).withColumn("factor", F.lit(0.0))
    while True:  # as above: the factor rises until no further document becomes certain
        gain = F.pow(F.col("size"), power)
        sure = F.col("factor") * gain >= 1
        sums = docs.join(per, docs["source"].eqNullSafe(per["source"])).groupBy(per["source"]).agg(
            F.coalesce(F.sum(F.when(sure, F.col("size"))), F.lit(0)).alias("sure"),
            F.coalesce(F.sum(F.when(~sure, (gain * F.col("size")).cast("decimal(28,3)"))).cast("double"), F.lit(0.0)).alias("open"))
        at = per.alias("p").join(sums.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")), "left")
        # A certain document that alone exceeds the words left leaves nothing for the others.
        to = F.when(F.col("open") > 0, F.greatest(F.lit(0.0), F.col("left") - F.col("sure")) / F.col("open")).otherwise(F.col("factor"))
        per = written(at.select("p.source", "source_size", "target", "whole", "left", F.greatest(F.col("factor"), to).alias("factor"),
                                (to > F.col("factor") * (1 + 1e-9)).alias("moved")), "mix-inclusion")
        if not per.filter("moved").limit(1).count():
            return per.drop("moved")


def pareto_mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, size_power: float = 0.5, slack: float = 0.001, seed: int = 0) -> DataFrame:
    """One row per row of ``df``: id, size, source, source_size, target, copies and ``taken`` words."""
    docs = written(df.select(F.col(id_col).alias("id"), F.col(source).alias("source"),
                             F.size(words(F.col(text))).cast("long").alias("size"),
                             F.monotonically_increasing_id().alias("row")), "mix-sizes")
    per = _inclusion(docs, source_targets(docs, weights, most), size_power)
    p = F.least(F.lit(1.0), F.col("factor") * F.pow(F.col("size"), size_power))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "size"), 11) + 0.5) / float(2**53)
    rank = F.when(p >= 1, F.lit(-1e9)).when(p > 0, F.log(u / (1 - u)) - F.log(p / (1 - p)))
    drawn = docs.join(per.withColumnRenamed("source", "of"), docs["source"].eqNullSafe(F.col("of"))).drop("of")
    drawn = drawn.withColumns({"p": p, "rank": rank}).withColumn("bin", F.greatest(F.lit(-10**6), F.floor(F.col("rank") * BINS)).cast("int"))
    drawn = drawn.withColumn("part", F.when(F.col("bin") == -10**6, F.pmod(F.xxhash64("id"), F.lit(1024))).otherwise(0).cast("int"))

    # Running sums: within a bin, and over the bins of a source.
    bins = drawn.filter(F.col("rank").isNotNull()).groupBy("source", "bin", "part").agg(F.sum("size").alias("words"))
    over = W.partitionBy("source").orderBy("bin", "part").rowsBetween(W.unboundedPreceding, -1)
    before = bins.select(F.col("source").alias("s"), F.col("bin").alias("b"), F.col("part").alias("q"),
                         F.coalesce(F.sum("words").over(over), F.lit(0)).alias("before"))
    within = W.partitionBy("source", "bin", "part").orderBy("rank", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    drawn = drawn.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    drawn = drawn.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")) & (F.col("part") == F.col("q")), "left")
    fits = F.coalesce((F.col("before") + F.col("ahead") + F.col("size") <= F.col("left")) & (F.col("size") > 0), F.lit(False))
    copies = (F.col("whole") + fits.cast("int")).cast("long")
    drawn = written(drawn.select("id", "source", "size", "row", "source_size", "target", "rank", copies.alias("copies")), "mix-drawn")
    while picked := _nearest(drawn, most, slack):
        more = drawn.join(picked, "row", "left")
        drawn = written(more.withColumn("copies", F.col("copies") + F.coalesce("extra", F.lit(0))).drop("extra"), "mix-drawn")
    return drawn.select(F.col("id").alias(id_col), "size", F.col("source").alias(source), "source_size", "target",
                        "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _nearest(drawn: DataFrame, most: float, slack: float) -> DataFrame | None:
    """(row, extra): in each source that is short of its target by over ``slack`` of it, the document whose further copy comes nearest."""
    rest = drawn.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("rest"), F.first("target").alias("goal"))
    rest = rest.filter(F.col("rest") > slack * F.col("goal")).withColumnRenamed("source", "of")
    off = F.abs(F.col("size") - F.col("rest"))
    above = F.col("size") > F.col("rest") + slack * F.col("goal")  # only where no document fits
    picked = written(drawn.filter((F.col("copies") + 1 <= most) & (F.col("size") > 0)).join(rest, F.col("source").eqNullSafe(F.col("of")))
                     .filter(off < F.col("rest")).groupBy("of").agg(F.min(F.struct(above, off, "copies", "rank", "id", "row"))["row"].alias("row"))
                     .select("row", F.lit(1).alias("extra")), "mix-nearest")
    return picked if picked.limit(1).count() else None
