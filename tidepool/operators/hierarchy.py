"""Hierarchies of places or terms: ancestors, and recounts on every level."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import dealt_by_weight, materialize

# Fixed value: (document, term) rows, ancestors included, that one task makes distinct.
ROWS = 1 << 20


def ancestor_closure(parents: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(node, ancestor): every ancestor of every child, itself left out.

    Paths double in length each round: known paths are joined with the known
    paths from their ends, so a chain of any length takes logarithmically many
    rounds. A child may have several parents. NULL ends and edges to itself are
    left out. A cycle raises ValueError. Each round is written once.
    """
    reach = materialize(parents.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"))
                        .where(F.col("node").isNotNull() & F.col("ancestor").isNotNull() & (F.col("node") != F.col("ancestor"))).distinct())
    n, few = reach.count(), reach.sparkSession.sparkContext.defaultParallelism
    while True:
        on = reach.select(F.col("node").alias("_m"), F.col("ancestor").alias("_a"))
        far = reach.join(on, F.col("ancestor") == F.col("_m")).select("node", F.col("_a").alias("ancestor"))
        # Paths are made distinct in tasks of a bounded size, not where the join makes them.
        reach = materialize(reach.unionByName(far).repartition(max(few, math.ceil(4 * n / ROWS)), "node", "ancestor").distinct())
        count, loops = reach.agg(F.count(F.lit(1)), F.count_if(F.col("node") == F.col("ancestor"))).first()
        if loops:
            raise ValueError("the hierarchy has a cycle")
        if count == n:
            return reach
        n = count


def rollup_counts(hits: DataFrame, closure: DataFrame, term: str = "term", doc: str = "doc_id", out: str = "documents") -> DataFrame:
    """(term, own, ``out``): distinct documents that name a term itself, and that name it or anything below it.

    Hits are made distinct before ancestors multiply them; a document counts
    once on each level however many of a term's descendants it names. A hit
    carries its term's ancestors as one list until a document's hits have met in
    one task, where terms are counted without a shuffle of the multiplied rows.
    """
    own = hits.select(F.col(doc).alias("_d"), F.col(term).alias("_t")).where("_d IS NOT NULL AND _t IS NOT NULL")
    above = closure.where("ancestor IS NOT NULL").groupBy("node").agg(F.collect_set("ancestor").alias("_up"))
    own = dealt_by_weight(own, F.lit(1), ROWS, "_d").distinct()
    met = own.join(above, F.col("_t") == F.col("node"), "left")
    listed = materialize(met.select("_d", F.concat(F.array("_t"), F.coalesce("_up", F.array())).alias("_ts")))
    spread = dealt_by_weight(listed, F.size("_ts"), ROWS, "_d").select("_d", F.posexplode("_ts").alias("_level", "_t"))
    per = spread.groupBy("_d", "_t").agg(F.min("_level").alias("_level"))
    return per.groupBy(F.col("_t").alias(term)).agg(F.count_if(F.col("_level") == 0).alias("own"), F.count(F.lit(1)).alias(out))
