"""End-to-end collaboration-network build (the reference's data-prep job).

links -> disambiguated names -> pair table -> degree, works -> entity table
-> thresholded nodes, links, categories -> graph document + CSV report.

The two intermediates read more than once (the pair table and the entity
table) are written under ``out_dir`` and read back, so later steps start from
files on shared storage instead of re-running the lineage, and a lost
executor cannot lose them.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators import network as net
from tidepool.operators.clean import disambiguate_names
from tidepool.sources import io


def build_network(links: DataFrame, out_dir: str, item: str = "display_name", feature: str = "id",
                  category: str = "country_code", threshold: float | str = "median",
                  size_range: tuple[float, float] = (5.0, 100.0),
                  hot_items: int | None = 5_000) -> dict[str, str]:
    """Build every network output from a (work, entity, category) link table."""
    spark = links.sparkSession
    out = out_dir.rstrip("/")
    paths = {k: f"{out}/{k}" for k in ("pairs", "entities", "graph", "table")}

    named = disambiguate_names(links.select(item, feature, category), item, category)
    io.write_table(net.cooccurrence(named, item, feature, hot_items=hot_items), paths["pairs"])
    pairs = spark.read.parquet(paths["pairs"])

    degree = net.weighted_degree(pairs, "item1", "item2", "n")
    works = net.distinct_counts(named, item, feature, "name", "works")
    # One category per (disambiguated) name; grouped by name so the three
    # name-keyed tables share one partitioning and join without a shuffle.
    attrs = named.groupBy(F.col(item).alias("name")).agg(F.min(category).alias("category"))
    io.write_table(net.entity_table(degree, works, attrs), paths["entities"])
    entities = spark.read.parquet(paths["entities"])

    nodes = net.graph_nodes(entities, "name", "category", "works", threshold=threshold, to=size_range)
    io.write_graph_document(nodes, net.graph_links(pairs, nodes), net.graph_categories(nodes),
                            paths["graph"])
    report = entities.select(F.col("name").alias("Institution"), F.col("category").alias("Country"),
                             F.col("total_collaborations").alias("Total Collaborations"),
                             F.col("works").alias("Total Publications"))
    io.write_table(report.orderBy(F.desc("Total Publications"), "Institution"), paths["table"], fmt="csv")
    return paths


def main() -> None:
    ap = argparse.ArgumentParser(description="Build the institution network from the test tables.")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", required=True, help="output folder on shared storage")
    args = ap.parse_args()
    from tidepool.plans import fixtures as fx
    from tidepool.session import get_session
    spark = get_session("tidepool-network")
    paths = build_network(fx.authorships(fx.Tables(spark, args.sf_dir)), args.out)
    print(json.dumps(paths))
    spark.stop()


if __name__ == "__main__":
    main()
