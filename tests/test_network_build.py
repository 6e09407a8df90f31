"""The end-to-end network job writes the same nodes and links as the analogs."""

import os
import tempfile

from tidepool.plans import fixtures as fx
from tidepool.plans.analogs import QUERIES
from tidepool.plans.network_build import build_network
from tidepool.sources import io

from .conftest import SF_SMALL


def test_build_network_outputs(spark):
    out = tempfile.mkdtemp(prefix="tidepool-net-", dir="/tmp")
    paths = build_network(fx.authorships(fx.Tables(spark, SF_SMALL)), out)
    nodes, links, cats = io.read_graph_parts(spark, paths["graph"])
    want_nodes = {r.name for r in QUERIES["a11_graph_nodes"](spark, SF_SMALL).collect()}
    want_links = {(r.source, r.target) for r in QUERIES["a12_graph_links"](spark, SF_SMALL).collect()}
    assert {r.name for r in nodes.collect()} == want_nodes
    assert {(r.source, r.target) for r in links.collect()} == want_links
    assert cats.count() == QUERIES["a13_graph_categories"](spark, SF_SMALL).count()
    table = io.read_table(spark, paths["table"], "csv",
                          "Institution string, Country string, `Total Collaborations` long, "
                          "`Total Publications` long")
    assert table.count() == QUERIES["a09_entity_table"](spark, SF_SMALL).count()
    assert os.path.isdir(paths["pairs"]) and os.path.isdir(paths["entities"])
