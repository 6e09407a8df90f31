"""Sources and sinks: CSV missing values, JSON lines, graph documents."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidepool.operators import network as net
from tidepool.sources import io


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidepool-io-", dir="/tmp")


def test_csv_na_policy(spark, scratch):
    path = os.path.join(scratch, "codes.csv")
    with open(path, "w") as f:
        f.write('code,name\nNA,Namibia\n"",Empty\nFR,France\n"NA",Quoted\n')
    schema = "code string, name string"
    keep = io.read_table(spark, path, "csv", schema)
    assert {r.name: r.code for r in keep.collect()}["Namibia"] == "NA"
    ref = io.read_table(spark, path, "csv", schema, na_strings=io.REFERENCE_NA)
    got = {r.name: r.code for r in ref.collect()}
    assert got["Namibia"] is None and got["Quoted"] is None and got["Empty"] is None
    assert got["France"] == "FR"


def test_text_scan_needs_schema(spark):
    with pytest.raises(ValueError):
        io.read_table(spark, "/nonexistent.csv", "csv")


def test_csv_round_trip_writes_na(spark, scratch):
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    out = os.path.join(scratch, "out")
    io.write_table(df, out, "csv", na_string="NA")
    back = io.read_table(spark, out, "csv", "k string, v string", na_strings=io.REFERENCE_NA)
    assert {r.k: r.v for r in back.collect()} == {"a": None, "b": "2"}


def test_delimited_and_json(spark, scratch):
    p = os.path.join(scratch, "c.csv")
    with open(p, "w") as f:
        f.write("code;name_of_state\nFR;France\n")
    d = io.read_table(spark, p, "delim", "code string, name_of_state string", sep=";")
    assert d.first().name_of_state == "France"
    j = os.path.join(scratch, "en")
    os.makedirs(j)
    with open(os.path.join(j, "part-0.json"), "w") as f:
        f.write('{"url": "http://x.org/a", "text": "Sea  water", "extra": 1}\n')
    c = io.read_corpus(spark, os.path.join(j, "*"))
    assert c.columns == ["url", "text"] and c.first().text == "Sea  water"


def test_graph_document_round_trip(spark, scratch):
    edges = spark.createDataFrame([("A", "B", 2), ("A", "C", 1)], "item1 string, item2 string, n long")
    ents = spark.createDataFrame([("A", "FR", 10), ("B", "JP", 5), ("C", "FR", 1)],
                                 "name string, category string, works long")
    nodes = net.graph_nodes(ents, "name", "category", "works", threshold=5)
    links = net.graph_links(edges, nodes)
    cats = net.graph_categories(nodes)
    out = os.path.join(scratch, "graph")
    io.write_graph_document(nodes, links, cats, out)
    n, lk, c = io.read_graph_parts(spark, out)
    assert sorted((r.name, r.category, r.value, r.symbolSize) for r in n.collect()) == [("A", "FR", 10.0, 100.0), ("B", "JP", 5.0, 5.0)]
    assert [(r.source, r.target) for r in lk.collect()] == [("A", "B")]
    assert sorted(r.name for r in c.collect()) == ["FR", "JP"]


def test_graph_document_rejects_missing_part(spark, scratch):
    p = os.path.join(scratch, "bad.json")
    with open(p, "w") as f:
        f.write('{"nodes": [{"name": "A"}], "categories": []}')
    n, _, _ = io.read_graph_document(spark, p)
    with pytest.raises(Exception):
        n.collect()


def test_parquet_partitioned_write(spark, scratch):
    df = spark.createDataFrame([("en", 1), ("de", 2), ("en", 3)], "lang string, v int")
    out = os.path.join(scratch, "by_lang")
    io.write_table(df, out, partition_by=["lang"])
    assert {d for d in os.listdir(out) if d.startswith("lang=")} == {"lang=de", "lang=en"}
    back = io.read_table(spark, out).where("lang = 'en'")
    assert sorted(r.v for r in back.collect()) == [1, 3]


def test_language_partitions_are_pruned(spark, scratch):
    from tidepool.plans.verify import plan_text
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    out = os.path.join(scratch, "docs_by_lang")
    io.write_table(docs, out, partition_by=["lang"])
    en = io.read_table(spark, out).where("lang = 'en'").select("doc_id")
    plan = plan_text(en)
    assert "PartitionFilters: [isnotnull(lang" in plan and "(lang#" in plan and "= en)" in plan
    assert en.count() == docs.where("lang = 'en'").count()


def test_csv_keeps_quotes_line_ends_na_and_empty_texts(spark, scratch):
    rows = [('x "y", z', 3, "NA"), ("two\nlines", None, None), ("", 1, "back\\slash"), (None, 2, '"')]
    df = spark.createDataFrame(rows, "a string, n int, b string")
    out = os.path.join(scratch, "quoted")
    io.write_table(df, out, fmt="csv")
    back = io.read_table(spark, out, "csv", "a string, n int, b string", multi_line=True, na_strings=())
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    with pytest.raises(Exception, match="NA mark"):
        io.write_table(df, os.path.join(scratch, "marked"), fmt="csv", na_string="NA")


def test_csv_header_and_bad_records(spark, scratch):
    path = os.path.join(scratch, "swapped.csv")
    with open(path, "w") as f:
        f.write("b,a\n1,2\n")
    with pytest.raises(Exception):
        io.read_table(spark, path, "csv", "a int, b int").collect()
    path = os.path.join(scratch, "bad.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,x\nno,y\n")
    with pytest.raises(Exception):
        io.read_table(spark, path, "csv", "a int, b string").collect()
    got = io.read_table(spark, path, "csv", "a int, b string", bad_records="bad").collect()
    assert sorted((r["a"] or 0, r["bad"]) for r in got) == [(0, "no,y"), (1, None)]
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as f:
        f.write('{"url": "u", "text": "t"}\n{"url": oops\n')
    got = io.read_table(spark, path, "json", io.CORPUS_SCHEMA, bad_records="bad").collect()
    assert sorted(r["bad"] or "" for r in got) == ["", '{"url": oops']


def test_literal_tables_are_bounded(spark, monkeypatch):
    from tidepool.functions import joins
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_ROWS", 2)
    with pytest.raises(ValueError):
        joins.literal_table(spark, [("a",), ("b",), ("c",)], "x string")
