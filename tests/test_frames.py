"""Frame helpers and gazetteer union."""

import pytest

from tidepool.operators import frames
from tidepool.operators.places import compile_places


def test_relocate_positions_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, Total int")
    assert frames.relocate(df, ["Total"]).columns == ["Total", "a", "b"]
    assert frames.select_positions(df, 2).columns == ["a", "b"]
    assert frames.rename_all(df, ["x", "y", "z"]).columns == ["x", "y", "z"]
    with pytest.raises(ValueError):
        frames.rename_all(df, ["1", "2", "3", "4", "5", "6"][:4])


def test_separate(spark):
    df = spark.createDataFrame([("http://a.org/x_sentid_3",), ("no-sep",), ("a_sentid_1_sentid_2",)], "s string")
    out = frames.separate(df, "s", ["url", "sentno"], "_sentid_").collect()
    assert [(r.url, r.sentno) for r in out] == [("http://a.org/x", "3"), ("no-sep", None), ("a", "1")]
    assert "s" in frames.separate(df, "s", ["u", "n"], "_sentid_", remove=False).columns


def test_missing_values(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    assert frames.drop_missing(df).count() == 1
    assert frames.drop_missing(df, ["a"]).count() == 2
    assert [r.b for r in frames.fill_missing(df, {"b": " "}).collect()] == [" ", "x", "y"]
    assert frames.numeric_columns(df) == ["a"]


def test_compile_places_prefers_fuller_rows(spark):
    a = spark.createDataFrame([(1, "Atlantic", None), (2, "Pacific", 5.0)], "place_id int, name string, lat double")
    b = spark.createDataFrame([(1, "Atlantic Ocean", 10.0), (3, "Arctic", 80.0)],
                              "place_id int, name string, lat double")
    got = {r.place_id: (r.name, r.lat) for r in compile_places([a, b], "place_id").collect()}
    assert got == {1: ("Atlantic Ocean", 10.0), 2: ("Pacific", 5.0), 3: ("Arctic", 80.0)}
    twice = compile_places([a, a], "place_id")
    assert sorted(twice.collect()) == sorted(compile_places([a], "place_id").collect())


def test_compare_groups_equals_compare_corpora(spark):
    from tidepool.operators.corpus import compare_corpora, compare_groups
    df = spark.createDataFrame([("en", "sea"), ("en", "reef"), ("de", "sea"), ("de", "meer"), ("fr", "mer"),
                                ("en", "sea")], "lang string, w string")
    a = {tuple(r) for r in compare_groups(df, "w", "lang", "en", "de").collect()}
    b = {tuple(r) for r in compare_corpora(df.where("lang = 'en'"), df.where("lang = 'de'"), "w",
                                           names=("en", "de")).collect()}
    assert a == b == {("both", 1), ("en_only", 1), ("de_only", 1)}
