"""The name machine, reporting lags, file order, inferred types."""

import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepool.operators import lags, names, taxa
from tidepool.operators.clean import fill_down
from tidepool.sources import infer, io, order

PARTS = ("kind", "hybrid", "genus", "subgenus", "epithet", "rank", "infra", "qualifier", "authority", "year", "moved")
# Each state and each way on from it.
NAMES = {
    "Orcinus": ("uninomial", False, "Orcinus", None, None, None, None, None, None, None, False),
    "Orcinus Fitzinger, 1860": ("uninomial", False, "Orcinus", None, None, None, None, None, "Fitzinger", "1860", False),
    "Orcinus orca": ("binomial", False, "Orcinus", None, "orca", None, None, None, None, None, False),
    "Orcinus orca (Linnaeus, 1758)": ("binomial", False, "Orcinus", None, "orca", None, None, None, "Linnaeus", "1758", True),
    "Gadus morhua Linnaeus, 1758": ("binomial", False, "Gadus", None, "morhua", None, None, None, "Linnaeus", "1758", False),
    "Conus (Gastridium) geographus L.": ("binomial", False, "Conus", "Gastridium", "geographus", None, None, None, "L.", None, False),
    "Salmo trutta fario": ("trinomial", False, "Salmo", None, "trutta", None, "fario", None, None, None, False),
    "Fucus vesiculosus var. linearis Kjellman": ("trinomial", False, "Fucus", None, "vesiculosus", "var.", "linearis", None, "Kjellman", None, False),
    "Poa annua subsp. varia f. minor": ("trinomial", False, "Poa", None, "annua", "f.", "minor", None, None, None, False),
    "Thunnus sp.": ("open", False, "Thunnus", None, None, None, None, "sp.", None, None, False),
    "Thunnus cf. albacares Bonnaterre": ("open", False, "Thunnus", None, "albacares", None, None, "cf.", "Bonnaterre", None, False),
    "Thunnus albacares aff. major": ("open", False, "Thunnus", None, "albacares", None, "major", "aff.", None, None, False),
    "×Spartina townsendii": ("binomial", True, "Spartina", None, "townsendii", None, None, None, None, None, False),
    "Spartina × townsendii H.Groves": ("binomial", True, "Spartina", None, "townsendii", None, None, None, "H.Groves", None, False),
    "Salmo salar × trutta": ("trinomial", True, "Salmo", None, "salar", "×", "trutta", None, None, None, False),
    "Aplysia punctata de Blainville 1823": ("binomial", False, "Aplysia", None, "punctata", None, None, None, "de Blainville", "1823", False),
    "  Mola\tmola  ": ("binomial", False, "Mola", None, "mola", None, None, None, None, None, False),
    "Éponge élégante": ("binomial", False, "Éponge", None, "élégante", None, None, None, None, None, False),
    "orca": None, "": None, "123": None, "Fucus vesiculosus var.": None, "Gadus morhua var. 12": None, "Gadus morhua 1758 extra": None, None: None,
}


def test_every_state_of_the_name_machine(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = {r["name"]: tuple(r["parsed"][p] for p in PARTS) for r in names.parse_names(df, "name").collect()}
    for n, want in NAMES.items():
        assert got[n] == (want or (None,) * len(PARTS)), n


# ---- lags -----------------------------------------------------------------------

def plain_completeness(cells, last):
    cells = {(p, j): n for (p, j), n in cells.items() if p + j <= last}
    longest, out = max(j for _, j in cells), {}
    for p in {p for p, _ in cells}:
        done = 1.0
        for j in range(min(longest, last - p) + 1, longest + 1):
            among = sum(n for (q, i), n in cells.items() if i <= j and q + j <= last)
            if among:
                done *= 1 - sum(n for (q, i), n in cells.items() if i == j and q + j <= last) / among
        n = sum(v for (q, _), v in cells.items() if q == p)
        out[p] = (n, round(done, 6), round(n / done, 6) if done else None)
    return out


@pytest.mark.parametrize("last", [None, 12, 9])
def test_completeness_matches_the_formula(spark, last):
    cells = {(p, j): 5 + (p * 7 + j * 11) % 13 for p in range(10) for j in range(5) if (p, j) != (3, 2)}
    df = spark.createDataFrame([(p, j, n) for (p, j), n in cells.items()], "period int, lag int, n long")
    got = {r.period: (r.n, r.completeness, r.estimated) for r in lags.completeness(df, last).collect()}
    want = plain_completeness(cells, max(p + j for p, j in cells) if last is None else last)
    assert got.keys() == want.keys()
    for p in want:
        assert got[p] == pytest.approx(want[p], abs=2e-6), p


def test_late_periods_are_flagged_and_their_totals_found(spark):
    # 1,000 records each month; a tenth is reported in each of the next ten months; seen up to month 30.
    cells = [(p, j, 100) for p in range(31) for j in range(10) if p + j <= 30]
    rows = {r.period: r for r in lags.completeness(spark.createDataFrame(cells, "period int, lag int, n long")).collect()}
    assert all(r.estimated == pytest.approx(1000) for r in rows.values())
    assert [p for p, r in rows.items() if not r.complete and p < 22] == [] and all(not rows[p].complete for p in range(22, 31))


def test_lags_are_counted_by_whole_periods(spark):
    d = dt.datetime
    df = spark.createDataFrame([(d(2020, 1, 31), d(2020, 2, 1)), (d(2020, 1, 1), d(2020, 1, 31)), (d(2019, 12, 31), d(2020, 1, 1)),
                                (d(2020, 5, 1), d(2020, 4, 1)), (None, d(2020, 1, 1)), (d(2020, 1, 1), None)], "e timestamp_ntz, r timestamp_ntz")
    assert {tuple(x) for x in lags.lag_counts(df, "e", "r", months=1).collect()} == {(24240, 1, 1), (24240, 0, 1), (24239, 1, 1)}
    assert {tuple(x) for x in lags.lag_counts(df, "e", "r").collect()} == {(2020, 0, 2), (2019, 1, 1)}
    assert lags.completeness(lags.lag_counts(df.limit(0), "e", "r")).count() == 0


def test_rank_habitats(spark):
    rows = [("a", "Species", True, False, None, False), ("a", "Species", True, False, False, False), ("b", "Species", True, True, False, False),
            ("c", "Genus", False, False, True, True)]
    df = spark.createDataFrame(rows, "taxon string, rank string, marine boolean, brackish boolean, freshwater boolean, terrestrial boolean")
    got = {r["rank"]: tuple(r)[1:] for r in taxa.rank_habitats(df).collect()}
    assert got == {"Species": (2, 2, 1, 0, 0, 1), "Genus": (1, 0, 0, 1, 1, 0)}


# ---- file order ------------------------------------------------------------------

@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lines_are_numbered_as_in_the_files(spark, tmp_path, small_blocks):
    want = []
    for f in ("b.txt", "a.txt", "c d.txt"):
        lines = [f"{f} line {i} " + "x" * (i * 37 % 90) for i in range(400)] + ["", f"{f} last"]
        (tmp_path / f).write_text("\n".join(lines) + ("\n" if f == "a.txt" else ""))
    for f in ("a.txt", "b.txt", "c d.txt"):
        want += (tmp_path / f).read_text().removesuffix("\n").split("\n")
    rows = order.read_in_order(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() > 20
    assert [(r.row_no, r.value) for r in rows.orderBy("row_no").collect()] == list(enumerate(want))


def test_fill_down_in_file_order(spark, tmp_path, small_blocks):
    rows = [(i, f"who {i}" if i % 97 == 0 else None, "text, with \"signs\"") for i in range(900)]
    (tmp_path / "x.csv").write_text("id,applicant,note\n" + "\n".join(
        f'{i},{a or ""},"{n.replace(chr(34), chr(34) * 2)}"' for i, a, n in rows) + "\n")
    got = order.read_in_order(spark, str(tmp_path / "x.csv"), "csv", "id int, applicant string, note string")
    assert got.rdd.getNumPartitions() > 3
    filled = fill_down(got.withColumn("g", F.lit(0)), "applicant", "g", "row_no", chunk=64)
    assert [(r.row_no, r.id, r.applicant, r.note) for r in filled.orderBy("row_no").collect()] == [
        (i, i, f"who {i - i % 97}", n) for i, _, n in rows]


def test_order_of_an_empty_file(spark, tmp_path):
    (tmp_path / "e.txt").write_text("")
    assert order.read_in_order(spark, str(tmp_path)).count() == 0


# ---- inferred types ---------------------------------------------------------------

@pytest.mark.parametrize("cells,want", [
    (["1", "-20", "+3", ""], "bigint"), (["1", "2.5"], "double"), (["1e5", ".5", "NaN"], "double"), (["007", "1"], "string"),
    (["TRUE", "false"], "boolean"), (["T", "1"], "string"), (["2020-02-29"], "date"), (["2020-02-30"], "string"),
    (["2020-01-01", "2020-01-01 10:00:00"], "timestamp_ntz"), (["2020-01-01T10:00:00Z"], "timestamp"), (["2020-01-01T10:00:00Z", "2020-01-01"], "string"),
    (["", ""], "string"), (["x", "1"], "string"), (["12345678901234567890"], "double"), (["1", "x\ny"], "string")])
def test_a_column_has_the_least_type_of_its_cells(spark, cells, want):
    df = spark.createDataFrame([(c or None,) for c in cells], "v string").repartition(2)
    assert infer.infer_types(df)["v"].dataType.simpleString() == want


def test_cheap_tests_before_the_looks_change_no_kind(spark):
    """Each cell's kind is the first look it fits, in the order of ``LOOKS``."""
    cells = ["", " ", "1", "-1", "+", "1\n", "-", "--1", "123e-5", "123e-45", "1.2e-3-4", "0.0000-00-1", ".", ".5", "Infinity", "-Infinity", "+NaN", "NaN", "I", "T", "True\n", "Fx",
             "2020-02-29", "2021-02-29", "2020-02-29\n", "2020-1-01", "2020-02-29T10:00", "2020-02-29 25:00", "2020-02-29 10:00:00.5+01:00", "2020-02-29x", "٣", "é020-02-29", "-020-02-29", "0x1", None]

    def first_look(c):
        kind = F.when(c.isNull(), 0)
        for bit, look in infer.LOOKS:
            ok = c.rlike(look)
            if bit in (infer.DATE, infer.TIME, infer.ZONED):
                ok = ok & F.try_to_timestamp(c if bit != infer.DATE else F.concat(c, F.lit(" 00:00:00"))).isNotNull()
            kind = kind.when(ok, bit)
        return kind.otherwise(infer.TEXT)

    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = df.select("c", infer.cell_kind(F.col("c")).alias("got"), first_look(F.col("c")).alias("want")).collect()
    assert [(r.c, r.got) for r in got] == [(r.c, r.want) for r in got]


def test_cells_of_all_columns_are_judged_by_one_piece_of_code(spark, monkeypatch):
    calls, kind = [], infer.cell_kind
    monkeypatch.setattr(infer, "cell_kind", lambda c: calls.append(c) or kind(c))
    df = spark.createDataFrame([tuple(["1", "x"] * 10), tuple([None, "2"] * 10)], ", ".join(f"c{i} string" for i in range(20)))
    assert [f.dataType.simpleString() for f in infer.infer_types(df).fields] == ["bigint", "string"] * 10
    assert len(calls) == 1
    assert infer.infer_types(df.where("false")).simpleString().count("string") == 20


def test_a_file_is_inferred_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, 'a "b", c\nd', True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5, 678900), "NA"),
                                (None, None, "", None, None, None, "007")],
                               "i long, `d x` double, s string, b boolean, day date, at timestamp_ntz, code string")
    path = str(tmp_path / "t")
    io.write_table(df, path, "csv")
    found = infer.infer_schema(spark, path, multi_line=True)
    assert [(f.name, f.dataType) for f in found.fields] == [(f.name, f.dataType) for f in df.schema.fields]
    back = io.read_table(spark, path, "csv", found, multi_line=True, na_strings=())
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    marks = infer.infer_schema(spark, path, multi_line=True, na_strings=("", "NA", "007"))
    assert marks["code"].dataType.simpleString() == "string"
