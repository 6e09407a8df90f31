"""Types of text columns, from all their cells in one parallel pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.sources.io import DEFAULT_NA, read_table

# The kinds of a cell, a bit each. A column's set of kinds is the OR of its cells'.
BOOLEAN, WHOLE, NUMBER, DATE, TIME, ZONED, TEXT = (1 << k for k in range(7))
# What cells look like. Numbers with leading zeros are codes, that is, text.
LOOKS = (
    (WHOLE, r"^[+-]?(0|[1-9][0-9]{0,17})$"),
    (NUMBER, r"^[+-]?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$|^[+-]?Infinity$|^NaN$"),
    (BOOLEAN, r"^(TRUE|FALSE|True|False|true|false|T|F)$"),
    (DATE, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    (TIME, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?$"),
    (ZONED, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})$"),
)
# What a cell of any look but text begins with.
BEGINS = tuple("+-.0123456789INTFtf")
# The least type above a set of kinds: the first whose kinds hold them all.
LATTICE = ((0, T.StringType()), (BOOLEAN, T.BooleanType()), (WHOLE, T.LongType()), (WHOLE | NUMBER, T.DoubleType()),
           (DATE, T.DateType()), (DATE | TIME, T.TimestampNTZType()), (ZONED, T.TimestampType()))


def cell_kind(cell: Column) -> Column:
    """The kind of one cell's text; 0 for a missing one.

    Cheap exact tests come first: what no look begins with is text, what has
    the two dashes of a date in their places can only be a date or a time, and
    what has not can be neither.
    """
    def looks(bit: int) -> Column:
        fits = cell.rlike(dict(LOOKS)[bit])
        if bit in (DATE, TIME, ZONED):  # the 30th of February is text
            fits = fits & F.try_to_timestamp(cell if bit != DATE else F.concat(cell, F.lit(" 00:00:00"))).isNotNull()
        return fits

    dated = (F.substring(cell, 5, 1) == "-") & (F.substring(cell, 8, 1) == "-")
    timed, other = ([bit for bit, _ in LOOKS if (bit in (DATE, TIME, ZONED)) == d] for d in (True, False))
    kinds = [reduce(lambda k, bit: k.when(looks(bit), bit), bits[1:], F.when(looks(bits[0]), bits[0])).otherwise(TEXT) for bits in (timed, other)]
    return (F.when(cell.isNull(), 0).when(~F.substring(cell, 1, 1).isin(*BEGINS), TEXT)
            .when(dated, kinds[0]).otherwise(kinds[1]))


def join_kinds(kinds: int) -> T.DataType:
    """The least type that holds all cells of a set of kinds; a column with missing cells only is text."""
    return next((t for within, t in LATTICE if kinds & ~within == 0), T.StringType())


def infer_types(cells: DataFrame) -> T.StructType:
    """The schema that the text columns of ``cells`` have, from every cell.

    One aggregate: each cell's kind is a bit, a column's kinds are their OR,
    which is combined map-side, and the driver gets a row for each column. Cells
    are rows of (column, text), so that one small piece of code judges them all.
    """
    if not cells.columns:
        return T.StructType([])
    each = cells.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in cells.columns])).alias("_column", "_cell"))
    found = each.groupBy("_column").agg(F.bit_or(cell_kind(F.col("_cell"))).alias("_kinds")).collect()
    kinds = {r["_column"]: r["_kinds"] for r in found}
    return T.StructType([T.StructField(c, join_kinds(kinds.get(i, 0))) for i, c in enumerate(cells.columns)])


def infer_schema(spark: SparkSession, path: str | Sequence[str], sep: str = ",", na_strings: Sequence[str] = DEFAULT_NA,
                 multi_line: bool = False) -> T.StructType:
    """The schema of delimited files with a header, from every cell, for ``read_table``.

    Quotes around a cell are not part of it; separators and, with
    ``multi_line``, line ends inside quotes do not end it. NA marks and empty
    cells fit any type.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
             .option("multiLine", multi_line).csv(paths).columns)
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return infer_types(read_table(spark, paths, "csv", text, sep=sep, na_strings=na_strings, multi_line=multi_line))
