"""Frame reshaping helpers: column order, positional rename, split, missing values."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def relocate(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Move ``first`` columns to the front, the rest keep their order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def select_positions(df: DataFrame, n: int) -> DataFrame:
    """Keep the first ``n`` columns."""
    return df.select(*df.columns[:n])


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position; the name count must match exactly."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def separate(df: DataFrame, col: str, into: Sequence[str], sep: str, remove: bool = True) -> DataFrame:
    """Split a string column on a literal separator into named columns.

    Extra pieces are dropped; missing pieces are NULL.
    """
    parts = F.split(F.col(col), re.escape(sep), -1)
    out = df.select("*", *[F.get(parts, i).alias(name) for i, name in enumerate(into)])
    return out.drop(col) if remove and col not in into else out


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any of ``cols`` (default: all)."""
    return df.dropna("any", subset=list(cols) if cols else None)


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace missing values with per-column constants."""
    return df.fillna(dict(values))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns (the type predicate used by ``sum_numeric``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
