"""Row filters (all pushed into the scan by Catalyst where the source allows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.functions._col import as_col
from cityzones.functions.text import split_fields


def not_null(df: DataFrame, *cols) -> DataFrame:
    """Keep rows where every column in ``cols`` is not null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & as_col(c).isNotNull()
    return df.where(cond)


def non_empty(df: DataFrame, col) -> DataFrame:
    """Keep rows whose string column is neither null nor ``''``.

    Null counts as empty because the CSV reader turns an empty field into null
    while a naive split keeps ``''``; both mean "no value"."""
    c = as_col(col)
    return df.where(c.isNotNull() & (c != ""))


def field_count_is(df: DataFrame, line_col, n: int, sep: str = ",") -> DataFrame:
    """Keep raw text lines that split into exactly ``n`` fields."""
    return df.where(F.size(split_fields(line_col, sep)) == n)


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows holding a null (or NaN, for floating columns) in ``subset``
    (default: every column)."""
    return df.na.drop(how="any", subset=subset)


def equals(df: DataFrame, col, value) -> DataFrame:
    """Keep rows where ``col == value``."""
    return df.where(as_col(col) == F.lit(value))
