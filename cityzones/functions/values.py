"""Typed value expressions: casts, keys, fallbacks, version stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cityzones.functions._col import as_col


def to_int(col, strict: bool = True) -> Column:
    """String to int; surrounding spaces are allowed.

    ``strict`` raises on text that is present but not an integer (including
    ``''``), independent of the session's ANSI setting; otherwise such text
    becomes null.  Null stays null either way."""
    c = as_col(col)
    parsed = F.trim(c).try_cast("int")
    if not strict:
        return parsed
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not an integer: '"), c, F.lit("'")))
                  ).otherwise(parsed)


def surrogate_key(year, ident, sep: str = "_") -> Column:
    """``"{year}{sep}{id}"``; null when either part is null."""
    return F.concat(as_col(year).cast("string"), F.lit(sep), as_col(ident))


def null_fallback(col, fallback) -> Column:
    """``col`` when it is not null, else ``fallback`` (a column or a literal)."""
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(as_col(col), fb)


def version_string(ts) -> Column:
    """Model-version stamp ``yyyyMMddHHmmss`` of a timestamp column."""
    return F.date_format(as_col(ts), "yyyyMMddHHmmss")
