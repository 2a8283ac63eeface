"""Generators: one input row to zero or more output rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_structs(df: DataFrame, array_col: str, keep: list[str], fields: list[str] | None = None,
                    rename: dict | None = None) -> DataFrame:
    """One row per element of an array of structs, parent columns ``keep`` kept.

    An empty or null array yields no row.  ``fields`` picks struct fields
    (default all); ``rename`` maps field -> output name."""
    exploded = df.select(*keep, F.explode(array_col).alias("_elem"))
    names = fields or exploded.schema["_elem"].dataType.fieldNames()
    rename = rename or {}
    return exploded.select(*keep, *[F.col(f"_elem.{f}").alias(rename.get(f, f)) for f in names])


def explode_values(df: DataFrame, array_col: str, keep: list[str], out: str) -> DataFrame:
    """One row per element of an array of scalars (e.g. ids), parent columns kept."""
    return df.select(F.explode(array_col).alias(out), *keep)
