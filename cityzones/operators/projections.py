"""Projections: by-name selection, renaming, dropping, struct flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def select_renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select ``mapping`` keys in order, renamed to its values."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Replace every top-level struct column by its fields, named
    ``parent{sep}field`` (one level; nested structs stay structs)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType):
            out += [F.col(f"`{f.name}`.`{c.name}`").alias(f"{f.name}{sep}{c.name}")
                    for c in f.dataType.fields]
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
