"""Grouped aggregations.  All are partial + final aggregates (map-side combine)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_avg(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Mean of ``value`` per key (nulls ignored)."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def group_count(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Row count per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def first_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """One row per key: the values of the row that is smallest by ``order``.

    Uses ``min`` over a struct, which aggregates partially inside each map task,
    instead of a window: a key holding a third of all rows never lands whole
    in one task."""
    ordered = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                       *[F.col(c) for c in values])
    return (df.groupBy(*keys).agg(F.min(ordered).alias("_first"))
              .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in values]))


def rmse(df: DataFrame, label: str, prediction: str, out: str = "rmse") -> DataFrame:
    """Root mean squared error as a one-row DataFrame."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(err * err)).alias(out))
