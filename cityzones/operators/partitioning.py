"""Distribution controls."""

from __future__ import annotations

from pyspark.sql import DataFrame


def repartition_by_key(df: DataFrame, keys: list[str], num_partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``keys`` with Spark's own hash (stable across processes).

    Usually unnecessary: an aggregation or join on the same keys already
    plans the exchange, and a later one on the same keys reuses it."""
    if num_partitions:
        return df.repartition(num_partitions, *keys)
    return df.repartition(*keys)
