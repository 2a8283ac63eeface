"""Sinks.  None of them stops the session (the caller owns it)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, rebalance: bool = True) -> str:
    """Parquet, optionally partitioned into ``key=value`` folders.

    With ``partition_by``, ``rebalance`` groups rows by the partition columns
    first (AQE rebalance: small partitions are merged, a partition value
    holding a large share of rows is split over several tasks), so each
    folder gets a few well-sized files instead of one file per task."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, **options) -> str:
    df.write.mode(mode).options(header=header, **options).csv(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite", num_partitions: int | None = None,
               batch_size: int | None = None) -> None:
    """Write ``df`` to a database table over JDBC.

    Credentials and driver class come from ``properties`` (never hard-coded).
    ``mode='append'`` adds rows (batched inserts per partition);
    ``num_partitions`` bounds the number of concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    if batch_size:
        w = w.option("batchsize", batch_size)
    w.save()


def save_model(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline; fails if ``path`` exists (versions are immutable)."""
    model.write().save(path)
    return path
