"""Incremental formatted zone on Structured Streaming.

New landing files (rent snapshot folders, income JSON lines, incident CSVs)
are picked up by a file stream; each micro-batch goes through the same batch
formatter and is appended to the formatted table, partitioned by a date or
key column.  A micro-batch replayed after a failure must not duplicate rows,
and a row may reappear in a later batch (the batch formatter dedupes only
inside one batch), so before appending every batch is anti-joined, null-safe
on all columns, against the rows already stored in the partitions it touches
(partition pruning keeps that read small).  The stream's progress lives in a
checkpoint below the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from cityzones.plans.formatters import format_incidents, format_income, format_rent
from cityzones.schemas import (
    FORMATTED_PARTITIONS, INCIDENT_FIELDS, INCOME_RAW_DDL, INCOME_RAW_NAME_KEY, RENT_COLUMNS, RENT_DDL,
)
from cityzones.session import materialize, scratch_path
from cityzones.functions.checks import require_not_null
from cityzones.sources.files import INCOME_REQUIRED, parse_csv_naive, path_date_columns, strict_csv
from cityzones.sources.sinks import write_parquet


def rent_landing_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None
                        ) -> DataFrame:
    """Stream of raw listings from ``root/<YYYY_MM_DD_*>/part-*`` with year, month, day."""
    reader = spark.readStream.schema(RENT_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(f"{root.rstrip('/')}/*/part-*")
    with_path = raw.select(*RENT_COLUMNS, F.col("_metadata.file_path").alias("_path"))
    return path_date_columns(with_path).drop("_path")


def _existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path`` read with the batch's schema (partition values keep
    their type), or None when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_new_rows(batch: DataFrame, out_path: str, partition_cols: list[str], grouped: bool = False) -> None:
    """Append the rows of ``batch`` that ``out_path`` does not hold yet.

    The batch is computed once, and kept beside the table only where there is
    something to compare it with.  The partitions it touches (a handful of
    folders) become literal filters, so only these are listed and read.
    ``grouped``: its tasks hold few partitions each (``dedupe_grouped``), so
    rows are not shuffled again to write them where nothing is stored yet."""
    spark = batch.sparkSession
    new, rebalance = batch, not grouped
    stored = _existing(spark, out_path, batch.schema)
    if stored is not None:
        batch = materialize(batch, "stream-batch")
        touched = batch.select(*partition_cols).distinct().collect()
        here = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in row.asDict().items()])
                for row in touched]
        stored = stored.where(reduce(lambda a, b: a | b, here, F.lit(False))).select(*batch.columns)
        same = reduce(lambda a, b: a & b, [batch[c].eqNullSafe(stored[c]) for c in batch.columns])
        new, rebalance = batch.join(stored, same, "left_anti"), True
    write_parquet(new, out_path, mode="append", partition_by=partition_cols, rebalance=rebalance)


def run_incremental(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out_path: str,
                    partition_cols: list[str], checkpoint_location: str | None = None,
                    available_now: bool = True, processing_time: str | None = None,
                    grouped: bool = False) -> StreamingQuery:
    """Start the stream: ``transform`` each micro-batch, append new rows only.

    ``available_now`` processes everything that has landed and stops (a
    scheduled batch run); otherwise the query keeps running on
    ``processing_time`` triggers.  Recurring runs must pass the same
    ``checkpoint_location`` (shared storage) to read only new files; without
    one, a fresh folder is used and every file is read again (still without
    duplicates, thanks to the anti-join).  ``grouped``: see ``append_new_rows``."""
    spark = stream.sparkSession
    ckpt = checkpoint_location or scratch_path(spark, "stream-checkpoint")

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        append_new_rows(transform(df), out_path, partition_cols, grouped)

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_rent(spark: SparkSession, landing_root: str, lookup: DataFrame, out_path: str,
                checkpoint_location: str | None = None, available_now: bool = True,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Formatted rent table kept up to date from the landing zone, in the
    layout of the batch run (``schemas.FORMATTED_PARTITIONS``)."""
    stream = rent_landing_stream(spark, landing_root, max_files_per_trigger)
    return run_incremental(stream, lambda df: format_rent(df, lookup), out_path,
                           FORMATTED_PARTITIONS["rent"], checkpoint_location, available_now)


def ingest_income(spark: SparkSession, landing_path: str, lookup: DataFrame, out_path: str,
                  checkpoint_location: str | None = None, available_now: bool = True,
                  on_unmatched: str = "error") -> StreamingQuery:
    """Formatted income table kept up to date from new JSON-lines files,
    partitioned by year."""
    stream = require_not_null(spark.readStream.schema(INCOME_RAW_DDL).option("mode", "FAILFAST").json(landing_path)
                              .withColumnRenamed(INCOME_RAW_NAME_KEY, "neigh_name"), INCOME_REQUIRED)
    return run_incremental(stream, lambda df: format_income(df, lookup, on_unmatched), out_path,
                           FORMATTED_PARTITIONS["income"], checkpoint_location, available_now)


def ingest_incidents(spark: SparkSession, landing_path: str, lookup: DataFrame, out_path: str,
                     checkpoint_location: str | None = None, available_now: bool = True,
                     on_unmatched: str = "error", naive_csv: bool = False) -> StreamingQuery:
    """Formatted incident table kept up to date from new CSV files (header per
    file, rows with a wrong field count dropped), partitioned by the opening
    year text.  ``naive_csv`` splits on every comma, as in the batch run."""
    if naive_csv:
        stream = spark.readStream.text(landing_path)
    else:
        stream = strict_csv(spark.readStream, INCIDENT_FIELDS, landing_path)

    def transform(df: DataFrame) -> DataFrame:
        raw = parse_csv_naive(df, INCIDENT_FIELDS) if naive_csv else df
        first = _existing(spark, out_path, df.schema) is None  # later batches are compared with what is stored
        return format_incidents(raw, lookup, on_unmatched, FORMATTED_PARTITIONS["incidents"] if first else None)

    return run_incremental(stream, transform, out_path, FORMATTED_PARTITIONS["incidents"],
                           checkpoint_location, available_now, grouped=True)
