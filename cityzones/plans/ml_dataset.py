"""The denormalised training dataset: listing fields + the area's income."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.functions.checks import require_not_null
from cityzones.operators.joins import join_measured
from cityzones.schemas import ML_DATASET_COLUMNS, ML_DATASET_DDL, fields


ML_TYPES = dict(fields(ML_DATASET_DDL))


def ml_dataset(rent: DataFrame, income: DataFrame) -> DataFrame:
    """Join every listing to the income of its neighbourhood in the same year.

    Both keys are join keys (no per-neighbourhood fan-out over all years).
    The three income columns are computed once and joined by their measured
    size (``operators.joins.join_measured``).
    Output: the 17 typed dataset columns; neighbourhood id and year must not
    be null (the job fails otherwise)."""
    listing_cols = [c for c in ML_DATASET_COLUMNS if c != "RFD"]
    r = rent.select(*listing_cols)
    inc = income.select(F.col("neighborhood_id").alias("_inc_id"),
                        F.col("year").cast("int").alias("_inc_year"), "RFD")
    joined = join_measured(r.withColumn("_yr", F.col("year").cast("int")), inc,
                           ["neighborhoodId", "_yr"], ["_inc_id", "_inc_year"])
    typed = joined.select(*[F.col(c).cast(ML_TYPES[c]).alias(c) for c in ML_DATASET_COLUMNS])
    return require_not_null(typed, ["neighborhoodId", "year"])
