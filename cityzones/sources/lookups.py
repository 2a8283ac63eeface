"""Lookup readers: each returns the joined lookup with ``LOOKUP_COLUMNS``
(rent and income) or the six incident-lookup columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityzones.operators.reconcile import build_lookup
from cityzones.schemas import (
    INCIDENT_LOOKUP_DDL,
    INCOME_DISTRICT_LOOKUP_DDL,
    INCOME_NEIGHBORHOOD_LOOKUP_DDL,
    RENT_DISTRICT_LOOKUP_DDL,
    RENT_NEIGHBORHOOD_LOOKUP_DDL,
    field_names,
)
from cityzones.sources.files import read_csv_naive, read_csv_strict, read_json_lines

# FIXED VALUES: rent-lookup short field names -> income-lookup names.
RENT_DISTRICT_RENAME = {"di": "district", "di_n": "district_name",
                        "di_re": "district_reconciled", "ne_id": "neighborhood_id"}
RENT_NEIGHBORHOOD_RENAME = {"ne": "neighborhood", "ne_n": "neighborhood_name",
                            "ne_re": "neighborhood_reconciled"}

INCIDENT_LOOKUP_COLUMNS = ["neighborhood_id", "neighborhood", "neighborhood_reconciled",
                           "district_id", "district", "district_reconciled"]


def income_lookup(spark: SparkSession, districts_path: str, neighborhoods_path: str) -> DataFrame:
    return build_lookup(read_json_lines(spark, districts_path, INCOME_DISTRICT_LOOKUP_DDL),
                        read_json_lines(spark, neighborhoods_path, INCOME_NEIGHBORHOOD_LOOKUP_DDL))


def rent_lookup(spark: SparkSession, districts_path: str, neighborhoods_path: str) -> DataFrame:
    d = read_json_lines(spark, districts_path, RENT_DISTRICT_LOOKUP_DDL).withColumnsRenamed(
        RENT_DISTRICT_RENAME)
    n = read_json_lines(spark, neighborhoods_path, RENT_NEIGHBORHOOD_LOOKUP_DDL).withColumnsRenamed(
        RENT_NEIGHBORHOOD_RENAME)
    return build_lookup(d, n)


def shape_incident_lookup(df: DataFrame) -> DataFrame:
    """Incident-lookup file columns -> (id, raw name, reconciled name, district
    id, raw district, reconciled district)."""
    return df.select(
        "neighborhood_id", "neighborhood",
        F.col("neighborhood_n_reconciled").alias("neighborhood_reconciled"),
        "district_id", "district",
        F.col("district_n_reconciled").alias("district_reconciled"),
    )


def incident_lookup(spark: SparkSession, path: str, naive_split: bool = False) -> DataFrame:
    """The incident lookup CSV.  Default: real CSV parsing (quoted commas kept,
    lines with another field count dropped, the header checked).
    ``naive_split``: split on every comma after the quoted-comma patch, which
    drops rows whose quoted fields still hold commas."""
    if naive_split:
        raw = read_csv_naive(spark, path, field_names(INCIDENT_LOOKUP_DDL), patch_quoted=True)
    else:
        raw = read_csv_strict(spark, path, field_names(INCIDENT_LOOKUP_DDL), check_header=True)
    return shape_incident_lookup(raw)
