"""Formatted zone: landing data -> clean tables keyed by canonical ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.functions.values import surrogate_key
from cityzones.operators.aggregates import first_per_key
from cityzones.operators.filters import non_empty, not_null
from cityzones.operators.generators import explode_structs
from cityzones.operators.reconcile import reconcile
from cityzones.operators.sets import dedupe, dedupe_grouped, tasks_for_rows, tasks_for_splits, union_all
from cityzones.schemas import (
    INCIDENT_DROPPED,
    INCIDENT_FIELDS,
    INCIDENT_NAME_FIELD,
    INCOME_COLUMNS,
    NEIGHBORHOOD_DIM_COLUMNS,
    RENT_COLUMNS,
)


def format_income(raw: DataFrame, lookup: DataFrame, on_unmatched: str = "error") -> DataFrame:
    """Income series -> one row per (neighbourhood, year).

    ``raw``: ``_id, neigh_name, district_id, district_name, info[year, pop, RFD]``.
    Explode ``info`` (an empty array yields nothing), remove duplicate rows,
    reconcile ``neigh_name`` to a neighbourhood id, key ``{year}_{id}``.
    Output: ``id, year, population, RFD, neighborhood_id``."""
    rows = explode_structs(raw, "info", ["_id", "neigh_name", "district_id", "district_name"],
                           ["year", "pop", "RFD"], {"pop": "population"})
    rows = dedupe(rows)
    matched = reconcile(rows, lookup, "neigh_name", on_unmatched=on_unmatched)
    return matched.select(
        surrogate_key("year", "neighborhood_id").alias("id"),
        F.col("year").cast("int").alias("year"), "population", "RFD", "neighborhood_id",
    ).select(*INCOME_COLUMNS)


def format_rent(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rent listings (37 fields + year, month, day) -> + ``neighborhoodId``.

    Rows without a neighbourhood are dropped, exact duplicates (same listing
    content on the same snapshot date) removed, and listings whose
    neighbourhood spelling is not in the lookup are dropped.  These go first:
    a spelling has one id, so only rows that stay are shuffled to be compared.
    Rows are counted first (Parquet: from the footers) to deal them over enough tasks."""
    cols = RENT_COLUMNS + ["year", "month", "day"]
    rows = not_null(raw.select(*cols), "neighborhood")
    matched = reconcile(rows, lookup, "neighborhood", out="neighborhoodId", on_unmatched="drop")
    return dedupe(matched.select(*cols, "neighborhoodId"), tasks_for_rows(raw.count()))


def format_incidents(raw: DataFrame, lookup: DataFrame, on_unmatched: str = "error",
                     grouped_by: list[str] | None = None) -> DataFrame:
    """Incident rows (25 string fields) -> ``neighborhoodID`` + 21 fields.

    Rows with an empty neighbourhood name are dropped, duplicates removed, the
    name reconciled through the incident lookup, and the four raw district /
    neighbourhood fields dropped.  ``grouped_by``: deduped by ``dedupe_grouped``."""
    rows = non_empty(raw.select(*INCIDENT_FIELDS), INCIDENT_NAME_FIELD)
    matched = reconcile(rows, lookup, INCIDENT_NAME_FIELD, out="neighborhoodID", on_unmatched=on_unmatched)
    matched = dedupe_grouped(matched, grouped_by) if grouped_by else dedupe(matched, tasks_for_splits(raw))
    kept = [f for f in INCIDENT_FIELDS if f not in INCIDENT_DROPPED]
    return matched.select("neighborhoodID", *kept)


def lookup_for_dimension(lookup8: DataFrame) -> DataFrame:
    """Rent / income lookup -> the six incident-lookup columns."""
    return lookup8.select("neighborhood_id", "neighborhood", "neighborhood_reconciled",
                          "district_id", "district", "district_reconciled")


def neighborhood_dim(income_lookup: DataFrame, incident_lookup: DataFrame,
                     rent_lookup: DataFrame) -> DataFrame:
    """One row per neighbourhood id from the three lookups.

    When the lookups disagree on a canonical name, the income lookup wins,
    then the incident lookup, then the rent lookup; remaining ties by name.
    Output: ``neighborhood_id, neighborhood_reconciled, district_id,
    district_reconciled``."""
    six = union_all([lookup_for_dimension(income_lookup), incident_lookup,
                     lookup_for_dimension(rent_lookup)], tag_col="_src")
    return first_per_key(
        six, ["neighborhood_id"],
        ["_src", "neighborhood_reconciled", "district_id", "district_reconciled"],
        NEIGHBORHOOD_DIM_COLUMNS[1:],
    ).select(*NEIGHBORHOOD_DIM_COLUMNS)
