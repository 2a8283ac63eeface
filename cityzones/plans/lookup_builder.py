"""Incident lookup built by reconciling the raw (neighbourhood, district)
names of the incident files against canonical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.operators.reconcile import reconcile_names
from cityzones.schemas import field_names, INCIDENT_LOOKUP_DDL
from cityzones.session import cut_lineage


def build_incident_lookup(names: DataFrame, districts: DataFrame, neighborhoods: DataFrame,
                          name_col: str = "BARRI", district_col: str = "DISTRICTE",
                          max_distance: int = 2) -> DataFrame:
    """One lookup row per distinct (raw neighbourhood, raw district) pair.

    ``districts``: ``district_id, district_name``; ``neighborhoods``:
    ``neighborhood_id, neighborhood_name, district_id``.  The district name is
    reconciled on its own; the neighbourhood name against the neighbourhoods of
    that district, or of all districts where the district found nothing.  Unmatched names keep null ids.  Output columns follow
    the incident-lookup file: neighborhood_id, neighborhood_n_reconciled,
    neighborhood, district_id, district_n_reconciled, district."""
    pairs = cut_lineage(names.select(name_col, district_col).na.drop().distinct())
    dist = reconcile_names(pairs.select(district_col), districts, district_col, "district_id",
                           "district_name", max_distance=max_distance, out_id="district_id",
                           out_name="district_n_reconciled", out_distance="_dd",
                           materialize=False)
    # used three times below: computed once
    with_d = cut_lineage(pairs.join(dist, district_col, "left"))
    neigh = reconcile_names(with_d.where(F.col("district_id").isNotNull()).select(name_col, "district_id"),
                            neighborhoods, name_col, "neighborhood_id", "neighborhood_name",
                            parent="district_id", canon_parent="district_id",
                            max_distance=max_distance, out_id="neighborhood_id",
                            out_name="neighborhood_n_reconciled", out_distance="_nd",
                            materialize=False)
    # a name whose district found nothing is looked for in all districts
    anywhere = reconcile_names(with_d.where(F.col("district_id").isNull()).select(name_col),
                               neighborhoods, name_col, "neighborhood_id", "neighborhood_name",
                               max_distance=max_distance, out_id="_any_id", out_name="_any_name",
                               out_distance="_ad", materialize=False)
    anywhere = anywhere.where(F.col("_any_id").isNotNull()).withColumn("_lost", F.lit(True))
    out = with_d.withColumn("_lost", F.col("district_id").isNull())
    out = out.join(neigh, [name_col, "district_id"], "left").join(anywhere, [name_col, "_lost"], "left")
    return out.select(
        F.coalesce("neighborhood_id", "_any_id").cast("string").alias("neighborhood_id"),
        F.coalesce("neighborhood_n_reconciled", "_any_name").alias("neighborhood_n_reconciled"),
        F.col(name_col).alias("neighborhood"), F.col("district_id").cast("string"),
        "district_n_reconciled", F.col(district_col).alias("district"),
    ).distinct().select(*field_names(INCIDENT_LOOKUP_DDL))
