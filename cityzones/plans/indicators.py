"""Exploitation zone: indicator tables for the relational store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.functions.values import to_int
from cityzones.operators.aggregates import group_avg, group_count
from cityzones.schemas import (
    AVG_INDICATOR_COLUMNS,
    INCIDENT_TYPE_INCIDENT,
    LISTING_INDICATOR_COLUMNS,
    POPULATION_COLUMNS,
)
from cityzones.sources.sinks import write_jdbc


def _income_avg(income: DataFrame) -> DataFrame:
    return group_avg(income.select(F.col("neighborhood_id").alias("neighborhood"),
                                   F.col("year").cast("int").alias("year"), "RFD"),
                     ["neighborhood", "year"], "RFD", "avg_income")


def _incident_counts(incidents: DataFrame, strict_ints: bool) -> DataFrame:
    inc = (incidents.where(F.col("type") == F.lit(INCIDENT_TYPE_INCIDENT))
           .select(to_int("diaDataAlta", strict_ints).alias("day"),
                   to_int("mesDataAlta", strict_ints).alias("month"),
                   to_int("anyDataAlta", strict_ints).alias("year"),
                   F.col("neighborhoodID").alias("neighborhood")))
    return group_count(inc, ["day", "month", "year", "neighborhood"], "count_incidences")


def avg_indicators(income: DataFrame, rent: DataFrame) -> DataFrame:
    """Average income (RFD) and average rent price per (neighbourhood, year),
    for keys present on both sides.

    Plan: each side is aggregated partially in its map tasks, shuffled once on
    (neighbourhood, year), finalised, and the two aggregates are joined on the
    same partitioning - one exchange per side, none for the join."""
    inc = _income_avg(income)
    rnt = group_avg(rent.select(F.col("neighborhoodId").alias("neighborhood"),
                                F.col("year").cast("int").alias("year"), "price"),
                    ["neighborhood", "year"], "price", "avg_rent")
    return inc.join(rnt, ["neighborhood", "year"], "inner").select(*AVG_INDICATOR_COLUMNS)


def listing_indicators(incidents: DataFrame, rent: DataFrame, strict_ints: bool = True) -> DataFrame:
    """Incident count per (day, month, year, neighbourhood), with the number of
    listings of the same day and neighbourhood (null when there is none).

    Incident date parts are text; they are cast to int (``strict_ints`` fails
    the job on text that is not a number)."""
    inc = _incident_counts(incidents, strict_ints)
    lst = group_count(rent.select(F.col("day").cast("int").alias("day"),
                                  F.col("month").cast("int").alias("month"),
                                  F.col("year").cast("int").alias("year"),
                                  F.col("neighborhoodId").alias("neighborhood")),
                      ["day", "month", "year", "neighborhood"], "count_housing")
    return inc.join(lst, ["day", "month", "year", "neighborhood"], "left") \
              .select(*LISTING_INDICATOR_COLUMNS)


def population(income: DataFrame) -> DataFrame:
    """Population per (neighbourhood, year) as stored in the income table."""
    return income.select(*POPULATION_COLUMNS)


def export_indicators(tables: dict[str, DataFrame], url: str, properties: dict,
                      mode: str = "overwrite") -> None:
    """Write each ``{table_name: df}`` to the database over JDBC."""
    for name, df in tables.items():
        write_jdbc(df, url, name, properties, mode)


def rent_daily(rent: DataFrame) -> DataFrame:
    """Rent listings per (neighbourhood, year, month, day): price sum, priced
    listings and all listings.  Both indicator tables can be derived from it,
    so the rent table is scanned once; its size is neighbourhoods x days."""
    return (rent.groupBy(F.col("neighborhoodId").alias("neighborhood"),
                         F.col("year").cast("int").alias("year"),
                         F.col("month").cast("int").alias("month"),
                         F.col("day").cast("int").alias("day"))
            .agg(F.sum("price").alias("price_sum"), F.count("price").alias("priced"),
                 F.count(F.lit(1)).alias("count_housing")))


def indicators_from_daily(income: DataFrame, incidents: DataFrame, daily: DataFrame,
                          strict_ints: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(AVGIND, LISTINGIND)`` from the daily rent aggregate.  The average
    rent is the price sum over priced listings (nulls ignored, as ``avg``)."""
    inc = _income_avg(income)
    rnt = daily.groupBy("neighborhood", "year").agg(
        F.try_divide(F.sum("price_sum"), F.sum("priced")).alias("avg_rent"))
    avgind = inc.join(rnt, ["neighborhood", "year"], "inner").select(*AVG_INDICATOR_COLUMNS)
    listing = _incident_counts(incidents, strict_ints).join(daily.select("day", "month", "year", "neighborhood", "count_housing"),
                          ["day", "month", "year", "neighborhood"], "left"
                          ).select(*LISTING_INDICATOR_COLUMNS)
    return avgind, listing
