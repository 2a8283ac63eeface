"""End-to-end runs of the three zones, from storage paths to storage.

These are the library's equivalents of the reference's menu options:
formatted zone, exploitation zone (indicator tables over JDBC), ML dataset,
training with a versioned model, and re-evaluation of a saved version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityzones.plans import ml as ml_plan
from cityzones.plans.formatters import format_incidents, format_income, format_rent, neighborhood_dim
from cityzones.plans.indicators import export_indicators, indicators_from_daily, population, rent_daily
from cityzones.plans.ml_dataset import ml_dataset
from cityzones.plans.lookup_builder import build_incident_lookup
from cityzones.schemas import FORMATTED_PARTITIONS, INCIDENT_DROPPED, INCIDENT_FIELDS, ML_SPLIT_KEYS
from cityzones.sources.files import read_csv_columns, read_incidents, read_income, read_rent
from cityzones.sources.lookups import incident_lookup, income_lookup, rent_lookup
from cityzones.session import cut_lineage
from cityzones.sources.sinks import write_csv, write_parquet


@dataclass
class Landing:
    """Paths of the landing zone and its lookups."""
    income: str
    income_districts: str
    income_neighborhoods: str
    rent_root: str
    rent_districts: str
    rent_neighborhoods: str
    incidents: str
    incident_lookup: str
    naive_csv: bool = False


def run_incident_lookup(spark: SparkSession, incidents_folder: str, canon_districts: str,
                        canon_neighborhoods: str, out_csv: str, name_col: str = "BARRI",
                        district_col: str = "DISTRICTE", max_distance: int = 2) -> str:
    """Build the incident lookup from the raw names in the incident CSV files.

    The canonical knowledge base is the income lookup (JSON lines, district and
    neighbourhood files): ids, canonical names and each neighbourhood's
    district.  The result is a CSV folder whose files carry the incident-lookup
    header; every lookup reader reads folders."""
    lk = income_lookup(spark, canon_districts, canon_neighborhoods)
    districts = lk.select("district_id", F.col("district_reconciled").alias("district_name")).distinct()
    neighborhoods = lk.select("neighborhood_id",
                              F.col("neighborhood_reconciled").alias("neighborhood_name"), "district_id")
    names = read_csv_columns(spark, incidents_folder, [name_col, district_col])
    table = build_incident_lookup(names, districts, neighborhoods, name_col, district_col, max_distance)
    return write_csv(table, out_csv)


# Formatted-zone table names (folders below the formatted root).
INCIDENTS_DDL = ", ".join(f"`{c}` string" for c in
                          ["neighborhoodID"] + [f for f in INCIDENT_FIELDS if f not in INCIDENT_DROPPED])
INCOME, RENT, INCIDENTS, NEIGHBORHOODS = "income", "rent", "incidents", "neighborhoods"


def run_formatted_zone(spark: SparkSession, landing: Landing, formatted_root: str,
                       on_unmatched: str = "error", only: list[str] | None = None) -> dict[str, str]:
    """Format the three sources and the neighbourhood dimension into Parquet
    (``only``: a subset of ``income``, ``rent``, ``incidents``,
    ``neighborhoods``).

    Partitioned by date for pruning, with the same layout as the streaming
    ingestion: ``rent`` by snapshot year / month, ``income`` by year,
    ``incidents`` by opening year."""
    tables = set(only or (INCOME, RENT, INCIDENTS, NEIGHBORHOODS))
    unknown = tables - {INCOME, RENT, INCIDENTS, NEIGHBORHOODS}
    if unknown:
        raise ValueError(f"unknown formatted tables: {sorted(unknown)}")
    root = formatted_root.rstrip("/")

    def lk_income():
        return income_lookup(spark, landing.income_districts, landing.income_neighborhoods)

    def lk_rent():
        return rent_lookup(spark, landing.rent_districts, landing.rent_neighborhoods)

    def lk_incidents():
        return incident_lookup(spark, landing.incident_lookup, naive_split=landing.naive_csv)

    out = {}
    if INCOME in tables:
        out[INCOME] = write_parquet(format_income(read_income(spark, landing.income), lk_income(),
                                                  on_unmatched), f"{root}/{INCOME}",
                                    partition_by=FORMATTED_PARTITIONS[INCOME])
    if RENT in tables:
        out[RENT] = write_parquet(format_rent(read_rent(spark, landing.rent_root), lk_rent()),
                                  f"{root}/{RENT}", partition_by=FORMATTED_PARTITIONS[RENT])
    if INCIDENTS in tables:
        out[INCIDENTS] = write_parquet(
            format_incidents(read_incidents(spark, landing.incidents, landing.naive_csv),
                             lk_incidents(), on_unmatched),
            f"{root}/{INCIDENTS}", partition_by=FORMATTED_PARTITIONS[INCIDENTS])
    if NEIGHBORHOODS in tables:
        out[NEIGHBORHOODS] = write_parquet(neighborhood_dim(lk_income(), lk_incidents(), lk_rent()),
                                           f"{root}/{NEIGHBORHOODS}")
    return out


def run_incremental_zone(spark: SparkSession, landing: Landing, formatted_root: str,
                         only: list[str] | None = None, on_unmatched: str = "error") -> dict[str, str]:
    """Bring the formatted rent, income and incident tables up to date with
    the landing files that arrived since the last run (Structured Streaming,
    available-now trigger; same layout as ``run_formatted_zone``).

    Stream progress is kept below ``<formatted_root>/_streams/<table>``, a
    stable location on the same shared storage, so each run reads only new
    files.  The neighbourhood dimension comes from the lookups: use
    ``run_formatted_zone(only=['neighborhoods'])``."""
    from cityzones.streaming import ingest_incidents, ingest_income, ingest_rent
    tables = set(only or (INCOME, RENT, INCIDENTS))
    unknown = tables - {INCOME, RENT, INCIDENTS}
    if unknown:
        raise ValueError(f"unknown streamed tables: {sorted(unknown)}")
    root = formatted_root.rstrip("/")
    queries, out = [], {}
    if INCOME in tables:
        queries.append(ingest_income(
            spark, landing.income, income_lookup(spark, landing.income_districts, landing.income_neighborhoods),
            f"{root}/{INCOME}", f"{root}/_streams/{INCOME}", on_unmatched=on_unmatched))
        out[INCOME] = f"{root}/{INCOME}"
    if RENT in tables:
        queries.append(ingest_rent(
            spark, landing.rent_root, rent_lookup(spark, landing.rent_districts, landing.rent_neighborhoods),
            f"{root}/{RENT}", f"{root}/_streams/{RENT}"))
        out[RENT] = f"{root}/{RENT}"
    if INCIDENTS in tables:
        queries.append(ingest_incidents(
            spark, landing.incidents,
            incident_lookup(spark, landing.incident_lookup, naive_split=landing.naive_csv),
            f"{root}/{INCIDENTS}", f"{root}/_streams/{INCIDENTS}", on_unmatched=on_unmatched,
            naive_csv=landing.naive_csv))
        out[INCIDENTS] = f"{root}/{INCIDENTS}"
    for q in queries:
        q.awaitTermination()
    return out


def formatted_tables(spark: SparkSession, formatted_root: str, years: list[int] | None = None):
    """``(income, rent, incidents)`` of the formatted zone, restricted to
    ``years`` when given (folder pruning on the year-partitioned rent table)."""
    root = formatted_root.rstrip("/")
    income = spark.read.parquet(f"{root}/{INCOME}")
    rent = spark.read.parquet(f"{root}/{RENT}").select("neighborhoodId", "year", "month", "day", "price")
    # declared schema: the partition values stay text, as the formatter made them
    incidents = spark.read.schema(INCIDENTS_DDL).parquet(f"{root}/{INCIDENTS}")
    if years:
        income = income.where(F.col("year").isin(list(years)))
        rent = rent.where(F.col("year").isin(list(years)))
        incidents = incidents.where(F.col("anyDataAlta").isin([str(y) for y in years]))
    return income, rent, incidents


def exploitation_tables(spark: SparkSession, formatted_root: str,
                        years: list[int] | None = None) -> dict[str, DataFrame]:
    """The four indicator tables, keyed by their database table names.

    Rent is scanned once: its daily aggregate (neighbourhoods x days rows) is
    checkpointed to the reliable checkpoint folder (an eager job) and both
    AVGIND and LISTINGIND are derived from it.  ``years`` restricts every
    indicator to those years; on the rent table (partitioned by year / month)
    the filter prunes folders."""
    income, rent, incidents = formatted_tables(spark, formatted_root, years)
    daily = cut_lineage(rent_daily(rent))
    avgind, listing = indicators_from_daily(income, incidents, daily)
    return {
        "AVGIND": avgind,
        "LISTINGIND": listing,
        "POPULATION": population(income),
        "NEIGHBORHOODS": spark.read.parquet(f"{formatted_root.rstrip('/')}/{NEIGHBORHOODS}"),
    }


def run_exploitation_zone(spark: SparkSession, formatted_root: str, url: str, properties: dict,
                          mode: str = "overwrite", years: list[int] | None = None) -> None:
    """Write the indicator tables over JDBC (credentials in ``properties``)."""
    tables = exploitation_tables(spark, formatted_root, years)
    export_indicators(tables, url, properties, mode)


def run_ml_dataset(spark: SparkSession, formatted_root: str, out_csv: str) -> str:
    root = formatted_root.rstrip("/")
    ds = ml_dataset(spark.read.parquet(f"{root}/{RENT}"), spark.read.parquet(f"{root}/{INCOME}"))
    return write_csv(ds, out_csv)


def run_training(spark: SparkSession, dataset_csv: str, model_base: str, seed: int = 42,
                 version: str | None = None, split_keys: list[str] | None = None):
    """Train and save a new model version; returns ``(path, rmse)``.

    The split is by the dataset's text and integer columns (or ``split_keys``):
    a row is on the same side in every run and every partitioning, also in
    ``run_prediction``."""
    df = ml_plan.load_dataset(spark, dataset_csv)
    model, _, rmse = ml_plan.train(df, seed=seed, split_keys=split_keys or ML_SPLIT_KEYS)
    return ml_plan.save_versioned(model, model_base, version), rmse


def run_prediction(spark: SparkSession, dataset_csv: str, models_root: str, name: str | None = None,
                   path: str | None = None, split_keys: list[str] | None = None,
                   version: str | None = None):
    """Re-evaluate a saved version (default: the newest; or ``version``) on
    the test split of ``run_training``; returns ``(model path, rmse)``."""
    chosen = path or ml_plan.latest_model_path(spark, models_root, name, version)
    if chosen is None:
        raise FileNotFoundError(f"no saved model below {models_root}")
    _, test = ml_plan.hash_split(ml_plan.load_dataset(spark, dataset_csv), split_keys or ML_SPLIT_KEYS)
    _, rmse = ml_plan.evaluate(ml_plan.load_model(chosen), test)
    return chosen, rmse
