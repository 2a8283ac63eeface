"""Schemas of the landing, lookup and derived tables.

FIXED VALUES: field names, order and types below must equal the source data
model (rent listings, income series, incident logs, lookups, ML dataset), so
they are stated as plain DDL in their natural order.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values: landing zone -------------------------------------------------

# Rent listing snapshot (one folder per scrape date, files part-*).
RENT_DDL = (
    "address string, bathrooms bigint, country string, "
    "detailedType struct<subTypology:string, typology:string>, "
    "distance string, district string, exterior boolean, externalReference string, "
    "floor string, has360 boolean, has3DTour boolean, hasLift boolean, hasPlan boolean, "
    "hasStaging boolean, hasVideo boolean, latitude double, longitude double, "
    "municipality string, neighborhood string, newDevelopment boolean, "
    "newDevelopmentFinished boolean, numPhotos bigint, operation string, "
    "parkingSpace struct<hasParkingSpace:boolean, isParkingSpaceIncludedInPrice:boolean, "
    "parkingSpacePrice:double>, "
    "price double, priceByArea double, propertyCode string, propertyType string, "
    "province string, rooms bigint, showAddress boolean, size double, status string, "
    "suggestedTexts struct<subtitle:string, title:string>, "
    "thumbnail string, topNewDevelopment boolean, url string"
)

# Income series, JSON lines.  The neighbourhood-name key really carries a
# trailing space in the source files.
INCOME_RAW_NAME_KEY = "neigh_name "
INCOME_RAW_DDL = (
    "_id string, `neigh_name ` string, district_id string, district_name string, "
    "info array<struct<year:int, pop:bigint, RFD:double>>"
)

# Incident log, CSV with a header, 25 fields kept as strings.  Positions 11-14
# are raw district / neighbourhood fields; 14 is the raw neighbourhood name used
# for reconciliation, named BARRI as in the source header.
INCIDENT_FIELDS = [
    "fitxaID", "type", "area", "element", "detall",
    "diaDataAlta", "mesDataAlta", "anyDataAlta",
    "diaDataTancament", "mesDataTancament", "anyDataTancament",
    "raw11", "raw12", "raw13", "BARRI",
    "seccioCensal", "tipusVia", "carrer", "numero",
    "coordenadaX", "coordenadaY", "longitud", "latitud",
    "suport", "canalsResposta",
]
INCIDENT_NAME_FIELD = "BARRI"
INCIDENT_DROPPED = ["raw11", "raw12", "raw13", "BARRI"]
INCIDENT_TYPE_INCIDENT = "INCIDENCIA"

# --- fixed values: lookups ----------------------------------------------------------

INCOME_DISTRICT_LOOKUP_DDL = (
    "_id string, district string, district_name string, district_reconciled string, "
    "neighborhood_id array<string>"
)
INCOME_NEIGHBORHOOD_LOOKUP_DDL = (
    "_id string, neighborhood string, neighborhood_name string, neighborhood_reconciled string"
)
RENT_DISTRICT_LOOKUP_DDL = "_id string, di string, di_n string, di_re string, ne_id array<string>"
RENT_NEIGHBORHOOD_LOOKUP_DDL = "_id string, ne string, ne_n string, ne_re string"
# Header of the incident lookup CSV.
INCIDENT_LOOKUP_DDL = (
    "neighborhood_id string, neighborhood_n_reconciled string, neighborhood string, "
    "district_id string, district_n_reconciled string, district string"
)

# Columns of the joined (district x neighbourhood) lookup, in this order.
LOOKUP_COLUMNS = [
    "neighborhood_id", "neighborhood", "neighborhood_name", "neighborhood_reconciled",
    "district_id", "district", "district_name", "district_reconciled",
]

# --- fixed values: formatted / exploitation zone -----------------------------------

INCOME_COLUMNS = ["id", "year", "population", "RFD", "neighborhood_id"]
NEIGHBORHOOD_DIM_COLUMNS = [
    "neighborhood_id", "neighborhood_reconciled", "district_id", "district_reconciled",
]
AVG_INDICATOR_COLUMNS = ["neighborhood", "year", "avg_income", "avg_rent"]
LISTING_INDICATOR_COLUMNS = [
    "day", "month", "year", "neighborhood", "count_incidences", "count_housing",
]
POPULATION_COLUMNS = ["neighborhood_id", "year", "population"]

ML_DATASET_DDL = (
    "neighborhoodId string not null, year int not null, bathrooms bigint, rooms bigint, "
    "country string, distance string, district string, exterior boolean, hasLift boolean, "
    "municipality string, newDevelopment boolean, price double, "
    "newDevelopmentFinished boolean, priceByArea double, propertyType string, "
    "size double, RFD double"
)
ML_CATEGORICAL = ["propertyType", "district", "neighborhoodId"]
ML_LABEL = "price"
ML_EXCLUDED = ["year"]


def fields(ddl: str) -> list[tuple[str, str]]:
    """Top-level ``(name, type)`` pairs of a DDL string (no session needed);
    ``not null`` is dropped from the type."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        elif ch == "," and depth == 0:
            part = ddl[start:i].strip()
            if part.startswith("`"):
                name, rest = part[1:].split("`", 1)
            else:
                name, rest = part.split(" ", 1)
            out.append((name, rest.strip().replace(" not null", "")))
            start = i + 1
    return out


def field_names(ddl: str) -> list[str]:
    """Top-level field names of a DDL string (no session needed)."""
    return [n for n, _ in fields(ddl)]


def struct(ddl: str) -> StructType:
    """Parse a DDL string into a StructType (needs an active session)."""
    return StructType.fromDDL(ddl)


RENT_COLUMNS = field_names(RENT_DDL)
ML_DATASET_COLUMNS = field_names(ML_DATASET_DDL)
# Dataset columns whose text form is the same everywhere: the default keys of the train / test split.
ML_SPLIT_KEYS = [n for n, t in fields(ML_DATASET_DDL) if t in ("string", "int", "bigint")]


# Partition columns of the formatted tables, the same for batch and incremental runs.
FORMATTED_PARTITIONS = {"income": ["year"], "rent": ["year", "month"], "incidents": ["anyDataAlta"]}
