import pytest

from cityzones.plans.indicators import avg_indicators, listing_indicators, population
from cityzones.plans.ml_dataset import ml_dataset
from conftest import rows


def test_avg_indicators(spark):
    income = spark.createDataFrame([("N1", 2020, 10.0), ("N1", 2020, 20.0), ("N2", 2020, 5.0)],
                                   "neighborhood_id string, year bigint, RFD double")
    rent = spark.createDataFrame([("N1", 2020, 100.0), ("N1", 2020, None), ("N3", 2020, 1.0)],
                                 "neighborhoodId string, year int, price double")
    out = avg_indicators(income, rent)
    assert out.columns == ["neighborhood", "year", "avg_income", "avg_rent"]
    assert rows(out) == [("N1", 2020, 15.0, 100.0)]  # null price ignored; one-sided keys absent


def test_listing_indicators(spark):
    inc = spark.createDataFrame(
        [("N1", "INCIDENCIA", "05", "03", "2021"), ("N1", "INCIDENCIA", " 5", "3", "2021"),
         ("N2", "INCIDENCIA", "06", "03", "2021"), ("N1", "CONSULTA", "05", "03", "2021")],
        "neighborhoodID string, type string, diaDataAlta string, mesDataAlta string, anyDataAlta string")
    rent = spark.createDataFrame([("N1", 2021, 3, 5), ("N1", 2021, 3, 5), ("N1", 2021, 3, 6)],
                                 "neighborhoodId string, year int, month int, day int")
    out = listing_indicators(inc, rent)
    assert rows(out) == [(5, 3, 2021, "N1", 2, 2), (6, 3, 2021, "N2", 1, None)]
    bad = spark.createDataFrame([("N1", "INCIDENCIA", "", "03", "2021")], inc.schema)
    with pytest.raises(Exception, match="not an integer"):
        listing_indicators(bad, rent).collect()
    assert rows(listing_indicators(bad, rent, strict_ints=False)) == [(None, 3, 2021, "N1", 1, None)]


def test_population(spark):
    income = spark.createDataFrame([("2020_N1", 2020, 7, 1.0, "N1")],
                                   "id string, year int, population bigint, RFD double, neighborhood_id string")
    assert rows(population(income)) == [("N1", 2020, 7)]


def test_ml_dataset_joins_on_id_and_year(spark):
    from cityzones.schemas import ML_DATASET_COLUMNS
    cols = [c for c in ML_DATASET_COLUMNS if c != "RFD"]
    rent = spark.createDataFrame([("N1", 2020), ("N1", 2021), ("N2", 2020)], "neighborhoodId string, year int")
    for c in cols[2:]:
        rent = rent.withColumn(c, __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None))
    income = spark.createDataFrame([("N1", 2020, 1.5), ("N1", 2019, 9.0), ("N2", 2020, 2.5)],
                                   "neighborhood_id string, year bigint, RFD double")
    out = ml_dataset(rent, income)
    assert out.columns == ML_DATASET_COLUMNS
    assert rows(out, "neighborhoodId", "year", "RFD") == [("N1", 2020, 1.5), ("N2", 2020, 2.5)]
    assert dict(out.dtypes)["bathrooms"] == "bigint" and dict(out.dtypes)["year"] == "int"
