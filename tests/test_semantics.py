
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cityzones.operators.reconcile import reconcile
from cityzones.operators.sets import dedupe
from cityzones.plans import ml
from conftest import rows


def test_d8_null_keys_never_match(spark):
    lk = spark.createDataFrame([(None, "N0"), ("a", "N1")], "neighborhood string, neighborhood_id string")
    df = spark.createDataFrame([(None, 1), ("a", 2)], "name string, v int")
    out = reconcile(df, lk, "name", on_unmatched="keep")
    assert rows(out, "v", "neighborhood_id") == [(1, None), (2, "N1")]


def test_d9_dataframe_distinct_merges_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),), (1.0,)], "x double")
    assert dedupe(df).count() == 2


def _ds(spark):
    return spark.createDataFrame(
        [("N1", 2020, 100.0, 10.0, None, True, "flat"), ("N1", 2020, 200.0, 20.0, 2.0, False, "flat"),
         ("N2", 2020, 300.0, 30.0, 4.0, True, "house"), ("N2", 2021, 400.0, 40.0, 6.0, None, "flat")],
        "neighborhoodId string, year int, price double, size double, RFD double, "
        "exterior boolean, propertyType string")


def test_d17_imputer_only_matters_without_na_drop(spark):
    df = _ds(spark)
    assert df.na.drop().count() == 2          # the default drops the null rows first
    kept = df.na.drop(subset=["exterior"])    # keep the null RFD row
    stages = ml.feature_stages(kept, categorical=["propertyType"])
    out = Pipeline(stages=stages).fit(kept).transform(kept)
    rfd = {r["size"]: r["RFD"] for r in out.select("size", "RFD").collect()}
    assert rfd[10.0] == 3.0                   # mean of the remaining 2 and 4, imputed in place


def test_d2_one_hots_join_features_only_when_asked(spark):
    df = _ds(spark).na.drop()
    plain = Pipeline(stages=ml.feature_stages(df, categorical=["propertyType"])).fit(df).transform(df)
    wide = Pipeline(stages=ml.feature_stages(df, categorical=["propertyType"], include_categorical=True)
                    ).fit(df).transform(df)
    n_plain = plain.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
    n_wide = wide.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
    assert n_plain == 3                       # size, RFD (numeric) + exterior (boolean)
    assert n_wide == n_plain + 1              # two categories, last one dropped
