import pytest
from pyspark.sql import functions as F

from cityzones.plans import ml
from cityzones.schemas import ML_DATASET_DDL


def dataset(spark, n=400):
    df = spark.range(n).select(
        F.concat(F.lit("N"), (F.col("id") % 4).cast("string")).alias("neighborhoodId"),
        (2020 + F.col("id") % 2).cast("int").alias("year"),
        (F.col("id") % 3 + 1).cast("bigint").alias("bathrooms"),
        (F.col("id") % 5 + 1).cast("bigint").alias("rooms"),
        F.lit("es").alias("country"), (F.col("id") % 7).cast("string").alias("distance"),
        F.when(F.col("id") % 4 < 2, "D1").otherwise("D2").alias("district"),
        (F.col("id") % 2 == 0).alias("exterior"), (F.col("id") % 3 == 0).alias("hasLift"),
        F.lit("bcn").alias("municipality"), F.lit(False).alias("newDevelopment"),
        (F.col("id") % 50 * 20 + 500 + (F.col("id") % 4) * 100).cast("double").alias("price"),
        F.lit(False).alias("newDevelopmentFinished"),
        (F.col("id") % 11 + 10).cast("double").alias("priceByArea"),
        F.when(F.col("id") % 5 == 0, "chalet").otherwise("flat").alias("propertyType"),
        (F.col("id") % 50 + 40).cast("double").alias("size"),
        (F.col("id") % 4 * 10 + 50).cast("double").alias("RFD"))
    return df


def test_select_features_by_type(spark):
    num, boo = ml.select_features(dataset(spark).schema)
    assert num == ["priceByArea", "size", "RFD"]          # bigint bathrooms/rooms are not numeric
    assert boo == ["exterior", "hasLift", "newDevelopment", "newDevelopmentFinished"]


def test_hash_split_is_stable_and_disjoint(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    tr, te = ml.hash_split(df, ["k"], 0.7)
    tr2, _ = ml.hash_split(df.repartition(7), ["k"], 0.7)
    a = {r.k for r in tr.collect()}
    assert a == {r.k for r in tr2.collect()}
    assert a.isdisjoint({r.k for r in te.collect()})
    assert 0.6 < len(a) / 2000 < 0.8


def test_imputer_mean_truncates_int(spark):
    from pyspark.ml.feature import Imputer
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "q int")
    m = Imputer(inputCols=["q"], outputCols=["q"]).fit(df)
    assert sorted(r.q for r in m.transform(df).collect()) == [1, 1, 2, 2]


def test_string_index_order_and_one_hot_drop_last(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "v string")
    (ix,) = ml.fit_indexers(df, ["v"])
    assert list(ix.labelsArray[0]) == ["a", "b", "c"]   # tie a/b by name, then c


def test_train_evaluate_save_list_load(spark, tmp_dir):
    df = dataset(spark)
    model, pred, rmse = ml.train(df, split_keys=["neighborhoodId", "year", "price", "size",
                                                 "priceByArea", "bathrooms"], seed=3)
    assert "prediction" in pred.columns and rmse > 0
    # better than predicting the mean price
    stats = pred.agg(F.stddev_pop("price").alias("sd")).first()
    assert rmse < stats["sd"]
    # same seed, same split -> same forest
    _, _, rmse2 = ml.train(df, split_keys=["neighborhoodId", "year", "price", "size",
                                           "priceByArea", "bathrooms"], seed=3)
    assert rmse2 == pytest.approx(rmse)
    root = f"{tmp_dir}/models"
    p1 = ml.save_versioned(model, f"{root}/forest", "20240101000000")
    ml.save_versioned(model, f"{root}/forest", "20240301000000")
    with pytest.raises(Exception):
        ml.save_versioned(model, f"{root}/forest", "20240101000000")   # versions are immutable
    versions = ml.list_model_versions(spark, root)
    assert sorted((r.name, r.version) for r in versions.collect()) == [
        ("forest", "20240101000000"), ("forest", "20240301000000")]
    latest = ml.latest_model_path(spark, root, "forest")
    assert latest.endswith("forest_v20240301000000")
    assert ml.latest_model_path(spark, root, "forest", "20240101000000").endswith("forest_v20240101000000")
    assert ml.latest_model_path(spark, root, "forest", "19990101000000") is None
    loaded = ml.load_model(p1)
    _, rmse_loaded = ml.evaluate(loaded, ml.hash_split(df, ["neighborhoodId", "year", "price", "size",
                                                            "priceByArea", "bathrooms"])[1])
    assert rmse_loaded == pytest.approx(rmse)


def test_load_dataset_declared_vs_inferred(spark, tmp_dir):
    from cityzones.sources.sinks import write_csv
    path = write_csv(dataset(spark, 50), f"{tmp_dir}/ds")
    declared = ml.load_dataset(spark, path)
    assert dict(declared.dtypes)["distance"] == "string"
    inferred = ml.load_dataset(spark, path, infer=True)
    assert dict(inferred.dtypes)["distance"] == "int"   # all-digit text becomes a number
    assert "distance" in ml.select_features(inferred.schema)[0]
    assert ML_DATASET_DDL
