"""Price model: features, random forest, evaluation, versioned persistence.

Everything is a ``pyspark.ml`` stage; one ``PipelineModel`` holds imputer,
indexers, encoders, assemblers and forest, so evaluation re-uses exactly the
fitted preprocessing instead of re-fitting it."""

from __future__ import annotations

import datetime as _dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructType

from cityzones.schemas import ML_CATEGORICAL, ML_DATASET_DDL, ML_EXCLUDED, ML_LABEL
from cityzones.session import cut_lineage
from cityzones.sources.files import read_csv
from cityzones.sources.sinks import save_model

VERSION_FORMAT = "%Y%m%d%H%M%S"


# ---- data ------------------------------------------------------------------------

def load_dataset(spark: SparkSession, path: str, infer: bool = False,
                 drop_nulls: bool = True) -> DataFrame:
    """The dataset CSV.  Default: declared schema.  ``infer=True`` infers types
    (an extra pass; the feature set then depends on the data).  ``drop_nulls``
    removes rows with any null / NaN."""
    df = read_csv(spark, path, schema=None if infer else ML_DATASET_DDL.replace(" not null", ""),
                  infer=infer)
    return df.na.drop() if drop_nulls else df


SPLIT_RANGE = 2 ** 32


def split_value(keys: list[str]) -> Column:
    """Stable number in [0, 2**32) of a row from its key columns (md5 based).

    Keys should be text, integers or booleans: the text form of a double
    differs between engines and formats."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def split_cut(train_fraction: float) -> int:
    """Rows whose split value is below this are for training."""
    return round(train_fraction * SPLIT_RANGE)


def hash_split(df: DataFrame, keys: list[str], train_fraction: float = 0.7):
    """Deterministic train / test split: the same row always lands on the same
    side, across runs, partitionings and recomputations after executor loss."""
    cut, value = split_cut(train_fraction), split_value(keys)
    return df.where(value < cut), df.where(value >= cut)


def random_split(df: DataFrame, train_fraction: float = 0.7, seed: int = 42):
    """Seeded random split (depends on the input partitioning)."""
    return tuple(df.randomSplit([train_fraction, 1 - train_fraction], seed))


# ---- features --------------------------------------------------------------------

def select_features(schema: StructType, label: str = ML_LABEL, exclude=ML_EXCLUDED):
    """(numeric, boolean) feature names by type.  Numeric = int or double
    columns except the label and ``exclude``; ``bigint`` is not numeric here."""
    skip = {label, *exclude}
    numeric = [f.name for f in schema.fields
               if isinstance(f.dataType, (IntegerType, DoubleType)) and f.name not in skip]
    boolean = [f.name for f in schema.fields if isinstance(f.dataType, BooleanType)]
    return numeric, boolean


def fit_indexers(df: DataFrame, categorical: list[str], handle_invalid: str = "error") -> list:
    """String indexers fitted on all of ``df`` in one pass (one multi-column
    indexer; most frequent label first, ties alphabetical).
    ``handle_invalid='keep'`` maps labels unseen at fit time to one extra index
    (and so adds one one-hot slot); the default fails on them."""
    if not categorical:
        return []
    return [StringIndexer(inputCols=list(categorical),
                          outputCols=[f"{c}_index" for c in categorical],
                          handleInvalid=handle_invalid).fit(df)]


def mean_imputer(numeric: list[str]) -> Imputer:
    """Nulls and NaN become the column's mean, in place."""
    return Imputer(inputCols=list(numeric), outputCols=list(numeric), strategy="mean")


def one_hot_encoder(categorical: list[str]) -> OneHotEncoder:
    """``<c>_index`` -> ``<c>_encoded``, the last category dropped."""
    return OneHotEncoder(inputCols=[f"{c}_index" for c in categorical],
                         outputCols=[f"{c}_encoded" for c in categorical], dropLast=True)


def feature_stages(df: DataFrame, label: str = ML_LABEL, categorical=ML_CATEGORICAL,
                   exclude=ML_EXCLUDED, include_categorical: bool = False) -> list:
    """Preprocessing stages: mean imputer (in place), numeric and boolean
    assemblers, fitted indexers + one-hot encoders (last category dropped),
    final ``features`` vector = numeric + boolean (+ one-hot when asked)."""
    numeric, boolean = select_features(df.schema, label, exclude)
    stages = []
    if numeric:
        stages.append(mean_imputer(numeric))
        stages.append(VectorAssembler(inputCols=numeric, outputCol="numeric_features"))
    if boolean:
        stages.append(VectorAssembler(inputCols=boolean, outputCol="boolean_features"))
    stages += fit_indexers(df, categorical)
    if categorical:
        stages.append(one_hot_encoder(categorical))
    parts = (["numeric_features"] if numeric else []) + (["boolean_features"] if boolean else [])
    if include_categorical:
        parts += [f"{c}_encoded" for c in categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


# ---- train / evaluate ----------------------------------------------------------------

def train(df: DataFrame, label: str = ML_LABEL, categorical=ML_CATEGORICAL, exclude=ML_EXCLUDED,
          split_keys: list[str] | None = None, train_fraction: float = 0.7, num_trees: int = 10,
          seed: int = 42, include_categorical: bool = False, write_once: bool = True):
    """Fit preprocessing + random forest on the train split, evaluate RMSE on
    the test split.  Returns ``(model, test_predictions, rmse)``.

    With ``split_keys`` the split is the stable hash split, else seeded random.
    ``write_once`` checkpoints the input to the shared folder first, so the
    stages' passes (indexers, imputer, encoder, forest, evaluation) and the
    returned predictions read it instead of recomputing its lineage.  A
    checkpoint keeps the partitions as they were (the forest's sampling
    depends on them)."""
    if write_once:
        df = cut_lineage(df)
    if split_keys:
        tr, te = hash_split(df, split_keys, train_fraction)
    else:
        tr, te = random_split(df, train_fraction, seed)
    stages = feature_stages(df, label, categorical, exclude, include_categorical)
    forest = RandomForestRegressor(featuresCol="features", labelCol=label,
                                   numTrees=num_trees, seed=seed)
    model = Pipeline(stages=stages + [forest]).fit(tr)
    predictions = model.transform(te)
    return model, predictions, rmse_of(predictions, label)


def rmse_of(predictions: DataFrame, label: str = ML_LABEL, prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction,
                               metricName="rmse").evaluate(predictions)


def evaluate(model: PipelineModel, df: DataFrame, label: str = ML_LABEL):
    """Apply a fitted model; returns ``(predictions, rmse)``."""
    predictions = model.transform(df)
    return predictions, rmse_of(predictions, label)


# ---- versions ------------------------------------------------------------------------

def version_now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime(VERSION_FORMAT)


def save_versioned(model: PipelineModel, base: str, version: str | None = None) -> str:
    """Save to ``{base}_v{version}`` (default version: now, UTC); an existing
    version is never overwritten."""
    return save_model(model, f"{base}_v{version or version_now()}")


def list_model_versions(spark: SparkSession, root: str) -> DataFrame:
    """Saved models below ``root``: ``name, version, path`` (one row each),
    found from their metadata files, so any Hadoop file system works."""
    meta = spark.read.text(f"{root.rstrip('/')}/*/metadata/part-*")
    path = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/metadata/part-[^/]*$", 1)
    folder = F.regexp_extract(path, r"([^/]+)$", 1)
    return (meta.select(path.alias("path"), folder.alias("_dir")).distinct()
            .select(F.regexp_extract("_dir", r"^(.*)_v\d+$", 1).alias("name"),
                    F.regexp_extract("_dir", r"_v(\d+)$", 1).alias("version"),
                    "path"))


def latest_model_path(spark: SparkSession, root: str, name: str | None = None,
                      version: str | None = None) -> str | None:
    """Path of the newest version (of ``name`` when given), or of exactly
    ``version`` when given."""
    versions = list_model_versions(spark, root)
    if name is not None:
        versions = versions.where(F.col("name") == name)
    if version is not None:
        versions = versions.where(F.col("version") == version)
    row = versions.agg(F.max(F.struct("version", "path")).alias("m")).first()
    return row["m"]["path"] if row and row["m"] else None


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
