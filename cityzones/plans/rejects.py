"""Formatters that account for every row they drop.

A row is judged once: ``rule`` names the first rule that rejects it, null means
accepted.  The formatted table is made of the accepted rows; the same pass counts
the rows of each rule (``DataFrame.observe``), and the rejected rows can be read
as a table with the rule and the file they came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cityzones.operators.reconcile import reconcile
from cityzones.operators.sets import dedupe, tasks_for_rows, tasks_for_splits
from cityzones.schemas import INCIDENT_DROPPED, INCIDENT_FIELDS, INCIDENT_NAME_FIELD, RENT_COLUMNS, RENT_DDL
from cityzones.sources.files import path_date_columns, read_csv_marked

INCIDENT_RULES = ("field_count", "empty_name", "unknown_name")
RENT_RULES = ("no_name", "unknown_name")


def counted(judged: DataFrame, rules: tuple[str, ...], name: str) -> tuple[DataFrame, Observation]:
    """``judged`` with an observation of its rows per rule, and of ``accepted`` ones.

    ``counts_seen`` waits for the first action on the frame and costs no pass of its own.  The counts are those of
    that action: take them from one that reads the frame to its end.  A stage that runs again after a lost executor
    may be counted again; ``reject_counts`` over the table is exact then too."""
    observation = Observation(name)
    counts = [F.count_if(F.col("rule") == r).alias(r) for r in rules]
    return judged.observe(observation, F.count_if(F.col("rule").isNull()).alias("accepted"), *counts), observation


def counts_seen(observation: Observation, rules: tuple[str, ...]) -> dict[str, int]:
    """``observation.get`` with zeros where the planner found the input empty and so ran no pass that counts."""
    if observation._jo.getRow().length() == 0:
        return dict.fromkeys(("accepted", *rules), 0)
    return observation.get


def reject_counts(judged: DataFrame) -> DataFrame:
    """Rows (``rule``, ``rows``); ``accepted`` for those no rule rejects."""
    return judged.groupBy(F.coalesce("rule", F.lit("accepted")).alias("rule")).agg(F.count(F.lit(1)).alias("rows"))


def rejects(judged: DataFrame) -> DataFrame:
    """The rejected rows: ``rule``, ``file``, ``line`` (the raw line where it could not be split), then the fields."""
    first = ["rule", "file", "line"]
    return judged.where(F.col("rule").isNotNull()).select(*first, *[c for c in judged.columns if c not in first])


def _no_id(name: str, out: str, empty: Column, rule: str) -> Column:
    return F.when(F.col(name).isNull() | empty, rule).when(F.col(out).isNull(), "unknown_name")


def judge_incidents(spark: SparkSession, path: str, lookup: DataFrame) -> DataFrame:
    """Every line of the incident files: the fields, ``neighborhoodID``, ``file``, ``line`` and ``rule``."""
    raw = read_csv_marked(spark, path, INCIDENT_FIELDS)
    matched = reconcile(raw, lookup, INCIDENT_NAME_FIELD, out="neighborhoodID", on_unmatched="keep")
    name = _no_id(INCIDENT_NAME_FIELD, "neighborhoodID", F.col(INCIDENT_NAME_FIELD) == "", "empty_name")
    return matched.withColumn("rule", F.when(F.col("line").isNotNull(), "field_count").otherwise(name))


def format_judged_incidents(judged: DataFrame) -> tuple[DataFrame, Observation]:
    """What ``format_incidents(on_unmatched='drop')`` gives, and the counts of what it drops."""
    tasks = tasks_for_splits(judged)
    judged, observation = counted(judged, INCIDENT_RULES, "incidents")
    kept = dedupe(judged.where(F.col("rule").isNull()).select("neighborhoodID", *INCIDENT_FIELDS), tasks)
    return kept.select("neighborhoodID", *[f for f in INCIDENT_FIELDS if f not in INCIDENT_DROPPED]), observation


def judge_rent(spark: SparkSession, root: str, lookup: DataFrame, folders: str = "*") -> DataFrame:
    """Every listing of the snapshots: the fields, its date, ``neighborhoodId``, ``file``, ``line`` (null), ``rule``."""
    raw = spark.read.schema(RENT_DDL).parquet(f"{root.rstrip('/')}/{folders}/part-*")
    raw = path_date_columns(raw.select(*RENT_COLUMNS, F.col("_metadata.file_path").alias("file")), "file")
    matched = reconcile(raw, lookup, "neighborhood", out="neighborhoodId", on_unmatched="keep")
    rule = _no_id("neighborhood", "neighborhoodId", F.lit(False), "no_name")
    return matched.withColumns({"line": F.lit(None).cast("string"), "rule": rule})


def format_judged_rent(judged: DataFrame) -> tuple[DataFrame, Observation]:
    """What ``format_rent`` gives, and the counts of what it drops."""
    tasks = tasks_for_rows(judged.count())
    judged, observation = counted(judged, RENT_RULES, "rent")
    kept = judged.where(F.col("rule").isNull())
    return dedupe(kept.select(*RENT_COLUMNS, "year", "month", "day", "neighborhoodId"), tasks), observation
