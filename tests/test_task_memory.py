"""What one task holds must not grow with the tables: plans and task counts of the steps that did."""

import pytest
from pyspark.sql import functions as F

from cityzones import bench_queries as bq
from cityzones.operators import sets
from cityzones.operators.sets import dedupe, dedupe_grouped
from cityzones.plans.formatters import format_incidents, format_rent
from cityzones.plans.rejects import format_judged_incidents, judge_incidents
from cityzones.schemas import INCIDENT_FIELDS, RENT_DDL, struct
from cityzones.sources.files import csv_headers
from cityzones.streaming import landing


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_observed_nations_join_each_nation_once(spark, tmp_dir):
    """the join's side has one row per nation, not one per customer."""
    spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "n_nationkey int, n_name string").write.parquet(
        f"{tmp_dir}/nation.parquet")
    spark.createDataFrame([(1, 10)], "s_nationkey int, s_suppkey long").write.parquet(f"{tmp_dir}/supplier.parquet")
    spark.createDataFrame([(1,)] * 50 + [(2,), (None,)], "c_nationkey int").write.parquet(f"{tmp_dir}/customer.parquet")
    found = bq.observed_nations(spark, tmp_dir, "rent")
    assert rows(found) == [(1, "A"), (2, "B")]
    join = found._jdf.queryExecution().optimizedPlan()
    assert "Aggregate" in join.children().apply(1).toString()


def test_headers_are_found_without_sorting_lines(spark, tmp_dir, monkeypatch):
    """no pass over the lines keeps or sorts their texts."""
    for i, head in enumerate(["a,b", "b,a", "a,b"]):
        (spark.createDataFrame([(head,), ("2,1",), ("1,2",)], "value string").coalesce(1)
         .write.mode("append").option("quote", "").text(f"{tmp_dir}/{i}"))
    plans = []
    kind = type(spark.range(1))
    collect = kind.collect

    def noted(self):
        plans.append(executed(self))
        return collect(self)

    monkeypatch.setattr(kind, "collect", noted)
    heads = csv_headers(spark, f"{tmp_dir}/*", "part-*")
    assert {h: len(f) for h, f in heads.items()} == {"a,b": 2, "b,a": 1}
    assert plans and not any("SortAggregate" in p or "Sort [" in p for p in plans)


def test_dedupe_deals_rows_over_the_tasks_asked_for(spark):
    """F2-F6: no aggregate before the exchange, as many tasks as asked for, whatever the session's number."""
    df = spark.createDataFrame(
        [("a", 0.0, ("x", 1)), ("a", -0.0, ("x", 1)), ("a", None, None), ("a", None, None), (None, 1.5, ("x", None)),
         ("b", float("nan"), ("x", 2)), ("b", float("nan"), ("x", 2))], "k string, v double, s struct<t:string,n:int>")
    dealt = dedupe(df, tasks=37)
    assert dealt.rdd.getNumPartitions() == 37
    assert rows(dealt.withColumn("v", F.col("v").cast("string"))) == rows(
        dedupe(df).withColumn("v", F.col("v").cast("string")))
    assert dealt.count() == 4
    plan = executed(dealt).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" not in plan[plan.index("Exchange hashpartitioning"):]


def test_dedupe_of_floats_alone(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,), (None,)], "v double")
    assert dedupe(df, tasks=5).count() == 3


def test_rent_is_compared_in_tasks_of_bounded_size(spark, tmp_dir, monkeypatch):
    """F3."""
    monkeypatch.setattr(sets, "ROWS_PER_TASK", 2)
    raw = (spark.range(60).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in struct(RENT_DDL)],
                                  F.lit(2021).alias("year"), F.lit(1).alias("month"), F.lit(1).alias("day"),
                                  (F.col("id") % 20).cast("string").alias("_code"))
           .withColumns({"neighborhood": F.lit("n"), "propertyCode": F.col("_code")}).drop("_code"))
    raw.write.parquet(tmp_dir)
    lookup = spark.createDataFrame([("n", "7")], "neighborhood string, neighborhood_id string")
    out = format_rent(spark.read.parquet(tmp_dir), lookup)
    assert out.rdd.getNumPartitions() == 30
    assert out.count() == 20


@pytest.mark.parametrize("judged", [False, True])
def test_incidents_are_compared_in_tasks_by_their_splits(spark, tmp_dir, judged):
    """F2, F4-F6."""
    line = spark.range(40).select(*[
        (F.col("id") % 10).cast("string").alias(f) if f == "fitxaID" else F.lit("n").alias(f) for f in INCIDENT_FIELDS])
    line.repartition(5).write.option("header", True).csv(tmp_dir)
    lookup = spark.createDataFrame([("n", "7")], "neighborhood string, neighborhood_id string")
    if judged:
        frame = judge_incidents(spark, tmp_dir, lookup)
        out, splits = format_judged_incidents(frame)[0], frame.rdd.getNumPartitions()
    else:
        raw = bq.read_incidents(spark, tmp_dir)
        out, splits = format_incidents(raw, lookup), raw.rdd.getNumPartitions()
    assert out.rdd.getNumPartitions() == max(4, 8 * splits)
    assert out.count() == 10


def test_first_batch_is_written_once(spark, tmp_dir, monkeypatch):
    """with nothing stored there is nothing to compare, so the batch is not kept beside the table."""
    kept = []
    monkeypatch.setattr(landing, "materialize", lambda df, name: kept.append(name) or df)
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "v string, y int")
    landing.append_new_rows(batch, tmp_dir, ["y"])
    assert kept == []
    landing.append_new_rows(batch.union(spark.createDataFrame([("c", 2)], "v string, y int")), tmp_dir, ["y"])
    assert kept == ["stream-batch"]
    assert rows(spark.read.parquet(tmp_dir)) == [("a", 1), ("b", 2), ("c", 2)]


def test_rows_grouped_by_the_folders_they_are_written_to(spark, tmp_dir, monkeypatch):
    """F1 (round 4): the same rows as dedupe, in tasks of bounded size that hold few folders, after one exchange."""
    monkeypatch.setattr(sets, "ROWS_PER_TASK", 10)
    large = [(str(i % 60), "2020", 1.0) for i in range(90)]  # every other code comes twice
    small = [(c, y, v) for y in ("1999", "x", None) for c, v in (("a", 0.0), ("a", -0.0), (None, None), (None, None))]
    df = spark.createDataFrame(large + small, "code string, year string, price double")
    out = dedupe_grouped(df, ["year"])
    assert out.columns == df.columns and rows(out) == rows(dedupe(df))
    assert out.rdd.getNumPartitions() == 11  # 102 rows
    held = [{r["year"] for r in part} for part in out.rdd.glom().collect()]
    assert sum(map(len, held)) <= 11 + 4  # a folder more than tasks where a task ends within one
    assert executed(out).split("== Initial Plan ==")[0].count("Exchange ") == 2  # one deals rows, one broadcasts places
    out.write.partitionBy("year").parquet(tmp_dir)
    assert spark.read.schema(df.schema).parquet(tmp_dir).count() == 66


def test_rows_grouped_by_several_columns_and_none(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, None, 2.0), (None, 3, 2.0)], "year int, month int, price double")
    assert rows(dedupe_grouped(df, ["year", "month"])) == [(1, None, 2.0), (None, 3, 2.0)]
    assert dedupe_grouped(df.where("price < 0"), ["year"]).collect() == []
    floats = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "v double")
    assert dedupe_grouped(floats, ["v"]).count() == 3


def test_first_incidents_are_shuffled_once(spark, tmp_dir, monkeypatch):
    """F1 (round 4): rows are dealt once, to be compared and written; a later batch is grouped to be written."""
    written = []
    write = landing.write_parquet
    monkeypatch.setattr(landing, "write_parquet", lambda df, *a, **k: written.append((executed(df), k)) or write(df, *a, **k))
    line = spark.range(40).select(*[
        (F.col("id") % 10).cast("string").alias(f) if f == "fitxaID" else F.lit("n").alias(f) for f in INCIDENT_FIELDS])
    lookup = spark.createDataFrame([("n", "7")], "neighborhood string, neighborhood_id string")
    for _ in range(2):
        line.repartition(3).write.mode("append").option("header", True).csv(f"{tmp_dir}/in")
        landing.ingest_incidents(spark, f"{tmp_dir}/in", lookup, f"{tmp_dir}/out", f"{tmp_dir}/c").awaitTermination()
        assert spark.read.parquet(f"{tmp_dir}/out").count() == 10
    (plan, first), (_, later) = written
    assert plan.split("== Initial Plan ==")[0].count("Exchange ") - plan.count("BroadcastExchange ") <= 1
    assert (first["rebalance"], later["rebalance"]) == (False, True)


def test_incident_landing_is_compressed_in_small_files(spark, tmp_dir, monkeypatch):
    """F1 (round 4): compressed files are not cut when read, so they are small; they read as the plain ones do."""
    from cityzones.sources.files import read_csv_columns

    def write(name, rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_dir}/{name}.parquet")

    write("lineitem", [(k, n, 1, 5, "R", "F") for k in range(10) for n in (1, 2, 3)],
          "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_returnflag string, l_linestatus string")
    monkeypatch.setattr(bq, "_t", lambda s, d, t, read=bq._t: (
        read(s, d, t).withColumn("l_shipdate", F.to_timestamp(F.lit("2020-01-02"))) if t == "lineitem" else read(s, d, t)))
    write("supplier", [(1, 3)], "s_suppkey long, s_nationkey int")
    write("nation", [(3, "NATION_3", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("region", [(0, "AFRICA")], "r_regionkey int, r_name string")
    monkeypatch.setattr(bq, "INCIDENT_LINES", 4)
    path = bq.write_incident_landing(spark, tmp_dir)
    lines = spark.read.text(path).groupBy(F.input_file_name().alias("file")).count().collect()
    assert all(r["file"].endswith(".csv.snappy") and r["count"] <= 5 for r in lines)
    assert sum(r["count"] for r in lines) - len(lines) == 36 + 24  # every fifth order twice; two of three lines odd
    raw = bq.read_incidents(spark, path)
    assert raw.count() == bq.read_incidents(spark, path, naive_split=True).count() == 36
    assert raw.distinct().count() == 30
    assert read_csv_columns(spark, path, ["BARRI"]).distinct().collect() == [("NATION 3",)]
