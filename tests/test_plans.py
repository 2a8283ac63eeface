"""Physical-plan checks: shuffles, broadcasts, pushdown, no Python on the data path."""

import contextlib
import io

import pytest

from cityzones import bench_queries as bq

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_avg_indicators_one_exchange_per_side(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from cityzones.plans.indicators import avg_indicators
        inc = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
            "cast(l_suppkey as string) as neighborhood_id", "year(l_shipdate) as year",
            "l_extendedprice as RFD")
        rent = spark.read.parquet(f"{SF}/orders.parquet").selectExpr(
            "cast(o_custkey as string) as neighborhoodId", "year(o_orderdate) as year",
            "o_totalprice as price")
        p = plan(avg_indicators(inc, rent), "simple")
        # one hash exchange per aggregated side; the join reuses them
        assert p.count("Exchange hashpartitioning") == 2
        assert p.count("partial_avg") == 2
        assert "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reconcile_broadcasts_lookup_and_pushes_filters(spark):
    df = bq.formatted_rent(spark, SF)
    p = plan(df, "formatted")
    assert "BroadcastHashJoin" in p
    assert "PushedFilters: [IsNotNull(neighborhood)" in p


def test_scan_prunes_columns(spark):
    p = plan(bq.income_rows(spark, SF), "formatted")
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


@pytest.mark.parametrize("name", ["avg_indicators", "listing_indicators", "format_income",
                                  "format_incidents", "neighborhood_dim", "reconcile_names",
                                  "ml_dataset", "first_per_key", "distinct_rows"])
def test_no_python_on_data_path(spark, name):
    p = plan(bq.QUERIES[name](spark, SF), "simple")
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF"):
        assert node not in p


def test_first_per_key_has_no_window(spark):
    p = plan(bq.QUERIES["first_per_key"](spark, SF), "simple")
    assert "Window" not in p and "partial_min" in p


@pytest.mark.parametrize("name", ["avg_indicators", "listing_indicators", "population", "format_income",
                                  "format_rent", "format_incidents", "format_incidents_naive",
                                  "neighborhood_dim", "ml_dataset", "reconcile_names",
                                  "incident_lookup_build", "first_per_key", "distinct_rows",
                                  "unmatched_keys", "explode_structs", "explode_ids"])
def test_no_single_partition_funnel(spark, name):
    """No plan routes all rows through one task (single-partition exchange,
    global sort) or gathers a group in one task (window)."""
    p = plan(bq.QUERIES[name](spark, SF), "simple")
    assert "Exchange SinglePartition" not in p
    assert "Window" not in p and "rangepartitioning" not in p


@pytest.mark.parametrize("name", ["format_income", "format_incidents", "format_incidents_naive",
                                  "reconcile_left", "reconcile_inner"])
def test_reconcile_joins_broadcast_the_lookup(spark, name):
    """J2-J4: the bounded lookup is broadcast; the raw rows are not shuffled for it."""
    p = plan(bq.QUERIES[name](spark, SF), "simple")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
