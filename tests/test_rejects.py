"""Dropped rows are counted in the pass that drops them, and can be read."""

import re

from pyspark.sql import functions as F

from cityzones.plans.formatters import format_incidents, format_rent
from cityzones.plans.rejects import (
    INCIDENT_RULES, RENT_RULES, counts_seen, format_judged_incidents, format_judged_rent, judge_incidents, judge_rent,
    reject_counts, rejects)
from cityzones.schemas import INCIDENT_FIELDS, RENT_DDL
from cityzones.sources.files import read_incidents, read_rent
from conftest import rows

NAME = INCIDENT_FIELDS.index("BARRI")


def _lookup(spark):
    return spark.createDataFrame([("n1", "Gran"), ("n2", "Petit")], "neighborhood_id string, neighborhood string")


def _incidents(spark, tmp_dir, names, odd=()):
    def line(i, name):
        return ",".join(name if k == NAME else f"v{i}" for k in range(len(INCIDENT_FIELDS)))
    lines = [",".join(INCIDENT_FIELDS), *[line(i, n) for i, n in enumerate(names)], *odd]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(tmp_dir)
    return tmp_dir


def test_incidents_are_accounted_for(spark, tmp_dir):
    path = _incidents(spark, tmp_dir, ["Gran", "Petit", "", "Nowhere", "Gran"], ["a,b", "x," * 30, "Gran"])
    _incidents(spark, tmp_dir, ["Nowhere"])
    judged = judge_incidents(spark, path, _lookup(spark))
    want = {"accepted": 3, "empty_name": 1, "unknown_name": 2, "field_count": 3}
    assert {r["rule"]: r["rows"] for r in reject_counts(judged).collect()} == want
    formatted, seen = format_judged_incidents(judged)
    got = rows(formatted)
    assert counts_seen(seen, INCIDENT_RULES) == want  # the action above counted them
    assert got == rows(format_incidents(read_incidents(spark, path), _lookup(spark), on_unmatched="drop"))
    table = rejects(judged).collect()
    assert sorted(r["line"] for r in table if r["rule"] == "field_count") == ["Gran", "a,b", "x," * 30]
    assert all((r["line"] is None) == (r["rule"] != "field_count") for r in table)
    assert len({r["file"] for r in table}) == 2 and all(r["file"].endswith(".txt") for r in table)


def test_accounting_reads_the_files_once(spark, tmp_dir):
    path = _incidents(spark, tmp_dir, ["Gran", ""])
    formatted, _ = format_judged_incidents(judge_incidents(spark, path, _lookup(spark)))
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan csv", plan)) == 1 and "CollectMetrics" in plan


def test_no_files_but_a_header(spark, tmp_dir):
    path = _incidents(spark, tmp_dir, [])
    formatted, seen = format_judged_incidents(judge_incidents(spark, path, _lookup(spark)))
    assert formatted.collect() == [] and counts_seen(seen, INCIDENT_RULES) == dict.fromkeys(("accepted", *INCIDENT_RULES), 0)


def test_rent_is_accounted_for(spark, tmp_dir):
    names = ["Gran", None, "Petit", "Nowhere", "Gran", "Gran"]
    df = spark.createDataFrame([(n, str(min(i, 4))) for i, n in enumerate(names)], "neighborhood string, propertyCode string")
    schema = spark.createDataFrame([], RENT_DDL).schema
    full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
    full.write.parquet(f"{tmp_dir}/2021_03_04_listing")
    judged = judge_rent(spark, tmp_dir, _lookup(spark))
    formatted, seen = format_judged_rent(judged)
    got = rows(formatted, "neighborhoodId", "propertyCode", "year", "month", "day")
    assert got == rows(format_rent(read_rent(spark, tmp_dir), _lookup(spark)),
                       "neighborhoodId", "propertyCode", "year", "month", "day")
    assert counts_seen(seen, RENT_RULES) == {"accepted": 4, "no_name": 1, "unknown_name": 1}
    assert {r["rule"] for r in rejects(judged).collect()} == {"no_name", "unknown_name"}
