
from cityzones.streaming import ingest_rent
from conftest import rows


def test_incremental_rent_ingestion_is_idempotent(spark, tmp_dir):
    lookup = spark.createDataFrame([("N1", "Raval"), ("N2", "Gotic")], "neighborhood_id string, neighborhood string")
    df = spark.createDataFrame([("p1", "Raval", 1.0), ("p1", "Raval", 1.0), ("p2", "Gotic", 2.0),
                                ("p3", "Nowhere", 3.0)],
                               "propertyCode string, neighborhood string, price double")
    landing, out, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/rent", f"{tmp_dir}/ckpt"
    df.write.parquet(f"{landing}/2020_01_05_a")
    ingest_rent(spark, landing, lookup, out, ckpt).awaitTermination()
    assert rows(spark.read.parquet(out), "propertyCode", "year", "month", "day", "neighborhoodId") == [
        ("p1", 2020, 1, 5, "N1"), ("p2", 2020, 1, 5, "N2")]
    # a new snapshot plus a re-delivered copy of an old file in a new folder
    df.where("propertyCode = 'p2'").write.parquet(f"{landing}/2020_02_01_a")
    df.where("propertyCode = 'p1'").write.parquet(f"{landing}/2020_01_05_b")
    ingest_rent(spark, landing, lookup, out, ckpt).awaitTermination()
    got = rows(spark.read.parquet(out), "propertyCode", "year", "month", "day")
    assert got == [("p1", 2020, 1, 5), ("p2", 2020, 1, 5), ("p2", 2020, 2, 1)]
    # nothing new: a rerun adds nothing
    ingest_rent(spark, landing, lookup, out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_incremental_income_and_incidents(spark, tmp_dir):
    from cityzones import bench_queries as bq
    from cityzones.plans.formatters import format_incidents, format_income
    from cityzones.sources.files import read_incidents, read_income
    from cityzones.sources.lookups import incident_lookup, income_lookup
    from cityzones.streaming import ingest_incidents, ingest_income
    sf = "/root/testdata/sf0.001"
    lk = bq.write_lookups(spark, sf)
    inc_lk = income_lookup(spark, lk["income_districts"], lk["income_neighborhoods"])
    income_landing = bq.write_income_landing(spark, sf)
    ingest_income(spark, income_landing, inc_lk, f"{tmp_dir}/income").awaitTermination()
    want = format_income(read_income(spark, income_landing), inc_lk)
    got = spark.read.parquet(f"{tmp_dir}/income").select(*want.columns)
    assert rows(got) == rows(want)
    ir_lk = incident_lookup(spark, lk["incidents"])
    incident_landing = bq.write_incident_landing(spark, sf)
    ingest_incidents(spark, incident_landing, ir_lk, f"{tmp_dir}/incidents").awaitTermination()
    want = format_incidents(read_incidents(spark, incident_landing), ir_lk)
    got = spark.read.parquet(f"{tmp_dir}/incidents").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_replayed_batch_adds_nothing(spark, tmp_dir):
    """A batch written but not committed is replayed after a crash: the
    second append of the same rows (nulls and nested values included) is a no-op."""
    from cityzones.streaming import append_new_rows
    batch = spark.createDataFrame(
        [("p1", None, 1.0, (None, "t"), 2020), ("p2", "Raval", None, None, 2020),
         ("p3", "Gotic", 3.0, ("s", None), 2021)],
        "code string, name string, price double, dt struct<a:string, b:string>, year int")
    out = f"{tmp_dir}/replay"
    append_new_rows(batch, out, ["year"])
    append_new_rows(batch, out, ["year"])          # replay
    assert spark.read.parquet(out).count() == 3
    more = spark.createDataFrame([("p4", "Sants", 4.0, None, 2021)], batch.schema)
    append_new_rows(batch.unionByName(more), out, ["year"])
    assert spark.read.parquet(out).count() == 4


def test_incidents_with_a_year_that_is_no_number(spark, tmp_dir):
    import os

    from cityzones.schemas import INCIDENT_FIELDS
    from cityzones.streaming import ingest_incidents
    lookup = spark.createDataFrame([("N1", "Raval")], "neighborhood_id string, neighborhood string")
    landing = f"{tmp_dir}/incidents-landing"
    os.makedirs(landing.replace("file:", ""))

    def land(name, year, extra=""):
        values = {"fitxaID": name, "BARRI": "Raval", "anyDataAlta": year}
        with open(f"{landing.replace('file:', '')}/{name}.csv", "w") as fh:
            fh.write(",".join(INCIDENT_FIELDS) + "\n")
            fh.write(",".join(values.get(f, "x") for f in INCIDENT_FIELDS) + extra + "\n")

    for naive in (False, True):
        out, ckpt = f"{tmp_dir}/out{naive}", f"{tmp_dir}/ckpt{naive}"
        land("a", "2020")
        ingest_incidents(spark, landing, lookup, out, ckpt, naive_csv=naive).awaitTermination()
        land("b", "unknown")
        land("c", "2021", ",one field too many")
        ingest_incidents(spark, landing, lookup, out, ckpt, naive_csv=naive).awaitTermination()
        got = spark.read.schema("fitxaID string, anyDataAlta string").parquet(out)
        assert rows(got, "fitxaID", "anyDataAlta") == [("a", "2020"), ("b", "unknown")]
        for name in "abc":
            os.remove(f"{landing.replace('file:', '')}/{name}.csv")


def test_append_reads_only_the_touched_partitions(spark, tmp_dir):
    from cityzones.streaming.landing import _existing
    out = f"{tmp_dir}/touched"
    df = spark.createDataFrame([("a", 2020), ("b", 2021)], "code string, year int")
    df.write.partitionBy("year").parquet(out)
    assert _existing(spark, f"{tmp_dir}/nowhere", df.schema) is None
    plan = _existing(spark, out, df.schema).where("year <=> 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(year" in plan or "PartitionFilters: [isnotnull(year" in plan
