"""Zone runs end to end on landing files derived from the smallest test tables."""

import pytest

from cityzones import bench_queries as bq
from cityzones.plans import zones
from conftest import rows

SF = "/root/testdata/sf0.001"


def test_zones_end_to_end(spark, tmp_dir):
    lk = bq.write_lookups(spark, SF)
    landing = zones.Landing(
        income=bq.write_income_landing(spark, SF),
        income_districts=lk["income_districts"], income_neighborhoods=lk["income_neighborhoods"],
        rent_root=bq.write_rent_landing(spark, SF),
        rent_districts=lk["rent_districts"], rent_neighborhoods=lk["rent_neighborhoods"],
        incidents=bq.write_incident_landing(spark, SF), incident_lookup=lk["incidents"])
    out = zones.run_formatted_zone(spark, landing, f"{tmp_dir}/formatted")
    assert set(out) == {"income", "rent", "incidents", "neighborhoods"}
    only = zones.run_formatted_zone(spark, landing, f"{tmp_dir}/only", only=["neighborhoods"])
    assert set(only) == {"neighborhoods"}
    with pytest.raises(ValueError):
        zones.run_formatted_zone(spark, landing, f"{tmp_dir}/x", only=["rents"])
    rent = spark.read.parquet(out["rent"])
    assert rent.count() == bq.formatted_rent(spark, SF).count()
    t = zones.exploitation_tables(spark, f"{tmp_dir}/formatted")
    assert set(t) == {"AVGIND", "LISTINGIND", "POPULATION", "NEIGHBORHOODS"}
    assert t["NEIGHBORHOODS"].count() == 25
    assert t["AVGIND"].columns == ["neighborhood", "year", "avg_income", "avg_rent"]
    assert t["LISTINGIND"].count() > 0
    # one rent scan for both tables gives the same tables as the single-use functions
    from cityzones.plans.indicators import avg_indicators, listing_indicators
    f = f"{tmp_dir}/formatted"
    rent, income = spark.read.parquet(f"{f}/rent"), spark.read.parquet(f"{f}/income")
    direct_avg = {(r[0], r[1]): (r[2], r[3]) for r in avg_indicators(income, rent).collect()}
    shared_avg = {(r[0], r[1]): (r[2], r[3]) for r in t["AVGIND"].collect()}
    assert direct_avg.keys() == shared_avg.keys()
    for k, (a, b) in direct_avg.items():
        assert shared_avg[k][0] == a and abs(shared_avg[k][1] - b) <= 1e-9 * abs(b)
    direct_listing = listing_indicators(spark.read.parquet(f"{f}/incidents"), rent)
    assert rows(direct_listing) == rows(t["LISTINGIND"])
    one_year = zones.exploitation_tables(spark, f"{tmp_dir}/formatted", years=[1996])
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        zones.formatted_tables(spark, f"{tmp_dir}/formatted", years=[1996])[1].explain("formatted")
    assert "PartitionFilters: [isnotnull(year" in buf.getvalue()
    assert {r.year for r in one_year["AVGIND"].collect()} <= {1996}
    ds = zones.run_ml_dataset(spark, f"{tmp_dir}/formatted", f"{tmp_dir}/dataset")
    assert spark.read.option("header", True).csv(ds).count() > 0
    path, rmse = zones.run_training(spark, ds, f"{tmp_dir}/models/forest", seed=1, version="20240101000000")
    assert path.endswith("forest_v20240101000000") and rmse > 0
    chosen, rmse2 = zones.run_prediction(spark, ds, f"{tmp_dir}/models")
    assert chosen == path and rmse2 == rmse


def test_cli_dataset_and_predict(spark, tmp_dir, capsys):
    import json

    from cityzones.__main__ import main
    lk = bq.write_lookups(spark, SF)
    landing = {
        "income": bq.write_income_landing(spark, SF),
        "income_districts": lk["income_districts"], "income_neighborhoods": lk["income_neighborhoods"],
        "rent_root": bq.write_rent_landing(spark, SF),
        "rent_districts": lk["rent_districts"], "rent_neighborhoods": lk["rent_neighborhoods"],
        "incidents": bq.write_incident_landing(spark, SF), "incident_lookup": lk["incidents"]}
    cfg = f"{tmp_dir}/landing.json"
    import os
    os.makedirs(cfg.replace("file:", "").rsplit("/", 1)[0], exist_ok=True)
    with open(cfg.replace("file:", ""), "w") as fh:
        json.dump(landing, fh)
    main(["format", "--landing", cfg.replace("file:", ""), "--formatted", f"{tmp_dir}/f"])
    main(["dataset", "--formatted", f"{tmp_dir}/f", "--out", f"{tmp_dir}/ds"])
    main(["train", "--dataset", f"{tmp_dir}/ds", "--model-base", f"{tmp_dir}/m/forest", "--seed", "2"])
    main(["predict", "--dataset", f"{tmp_dir}/ds", "--models", f"{tmp_dir}/m"])
    out = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()[-2:]]
    assert out[0]["model"] == out[1]["model"] and out[0]["rmse"] == out[1]["rmse"]
    main(["ingest", "--landing", cfg.replace("file:", ""), "--formatted", f"{tmp_dir}/inc", "--only", "rent"])
    streamed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(streamed) == {"rent"}
    assert spark.read.parquet(streamed["rent"]).count() == spark.read.parquet(f"{tmp_dir}/f/rent").count()


def test_incident_lookup_runner(spark, tmp_dir):
    from pyspark.sql import functions as F

    from cityzones.schemas import INCIDENT_LOOKUP_DDL
    lk = bq.write_lookups(spark, SF)
    # raw names as the incident files carry them; the district column is raw11 there
    out = zones.run_incident_lookup(spark, bq.write_incident_landing(spark, SF),
                                    lk["income_districts"], lk["income_neighborhoods"],
                                    f"{tmp_dir}/lookup", district_col="raw11")
    got = spark.read.option("header", True).schema(INCIDENT_LOOKUP_DDL).csv(out)
    # every raw spelling "NATION n" maps to nation n, its district to the region
    bad = got.where(F.col("neighborhood_id").isNull() |
                    (F.concat(F.lit("NATION "), F.col("neighborhood_id")) != F.col("neighborhood")))
    assert got.count() > 0 and bad.count() == 0


def test_cli_kpis_exports_four_tables(spark, tmp_dir, monkeypatch):
    """The indicator export end to end; JDBC writer calls are recorded (no database)."""
    import json

    from pyspark.sql.readwriter import DataFrameWriter

    from cityzones.__main__ import main
    lk = bq.write_lookups(spark, SF)
    landing = zones.Landing(
        income=bq.write_income_landing(spark, SF),
        income_districts=lk["income_districts"], income_neighborhoods=lk["income_neighborhoods"],
        rent_root=bq.write_rent_landing(spark, SF),
        rent_districts=lk["rent_districts"], rent_neighborhoods=lk["rent_neighborhoods"],
        incidents=bq.write_incident_landing(spark, SF), incident_lookup=lk["incidents"])
    zones.run_formatted_zone(spark, landing, f"{tmp_dir}/f")
    saved = []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: saved.append(self))
    props = tmp_dir.replace("file:", "") + "-props.json"
    with open(props, "w") as fh:
        json.dump({"user": "u", "password": "p"}, fh)
    main(["kpis", "--formatted", f"{tmp_dir}/f", "--url", "jdbc:postgresql://db.example/kpi",
          "--properties", props, "--years", "1996,1997"])
    assert len(saved) == 4


def test_incremental_zone_matches_batch_zone(spark, tmp_dir):
    lk = bq.write_lookups(spark, SF)
    landing = zones.Landing(
        income=bq.write_income_landing(spark, SF),
        income_districts=lk["income_districts"], income_neighborhoods=lk["income_neighborhoods"],
        rent_root=bq.write_rent_landing(spark, SF),
        rent_districts=lk["rent_districts"], rent_neighborhoods=lk["rent_neighborhoods"],
        incidents=bq.write_incident_landing(spark, SF), incident_lookup=lk["incidents"])
    batch = zones.run_formatted_zone(spark, landing, f"{tmp_dir}/batch", only=["income", "rent", "incidents"])
    inc = zones.run_incremental_zone(spark, landing, f"{tmp_dir}/inc")
    assert set(inc) == set(batch)
    for t in inc:
        a, b = spark.read.parquet(batch[t]), spark.read.parquet(inc[t])
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0, t
    again = zones.run_incremental_zone(spark, landing, f"{tmp_dir}/inc")   # nothing new
    assert spark.read.parquet(again["rent"]).count() == spark.read.parquet(batch["rent"]).count()


def test_batch_then_incremental_on_one_root(spark, tmp_dir):
    """Both runs write one layout: the table of a batch run can be brought up to date and read."""
    lk = bq.write_lookups(spark, SF)
    landing = zones.Landing(
        income=bq.write_income_landing(spark, SF),
        income_districts=lk["income_districts"], income_neighborhoods=lk["income_neighborhoods"],
        rent_root=bq.write_rent_landing(spark, SF),
        rent_districts=lk["rent_districts"], rent_neighborhoods=lk["rent_neighborhoods"],
        incidents=bq.write_incident_landing(spark, SF), incident_lookup=lk["incidents"])
    out = zones.run_formatted_zone(spark, landing, f"{tmp_dir}/one")
    before = {t: spark.read.parquet(p).count() for t, p in out.items()}
    zones.run_incremental_zone(spark, landing, f"{tmp_dir}/one", only=["rent", "incidents"])  # all of it is there
    income, rent, incidents = zones.formatted_tables(spark, f"{tmp_dir}/one")
    assert (rent.count(), incidents.count()) == (before["rent"], before["incidents"])


def test_split_does_not_depend_on_the_partitioning(spark, tmp_dir):
    from cityzones.plans.ml import hash_split, load_dataset
    from cityzones.schemas import ML_SPLIT_KEYS
    from cityzones.sources.sinks import write_csv
    ds = bq.dataset(spark, SF)
    parts = []
    for n in (1, 7):
        df = load_dataset(spark, write_csv(ds.repartition(n), f"{tmp_dir}/ds{n}"))
        parts.append(rows(hash_split(df, ML_SPLIT_KEYS)[1]))
    assert parts[0] == parts[1] and 0 < len(parts[0]) < ds.count()
