"""Formatters over small hand-written landing files (edge cases of FIXTURES.md section 5)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cityzones.plans.formatters import format_incidents, format_income, format_rent, neighborhood_dim
from cityzones.sources.files import read_incidents, read_income, read_rent
from cityzones.sources.lookups import incident_lookup, income_lookup, rent_lookup
from conftest import rows


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def write_lines(path, name, lines):
    d = _local(path)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


@pytest.fixture()
def lookups(spark, tmp_dir):
    dist = [{"_id": "D1", "district": "Ciutat Vella", "district_name": "ciutat vella",
             "district_reconciled": "Ciutat Vella", "neighborhood_id": ["N1", "N2"]},
            {"_id": "D2", "district": "Gràcia", "district_name": "gracia",
             "district_reconciled": "Gràcia", "neighborhood_id": ["N3"]}]
    neigh = [{"_id": "N1", "neighborhood": "el Raval", "neighborhood_name": "el raval",
              "neighborhood_reconciled": "El Raval"},
             {"_id": "N2", "neighborhood": '"el Gòtic"', "neighborhood_name": "el gotic",
              "neighborhood_reconciled": "Barri Gòtic"},
             {"_id": "N3", "neighborhood": "la Salut", "neighborhood_name": "la salut",
              "neighborhood_reconciled": "La Salut"}]
    write_lines(f"{tmp_dir}/inc_d", "d.json", [json.dumps(x, ensure_ascii=False) for x in dist])
    write_lines(f"{tmp_dir}/inc_n", "n.json", [json.dumps(x, ensure_ascii=False) for x in neigh])
    rdist = [{"_id": "D1", "di": "Ciutat Vella", "di_n": "ciutat vella", "di_re": "Ciutat Vella",
              "ne_id": ["N1", "N2"]}]
    rneigh = [{"_id": "N1", "ne": "Raval", "ne_n": "raval", "ne_re": "\"Raval, Barcelona\""},
              {"_id": "N2", "ne": "Gotic", "ne_n": "gotic", "ne_re": "Gòtic"}]
    write_lines(f"{tmp_dir}/rent_d", "d.json", [json.dumps(x, ensure_ascii=False) for x in rdist])
    write_lines(f"{tmp_dir}/rent_n", "n.json", [json.dumps(x, ensure_ascii=False) for x in rneigh])
    write_lines(f"{tmp_dir}/incident_lk", "lk.csv", [
        "neighborhood_id,neighborhood_n_reconciled,neighborhood,district_id,district_n_reconciled,district",
        "N1,El Raval,el Raval,D1,Ciutat Vella,Ciutat Vella",
        'N2,"Gòtic, el, Barcelona",el Barri Gòtic,D1,Ciutat Vella,Ciutat Vella',
        "N2,Gòtic,Barri Gotic,D1,Ciutat Vella,Ciutat Vella",
        "N3,Salut,la Salut,D2,Gràcia,Gràcia",
    ])
    return {
        "income": income_lookup(spark, f"{tmp_dir}/inc_d", f"{tmp_dir}/inc_n"),
        "rent": rent_lookup(spark, f"{tmp_dir}/rent_d", f"{tmp_dir}/rent_n"),
        "incidents": incident_lookup(spark, f"{tmp_dir}/incident_lk"),
        "incidents_naive": incident_lookup(spark, f"{tmp_dir}/incident_lk", naive_split=True),
    }


def test_income_formatter(spark, tmp_dir, lookups):
    def obj(i, name, info):
        return json.dumps({"_id": i, "neigh_name ": name, "district_id": "D1",
                           "district_name": "Ciutat Vella", "info": info}, ensure_ascii=False)
    two = [{"year": 2019, "pop": 100, "RFD": 80.5}, {"year": 2020, "pop": 110, "RFD": 82.0}]
    path = write_lines(f"{tmp_dir}/income", "i.json", [
        obj("a", "el Raval", two), obj("a", "el Raval", two),   # full duplicate line
        obj("b", "el Gòtic", []),                                 # empty info
        obj("c", "la Salut", [{"year": 2020, "pop": 5, "RFD": 60.0}]),
    ])
    out = format_income(read_income(spark, path), lookups["income"])
    assert out.columns == ["id", "year", "population", "RFD", "neighborhood_id"]
    assert rows(out) == [("2019_N1", 2019, 100, 80.5, "N1"), ("2020_N1", 2020, 110, 82.0, "N1"),
                         ("2020_N3", 2020, 5, 60.0, "N3")]
    bad = write_lines(f"{tmp_dir}/income_bad", "i.json",
                      [obj("x", "Nowhere", [{"year": 2020, "pop": 1, "RFD": 1.0}])])
    with pytest.raises(Exception, match="no entry in the lookup"):
        format_income(read_income(spark, bad), lookups["income"]).collect()
    assert format_income(read_income(spark, bad), lookups["income"], on_unmatched="drop").count() == 0
    kept = format_income(read_income(spark, bad), lookups["income"], on_unmatched="keep").first()
    assert kept["neighborhood_id"] is None and kept["id"] is None
    missing = write_lines(f"{tmp_dir}/income_missing", "i.json", [json.dumps(
        {"_id": "m", "neigh_name ": "el Raval", "district_name": "x",
         "info": [{"year": 2020, "pop": 1, "RFD": 1.0}]})])
    with pytest.raises(Exception, match="district_id must not be null"):
        format_income(read_income(spark, missing), lookups["income"]).collect()


def test_rent_formatter(spark, tmp_dir, lookups):
    rows_in = [("p1", "Raval", 1000.0), ("p1", "Raval", 1000.0), ("p2", None, 900.0),
               ("p3", "Unknown", 800.0), ("p4", "Gotic", 700.0)]
    df = spark.createDataFrame(rows_in, "propertyCode string, neighborhood string, price double")
    df = df.withColumn("detailedType", F.struct(F.lit("flat").alias("typology"),
                                                F.lit(None).cast("string").alias("subTypology")))
    df.write.parquet(f"{tmp_dir}/rent/2020_01_05_listings")
    df.where("propertyCode = 'p1'").write.parquet(f"{tmp_dir}/rent/2021_02_07_listings")
    raw = read_rent(spark, f"{tmp_dir}/rent")
    assert len(raw.columns) == 40
    out = format_rent(raw, lookups["rent"])
    assert len(out.columns) == 41
    got = rows(out, "propertyCode", "year", "month", "day", "neighborhoodId", "price")
    assert got == [("p1", 2020, 1, 5, "N1", 1000.0), ("p1", 2021, 2, 7, "N1", 1000.0),
                   ("p4", 2020, 1, 5, "N2", 700.0)]
    assert out.first()["detailedType"]["typology"] == "flat"
    df.write.parquet(f"{tmp_dir}/rent_bad/latest")
    with pytest.raises(Exception, match="snapshot folder"):
        read_rent(spark, f"{tmp_dir}/rent_bad").collect()
    from cityzones.sources.files import read_snapshots
    from cityzones.schemas import RENT_DDL
    lenient = read_snapshots(spark, f"{tmp_dir}/rent_bad", RENT_DDL, strict_dates=False)
    assert {r.year for r in lenient.collect()} == {None}
    only_2021 = read_rent(spark, f"{tmp_dir}/rent", folders="2021_*")
    assert rows(only_2021, "propertyCode", "year") == [("p1", 2021), ("p1", 2021)]  # raw, not deduped


INCIDENT_HEADER = ",".join(f"h{i}" for i in range(25))


def incident_line(fid, typ, name, day="05", n=25):
    fields = [fid, typ, "area", "el", "det", day, "03", "2021", "", "", "", "x", "y", "z", name]
    fields += [f"f{i}" for i in range(15, 25)]
    return ",".join(fields[:n]) if n <= 25 else ",".join(fields + ["extra"] * (n - 25))


def test_incident_formatter(spark, tmp_dir, lookups):
    path = f"{tmp_dir}/incidents"
    write_lines(path, "a.csv", [
        INCIDENT_HEADER,
        incident_line("1", "INCIDENCIA", "el Raval"),
        incident_line("1", "INCIDENCIA", "el Raval"),          # duplicate
        incident_line("2", "INCIDENCIA", '"Barri Gotic"'),      # quoted
        incident_line("3", "CONSULTA", ""),                     # empty name
        incident_line("4", "INCIDENCIA", "la Salut", n=24),    # short row
        incident_line("5", "INCIDENCIA", "la Salut", n=26),    # long row
    ])
    write_lines(path, "b.csv", [INCIDENT_HEADER, incident_line("6", "INCIDENCIA", "la Salut")])
    out = format_incidents(read_incidents(spark, path), lookups["incidents"])
    assert out.columns[0] == "neighborhoodID" and len(out.columns) == 22
    assert "BARRI" not in out.columns and "raw11" not in out.columns
    assert rows(out, "fitxaID", "neighborhoodID") == [("1", "N1"), ("2", "N2"), ("6", "N3")]
    naive = format_incidents(read_incidents(spark, path, naive_split=True), lookups["incidents_naive"])
    assert rows(naive, "fitxaID", "neighborhoodID") == [("1", "N1"), ("2", "N2"), ("6", "N3")]


def test_incident_lookup_dialects(spark, lookups):
    # real CSV parsing keeps the row with two quoted commas; the naive split
    # (patch removes only the first one) gets 7 fields and drops it
    assert lookups["incidents"].count() == 4
    assert lookups["incidents_naive"].count() == 3
    assert lookups["incidents"].columns == ["neighborhood_id", "neighborhood", "neighborhood_reconciled",
                                       "district_id", "district", "district_reconciled"]


def test_neighborhood_dimension_priority(spark, lookups):
    dim = neighborhood_dim(lookups["income"], lookups["incidents"], lookups["rent"])
    got = {r["neighborhood_id"]: r["neighborhood_reconciled"] for r in dim.collect()}
    # income wins over incidents and rent; every id once
    assert got == {"N1": "El Raval", "N2": "Barri Gòtic", "N3": "La Salut"}
    only_rent = neighborhood_dim(lookups["income"].limit(0), lookups["incidents"].limit(0), lookups["rent"])
    assert {r["neighborhood_reconciled"] for r in only_rent.collect()} == {"Raval, Barcelona", "Gòtic"}
