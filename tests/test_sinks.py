"""Sinks.  The JDBC sink is checked by recording the writer calls: no database
is started or contacted."""

from pyspark.sql.readwriter import DataFrameWriter

from cityzones.plans.indicators import export_indicators
from cityzones.sources.sinks import write_csv, write_jdbc, write_parquet


class Recorder:
    def __init__(self):
        self.calls = []


def _patch(monkeypatch):
    rec = Recorder()

    def fmt(self, source):
        rec.calls.append(("format", source))
        return self

    def option(self, key, value):
        rec.calls.append(("option", key, value))
        return self

    def mode(self, m):
        rec.calls.append(("mode", m))
        return self

    def save(self, path=None, **kw):
        rec.calls.append(("save",))

    monkeypatch.setattr(DataFrameWriter, "format", fmt)
    monkeypatch.setattr(DataFrameWriter, "option", option)
    monkeypatch.setattr(DataFrameWriter, "mode", mode)
    monkeypatch.setattr(DataFrameWriter, "save", save)
    return rec


def test_write_jdbc_passes_url_table_properties_and_mode(spark, monkeypatch):
    rec = _patch(monkeypatch)
    df = spark.range(3)
    write_jdbc(df, "jdbc:postgresql://db.example:5432/kpi", "AVGIND",
               {"user": "u", "password": "p", "driver": "org.postgresql.Driver"}, mode="append",
               batch_size=500)
    opts = {c[1]: c[2] for c in rec.calls if c[0] == "option"}
    assert ("format", "jdbc") in rec.calls and ("mode", "append") in rec.calls
    assert opts == {"url": "jdbc:postgresql://db.example:5432/kpi", "dbtable": "AVGIND", "user": "u",
                    "password": "p", "driver": "org.postgresql.Driver", "batchsize": 500}
    assert rec.calls[-1] == ("save",)


def test_export_indicators_writes_every_table(spark, monkeypatch):
    rec = _patch(monkeypatch)
    tables = {"AVGIND": spark.range(1), "LISTINGIND": spark.range(1), "POPULATION": spark.range(1),
              "NEIGHBORHOODS": spark.range(1)}
    export_indicators(tables, "jdbc:x", {"user": "u"})
    written = [c[2] for c in rec.calls if c[0] == "option" and c[1] == "dbtable"]
    assert written == ["AVGIND", "LISTINGIND", "POPULATION", "NEIGHBORHOODS"]
    assert rec.calls.count(("mode", "overwrite")) == 4 and rec.calls.count(("save",)) == 4


def test_parquet_partitioned_and_csv_folder(spark, tmp_dir):
    import glob
    df = spark.range(200).selectExpr("id", "cast(id % 3 as int) as y")
    path = write_parquet(df.repartition(8), f"{tmp_dir}/p", partition_by=["y"])
    back = spark.read.parquet(path)
    assert back.count() == 200 and sorted(r.y for r in back.select("y").distinct().collect()) == [0, 1, 2]
    # rebalanced by the partition column: a few files per folder, not one per input task
    files = glob.glob(path.replace("file:", "") + "/y=*/*.parquet")
    assert len(files) <= 6
    folder = write_csv(df.repartition(5), f"{tmp_dir}/c")
    assert len(glob.glob(folder.replace("file:", "") + "/*.csv")) == 5
    assert spark.read.option("header", True).csv(folder).count() == 200
