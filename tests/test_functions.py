import pytest
from pyspark.sql import functions as F

from cityzones.functions import (
    normalize_name, patch_quoted_comma, remove_char, require_not_null, split_fields,
    strip_char_all, surrogate_key, to_int, version_string,
)


def one(spark, col, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


def test_remove_and_strip_quotes(spark):
    assert one(spark, remove_char("v"), 'say "hi" "x"') == "say hi x"
    assert one(spark, strip_char_all(split_fields("v")), '"a","b"c",d') == ["a", 'b"c', "d"]


def test_split_keeps_trailing_empty_fields(spark):
    assert one(spark, split_fields("v"), "a,,b,,") == ["a", "", "b", "", ""]
    assert one(spark, F.size(split_fields("v")), "a.b,c") == 2  # separator is literal


def test_quoted_comma_patch(spark):
    # first comma after the first quote and the last quote of the line go away
    assert one(spark, patch_quoted_comma("v"), 'Q1,"Horta, Barcelona",Horta') == 'Q1,"Horta Barcelona,Horta'
    two = one(spark, F.size(split_fields(patch_quoted_comma("v"))), 'a,"x, y","p, q",z')
    assert two == 5  # a | "x y" | "p | q | z: the second quoted comma survives


def test_normalize_name(spark):
    assert one(spark, normalize_name("v"), "Sarrià-Sant Gervasi") == "sarria sant gervasi"
    assert one(spark, normalize_name("v"), "La Nova Esquerra de l'Eixample") == "la nova esquerra de l eixample"
    assert one(spark, normalize_name("v"), "  el Poble-sec -- AEI  ") == "el poble sec aei"


def test_to_int(spark):
    assert one(spark, to_int("v"), " 07 ") == 7
    assert one(spark, to_int("v"), None) is None
    assert one(spark, to_int("v", strict=False), "x1") is None
    for bad in ("", "x1", "1.5"):
        with pytest.raises(Exception, match="not an integer"):
            one(spark, to_int("v"), bad)


def test_surrogate_key_and_version(spark):
    df = spark.createDataFrame([(2020, "Q1"), (2021, None)], "y int, id string")
    got = [r["k"] for r in df.select(surrogate_key("y", "id").alias("k")).collect()]
    assert got == ["2020_Q1", None]
    ts = spark.createDataFrame([("2024-03-05 07:08:09",)], "s string").select(
        version_string(F.to_timestamp("s")).alias("v")).first()["v"]
    assert ts == "20240305070809"


def test_require_not_null(spark):
    ok = spark.createDataFrame([("a", 1)], "k string, y int")
    assert require_not_null(ok, ["k", "y"]).collect()[0]["k"] == "a"
    bad = spark.createDataFrame([(None, 1)], "k string, y int")
    with pytest.raises(Exception, match="must not be null"):
        require_not_null(bad, ["k"]).collect()


def test_normalize_name_invariants(spark):
    import random
    import re
    rnd = random.Random(5)
    alphabet = "abcXYZ019 -_'.,àÉïÒüçÑß·\\t\"/()ŁøΩ"
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 24))) for _ in range(500)]
    df = spark.createDataFrame([(w,) for w in words], "v string")
    out = df.select(normalize_name("v").alias("n")).select("n", normalize_name("n").alias("nn"))
    pattern = re.compile(r"^([a-z0-9]+( [a-z0-9]+)*)?$")
    for r in out.collect():
        assert pattern.match(r["n"]), r["n"]
        assert r["nn"] == r["n"]          # idempotent
