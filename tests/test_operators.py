import pytest
from pyspark.sql import functions as F

from cityzones.operators.aggregates import first_per_key, rmse
from cityzones.operators.filters import drop_incomplete, field_count_is, non_empty, not_null
from cityzones.operators.generators import explode_structs, explode_values
from cityzones.operators.joins import join_measured
from cityzones.operators.projections import flatten_structs
from cityzones.operators.reconcile import build_lookup, reconcile, reconcile_names, unmatched_keys
from cityzones.operators.sets import dedupe, union_all
from conftest import rows


def test_filters(spark):
    df = spark.createDataFrame([("a", 1.0), ("", None), (None, float("nan"))], "s string, x double")
    assert rows(not_null(df, "s"), "s") == [("",), ("a",)]
    assert rows(non_empty(df, "s"), "s") == [("a",)]
    assert rows(drop_incomplete(df), "s") == [("a",)]  # null and NaN both dropped
    lines = spark.createDataFrame([("a,b",), ("a,b,",), ("a",)], "line string")
    assert rows(field_count_is(lines, "line", 2)) == [("a,b",)]


def test_explode_structs_empty_array_gives_no_row(spark):
    df = spark.createDataFrame(
        [("n1", [(2019, 10, 1.5), (2020, 11, 2.5)]), ("n2", [])],
        "id string, info array<struct<year:int, pop:bigint, RFD:double>>")
    out = explode_structs(df, "info", ["id"], ["year", "pop"], {"pop": "population"})
    assert out.columns == ["id", "year", "population"]
    assert rows(out) == [("n1", 2019, 10), ("n1", 2020, 11)]
    ids = spark.createDataFrame([("d1", ["a", "b"]), ("d2", [])], "d string, ids array<string>")
    assert rows(explode_values(ids, "ids", ["d"], "id")) == [("a", "d1"), ("b", "d1")]


def test_dedupe_nested_with_nulls(spark):
    df = spark.createDataFrame(
        [(1, ("x", None)), (1, ("x", None)), (1, ("x", "y")), (1, None), (1, None)],
        "k int, s struct<a:string, b:string>")
    assert dedupe(df).count() == 3
    flat = flatten_structs(dedupe(df))
    assert flat.columns == ["k", "s_a", "s_b"]


def test_union_all_tags(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert rows(union_all([a, b], "src")) == [(1, 0), (2, 1)]


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("j", 5, "q")],
                               "id string, pri int, name string")
    out = first_per_key(df, ["id"], ["pri", "name"], ["name"])
    assert rows(out) == [("j", "q"), ("k", "a")]


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "y double, p double")
    assert rmse(df, "y", "p").first()["rmse"] == pytest.approx((0.5) ** 0.5)


def _hot(spark):
    # one key holds most rows (skew)
    big = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.col("id"))
    small = spark.createDataFrame([("hot", "H"), ("0", "Z"), ("1", "O")], "key string, v string")
    return big, small


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_measured_equals_plain_join(spark, how):
    big, small = _hot(spark)
    got = join_measured(big, small, ["k"], ["key"], how)
    assert got.columns == big.columns + small.columns
    assert rows(got.select("id", "v")) == rows(big.join(small, big.k == small.key, how).select("id", "v"))


def test_join_measured_broadcasts_by_size_alone(spark):
    big, small = _hot(spark)
    plan = _plan(join_measured(big, small, ["k"], ["key"]))
    assert "BroadcastHashJoin" in plan and plan.count("Range (") == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        wide = join_measured(big, small, ["k"], ["key"])
        assert "SortMergeJoin" in _plan(wide) and _plan(wide).count("Range (") == 1  # one scan of the big side
        want = rows(wide.select("id", "v"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert want == rows(join_measured(big, small, ["k"], ["key"]).select("id", "v"))


def _lookup(spark):
    d = spark.createDataFrame([("D1", "Dist", "dist", '"Dist"', ["N1", "N2"])],
                              "_id string, district string, district_name string, "
                              "district_reconciled string, neighborhood_id array<string>")
    n = spark.createDataFrame([("N1", 'el "Raval"', "el raval", "El Raval"),
                               ("N2", "Gòtic", "gotic", "Barri Gòtic"),
                               ("N3", "Orphan", "orphan", "Orphan")],
                              "_id string, neighborhood string, neighborhood_name string, "
                              "neighborhood_reconciled string")
    return build_lookup(d, n)


def test_build_lookup_strips_quotes_and_drops_orphans(spark):
    lk = _lookup(spark)
    assert rows(lk, "neighborhood_id", "neighborhood", "district_reconciled") == [
        ("N1", "el Raval", "Dist"), ("N2", "Gòtic", "Dist")]


def test_reconcile_policies(spark):
    lk = _lookup(spark)
    df = spark.createDataFrame([("el Raval", 1), ("Gòtic", 2), ("Nowhere", 3)], "name string, v int")
    keep = reconcile(df, lk, "name", on_unmatched="keep")
    assert rows(keep, "v", "neighborhood_id") == [(1, "N1"), (2, "N2"), (3, None)]
    drop = reconcile(df, lk, "name", on_unmatched="drop")
    assert rows(drop, "v", "neighborhood_id") == [(1, "N1"), (2, "N2")]
    with pytest.raises(Exception, match="no entry in the lookup"):
        reconcile(df, lk, "name", on_unmatched="error").collect()
    assert reconcile(df.limit(2).where("v < 3"), lk, "name").count() == 2
    assert rows(unmatched_keys(df, lk, "name")) == [("Nowhere", 1)]
    # several lookup rows for one spelling multiply nothing; two ids for it fail the job
    same = spark.createDataFrame([("el Raval", "N1"), ("el Raval", "N1"), ("el Raval", None)],
                                 "neighborhood string, neighborhood_id string")
    for policy in ("keep", "drop"):
        assert rows(reconcile(df, same, "name", on_unmatched=policy).where("v = 1"), "v", "neighborhood_id") == [(1, "N1")]
    split = spark.createDataFrame([("el Raval", "N1"), ("el Raval", "N2"), ("Gòtic", "N2")],
                                  "neighborhood string, neighborhood_id string")
    with pytest.raises(Exception, match="two ids"):
        reconcile(df, split, "name", on_unmatched="drop").collect()
    assert rows(reconcile(df.where("v = 2"), split, "name"), "v", "neighborhood_id") == [(2, "N2")]
    with pytest.raises(ValueError):
        reconcile(df, lk, "name", on_unmatched="ignore")


def test_reconcile_names(spark):
    canon = spark.createDataFrame(
        [(1, "Sant Andreu", "D1"), (2, "Sants", "D2"), (3, "Sant Antoni", "D2"),
         (4, "Santa Eulalia", "D2"), (5, "Sants", "D3")],
        "id int, name string, parent string")
    names = spark.createDataFrame(
        [("SANT ANDREU", "D1"), ("sant-andreu", "D1"), ("Sant Andru", "D1"),  # exact, exact, 1 edit
         ("Sant Antonii", "D2"), ("Snts", "D2"),                              # 1 edit each
         ("Sants", "D1"),                                                     # other parent only
         ("Xyzzy", "D2"), ("Sants", "D3"), ("Sants", "D3")],
        "raw string, district string")
    out = reconcile_names(names, canon, "raw", "id", "name", parent="district", canon_parent="parent",
                          max_distance=2)
    got = {(r["raw"], r["district"]): (r["id"], r["distance"]) for r in out.collect()}
    assert got[("SANT ANDREU", "D1")] == (1, 0)
    assert got[("sant-andreu", "D1")] == (1, 0)
    assert got[("Sant Andru", "D1")] == (1, 1)
    assert got[("Sant Antonii", "D2")] == (3, 1)
    assert got[("Snts", "D2")] == (2, 1)
    assert got[("Sants", "D1")] == (None, None)  # "sants" is 6 edits from "sant andreu"
    assert got[("Xyzzy", "D2")] == (None, None)
    assert got[("Sants", "D3")] == (5, 0)
    assert out.count() == 8  # distinct (name, parent)


def test_reconcile_names_matches_brute_force(spark):
    # every pair within distance k is found, ties by smallest id
    words = ["abcd", "abce", "abd", "xbcd", "ab", "abcdef", "bacd", "zzzz"]
    canon = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, name string")
    queries = ["abcd", "abdd", "acd", "abcdx", "qqqq", "ba", "abcdefg"]
    names = spark.createDataFrame([(q,) for q in queries], "raw string")
    out = reconcile_names(names, canon, "raw", "id", "name", max_distance=2)
    got = {r["raw"]: (r["id"], r["distance"]) for r in out.collect()}

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]
    for q in queries:
        cands = sorted((lev(q, w), i) for i, w in enumerate(words) if lev(q, w) <= 2)
        want = (cands[0][1], cands[0][0]) if cands else (None, None)
        assert got[q] == want, q


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


@pytest.mark.parametrize("k", [1, 2])
def test_reconcile_names_random_vs_brute_force(spark, k):
    import random
    rnd = random.Random(20 + k)
    alphabet = "abcd "

    def word():
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7)))
    canon = [(i, word(), rnd.randint(0, 2)) for i in range(60)]
    names = [(word(), rnd.randint(0, 2)) for _ in range(300)]
    cdf = spark.createDataFrame(canon, "id int, name string, blk int")
    ndf = spark.createDataFrame(names, "raw string, blk int")
    out = reconcile_names(ndf, cdf, "raw", "id", "name", parent="blk", canon_parent="blk",
                          max_distance=k)
    got = {(r["raw"], r["blk"]): (r["id"], r["distance"]) for r in out.collect()}

    def norm(s):
        return " ".join(s.split())
    assert len(got) == len(set(names))
    for raw, blk in set(names):
        cands = sorted((_lev(norm(raw), norm(c)), i) for i, c, b in canon
                       if b == blk and _lev(norm(raw), norm(c)) <= k)
        want = (cands[0][1], cands[0][0]) if cands else (None, None)
        assert got[(raw, blk)] == want, (raw, blk)


@pytest.mark.parametrize("percent", [10, 20, 50])
def test_reconcile_names_by_share_of_length(spark, percent):
    """The q-gram index against all pairs: short names, names of few letters, repeated canonical rows, empty names."""
    import random
    rnd = random.Random(percent)

    def word():
        return "".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 14)))
    canon = [(i, word(), rnd.randint(0, 1)) for i in range(80)]
    names = {(word(), rnd.randint(0, 1)) for _ in range(200)}
    names |= {(c[:5] + "x" + c[5:], b) for _, c, b in canon}
    cdf = spark.createDataFrame(canon + canon[:20] + [(99, None, 0)], "id int, name string, blk int")
    ndf = spark.createDataFrame([*names, (None, 0)], "raw string, blk int")
    out = reconcile_names(ndf, cdf, "raw", "id", "name", parent="blk", canon_parent="blk", max_percent=percent)
    got = {(r["raw"], r["blk"]): (r["id"], r["distance"]) for r in out.collect()}

    def norm(s):
        return " ".join(s.split())
    assert len(got) == len(names)
    found = 0
    for raw, blk in names:
        n = norm(raw)
        cands = sorted((_lev(n, norm(c)), i) for i, c, b in canon if b == blk
                       and _lev(n, norm(c)) <= max(len(n), len(norm(c))) * percent // 100)
        assert got[(raw, blk)] == ((cands[0][1], cands[0][0]) if cands else (None, None)), (raw, blk)
        found += bool(cands and cands[0][0])
    assert found > 5


def test_share_of_length_has_a_bound(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(ValueError):
        reconcile_names(df, df.withColumnRenamed("name", "c"), "name", "id", "c", max_percent=51)


def test_gram_index_makes_fewer_candidates_than_variants(spark):
    """Rows that reach the distance at the same edits: rare grams against deletion variants."""
    from cityzones.operators.reconcile import _deletion_variants, _rare_grams, _grams
    names = [f"{a} {b} {c}" for a in ("gran", "petit", "nou", "vell", "alt") for b in ("carrer", "passeig", "mercat")
             for c in ("nord", "sud", "llevant", "ponent")]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    rarity = df.select(F.explode(_grams(F.col("t"), 2)).alias("g")).groupBy(F.col("g.gram").alias("gram")).agg(
        F.count(F.lit(1)).alias("uses"))
    grams = _rare_grams(df, "t", rarity, 10, 2)
    variants = df.withColumn("v", F.explode(_deletion_variants(F.col("t"), 2)))
    assert grams.count() * 10 < variants.count()
