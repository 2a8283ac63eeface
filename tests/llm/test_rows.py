"""Rows that are hard on an operator: nulls, repeats, very long texts and columns named like its own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cityzones.llm import licenses, minhash, mixing, quality

SF = "/root/testdata/sf0.001"
CLASH = ("copies", "_copy", "_nth", "_hash", "_keep", "_words", "_lines", "_n_lines", "raw", "node", "bucket", "id",
         "hash", "row", "size", "nth", "keep", "n")


@pytest.fixture(scope="module")
def hard(spark):
    """Documents with nulls, 3,000 equal rows and a text of 5 MB; each clashing column holds its own name."""
    texts = [" ".join(f"the stone{i}x{j} of" for j in range(20 + i)) for i in range(6)]
    long = " ".join(f"the river{i} of" for i in range(300000))
    rows = [(i, t, "en", "a" if i % 2 else None, len(t)) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None), (7, "", "en", "a", 0), (8, long, "en", "b", len(long))]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    copies = spark.range(3000).select(F.lit(9).cast("long").alias("doc_id"), F.lit(texts[0] + " and more").alias("text"),
                                      F.lit("en").alias("lang"), F.lit("b").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    from cityzones.llm.common import materialize
    return materialize(base.unionByName(copies).withColumns({c: F.lit(c) for c in CLASH}), "test-hard")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns(spark, hard, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, hard, SF)
    assert out.columns == hard.columns + (["shard"] if name == "shards" else [])
    wrong = " or ".join(f"`{c}` is distinct from '{c}'" for c in CLASH)
    assert out.where(wrong).count() == 0
    ids = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {None: 1, 7: 1, 9: 3000}.items() <= ids.items() if name in ("decontamination", "shards") else 8 in ids
    if name == "quality rules":
        assert set(ids) == {0, 1, 2, 3, 4, 5, 8, 9}
    if name == "near duplicates":  # rows alike in id and text are one document
        assert max(ids.values()) == 1 and {None, 7, 8} <= set(ids)


def test_stages_of_an_empty_table_with_clashing_columns(spark, hard):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, hard.limit(0), SF).count() == 0, name


def test_judge_loses_no_column(hard):
    out = quality.judge(hard)
    assert set(hard.columns) <= set(out.columns)
    assert out.where("_words <> '_words' or _lines <> '_lines' or _n_lines <> '_n_lines'").count() == 0


def test_mix_spreads_equal_rows_over_the_blocks(spark):
    """10,000 equal rows: numbered, so that no block holds more than about its share, and all of them are mixed."""
    df = spark.range(10000).select(F.lit(1).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    out = mixing.mix(df, block_rows=256)
    got = out.agg(F.count(F.lit(1)).alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target"),
                  F.max("copies").alias("most")).first()
    assert got.n == 10000 and abs(got.taken - got.target) <= 3 and got.most <= 2


def test_mixed_rows_that_differ_in_one_column_stay_apart(spark):
    df = spark.createDataFrame([(1, "a b", "s", {"k": i % 2}, i % 2) for i in range(400)],
                               "doc_id long, text string, source string, m map<string,int>, side int")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert {r.side: r.n for r in out.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}.keys() == {0, 1}
    assert out.where("m['k'] <> side").count() == 0 and abs(out.count() - 600) <= 1


def test_near_duplicate_rows_without_an_id_stay(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "x", 2), (None, "y", 3)], "doc_id long, text string, hash int")
    out = minhash.without_near_duplicates(df)
    assert out.columns == df.columns and sorted(r.text for r in out.collect()) == ["x", "y"]


def test_neighbouring_spellings_and_repeats(spark):
    df = spark.createDataFrame([("a licence licence b",), ("sub licence sub-licence",), ("https https://x",)], "t string")
    got = [r[0] for r in df.select(licenses.canonical_line(F.col("t"))).collect()]
    assert got == ["a license license b", "sublicense sublicense", "http http x"]


def test_licence_scan_does_not_shuffle_documents(spark):
    text = "words\n" * 50000 + "Licensed under CC BY 4.0.\n"
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, None, "x")], "doc_id int, text string, license string")
    out = licenses.scan(df, licenses.known_digests(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "Exchange hashpartitioning" not in plan
    assert [(r.id, r.line, r.license) for r in out.collect()] == [(1, 50000, "CC-BY-4.0")] * 2
