"""Mixing, sharding, token files and the pipeline."""

import random
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cityzones.llm import mixing, sharding, token_files, tokens
from cityzones.llm.common import running_totals
from cityzones.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def test_running_totals(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(50), rng.randrange(9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, v long")
    got = sorted((r.k, r.total, r.n) for r in running_totals(
        df, ["k", "v"], {"total": F.col("v"), "n": F.lit(1).cast("long")}, "test").collect())
    total, want = 0, []
    for n, (k, v) in enumerate(sorted(rows), 1):
        total += v
        want.append((k, total, n))
    assert got == want


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            open_.remove(s)
        left = 1.5 * sum(sizes.values()) - sum(target.values())


def mixed(spark, n=3000, hot=0.4, **options):
    rng = random.Random(n)
    rows = [(i, "w " * int(rng.paretovariate(1.2) * 10 % 4000),
             "hot" if rng.random() < hot else rng.choice(["a", "é", "zz", "B", None])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_its_targets(spark):
    df = mixed(spark)
    out = mixing.mix(df, block_rows=100, fan_in=4).collect()
    sizes, taken, widest = {}, {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        widest[r.source] = max(widest.get(r.source, 0), r.size)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = brute_targets(sizes)
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:  # the last fraction alone is rounded
        assert abs(taken[s] - want[s]) <= widest[s] / 2 + 1e-6 * want[s]
    again = mixing.mix(df.repartition(7), block_rows=100, fan_in=4).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mix_keeps_the_expected_copies():
    """Trades leave every document's expectation: over seeds the mean is the fraction it started with."""
    import pandas as pd
    frame = pd.DataFrame({"size": [5, 3, 8, 1, 9, 2, 7], "key": range(7), "source": "s", "block": 0, "last": False, "p": 0.4})
    mean = np.mean([mixing._trade(frame, seed, 0).sort_values("key")["p"].to_numpy() for seed in range(3000)], axis=0)
    assert np.abs(mean - 0.4).max() < 0.05
    one = mixing._trade(frame, 1, 0)
    assert ((one["p"] > 0) & (one["p"] < 1)).sum() <= 1
    assert (one["p"] * one["size"]).sum() == pytest.approx((frame["p"] * frame["size"]).sum())


def test_mix_of_nulls_repeats_and_empty(spark):
    rows = [(1, None, "a"), (1, "x y z", "a"), (1, "x y z", "a"), (None, "p q", None), (2, "", "b"), (3, " ", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mixing.mix(df).collect()
    assert len(out) == 6 and sum(r.taken for r in out if r.size == 0) == 0
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns
    assert docs.where("text is not null and text <> '' and text <> ' '").count() == sum(r.copies for r in out if r.size)
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.where("text is null")).collect()[0].taken == 0


def brute_capacity(sizes, n):
    def fits(cap):
        shards, filled = 1, 0
        for s in sizes:
            if s > cap:
                return False
            if filled + s > cap:
                shards, filled = shards + 1, 0
            filled += s
        return shards <= n
    return next(c for c in range(1, sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("n_shards,copies", [(16, 1), (4, 25), (16, 60)])
def test_shards_are_minimax_and_whole(spark, n_shards, copies):
    import hashlib
    rng = random.Random(copies)
    texts = ["".join(rng.choice("abcé") for _ in range(rng.randrange(60))) for _ in range(90)] + ["same text " * 5] * copies
    rows = [(rng.randrange(1000), t) for t in texts] + [(None, "x"), (5, None), (6, None), (7, ""), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    out = sharding.shard(df, n_shards).collect()
    assert len(out) == len(rows)
    by, load = {}, {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        load[r.shard] = load.get(r.shard, 0) + r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(n_shards))
    groups = {}
    for _, t in rows:
        groups[t] = groups.get(t, 0) + len((t or "").encode()) + 1
    order = sorted(groups, key=lambda t: b"" if t is None else hashlib.sha256(t.encode()).digest())
    assert max(load.values()) == brute_capacity([groups[t] for t in order], n_shards)
    place = sharding.with_shard(df, n_shards).select("text", "shard").distinct().collect()
    assert len(place) == len(groups)  # equal texts share a shard
    assert sorted(load) == sorted({r.shard for r in place})


def test_shards_of_little_or_nothing(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.shard, r.slot, r["size"], r.text_crc32) for r in sharding.shard(df).collect()] == [(0, 0, 2, zlib.crc32(b"a"))]
    assert sharding.shard(df.limit(0)).count() == 0 and sharding.with_shard(df.limit(0)).count() == 0


def strings(seed, n):
    rng = random.Random(seed)
    plain = list("abcABC019 \n\t'sStTmMdDrRveELlV!?.,-_$²½ªµº×÷ÀéßÿıłŁ") + ["'s", "'re", "'ll", " 've"]
    odd = ["€", "Σ", "σς", "日", "\x1c", "\x85", "\xa0", "é", "İ", "<|endoftext|>", "🙂"]
    return ["".join(rng.choice(plain if rng.random() < 0.97 else odd) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_batch_encoding_equals_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 300)  # forget often
    encoder, plain = tokens.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for seed in range(8):
        texts = ["", " ", "''s", "a's's", "x'", "'"] + strings(seed, 400)
        ids, counts = encoder.encode(texts)
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode([])] == [[], []]


def test_perfect_hash_is_minimal_and_refuses_others():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 20_000):
        keys = np.unique(rng.integers(-2**62, 2**62, n))
        table, used = token_files.PerfectHash.load(token_files.PerfectHash.build(keys).dump())
        assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
        index = token_files.Index.load(token_files.Index.build(0, keys, np.full(len(keys), 2)).dump())
        row, many = index.find(keys)
        assert (many == 1).all() and sorted(row.tolist()) == list(range(len(keys)))
        absent = rng.integers(2**62 + 1, 2**63 - 1, 1000)
        assert index.find(absent)[1].sum() <= 1  # a fingerprint of 32 bits lets almost nothing through


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "TASK_BYTES", 4000)
    texts = strings(4, 300) + [None, "", "long " * 30_000]
    rows = [(k, t) for k, t in zip(random.Random(1).sample(range(-500, 500), len(texts)), texts)]
    rows += [(rows[0][0], "repeated key"), (None, "no key"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash"))
    shards = token_files.write_ids(df, scratch_path(spark, "test-ids"), TOKENIZER)
    assert shards.count() > 3
    got = token_files.read_documents(shards).orderBy("start").collect()
    plain, at = Tokenizer.from_file(TOKENIZER), 0
    keys = [-10**9 if r.key is None else r.key for r in got]
    assert all(a <= b for a, b in pairwise(keys)) and len(got) == len(rows)
    want = sorted((-10**9 if k is None else k, zlib.crc32(np.array(plain.encode(
        t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for k, t in rows)
    assert sorted(zip(keys, (r.crc for r in got))) == want
    for r in got:
        assert r.start == at
        at += r.n_ids
    some = [k for k, _ in rows[:40] if k is not None]
    found = token_files.lookup(shards, some + [10**6]).collect()
    assert sorted(r.key for r in found) == sorted(some + [rows[0][0]])
    for r in found:
        assert r.ids in [plain.encode(t or "", add_special_tokens=False).ids + [2] for k, t in rows if k == r.key]
    assert token_files.lookup(shards, []).count() == 0


def test_token_files_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read_documents(token_files.write_ids(df, scratch_path(spark, "test-ids"), TOKENIZER)).count() == 0


def test_pipeline_stage_by_stage(spark):
    """Each stage against a plain statement of what it keeps."""
    from .test_dedup import brute_near, normal
    from .test_text_operators import brute_quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, SF)
    rows = good.collect()
    assert good.columns == columns and 0 < len(rows) < docs.count()
    assert all(brute_quality(r.text)[0] >= 50 for r in rows)
    single = stages["near duplicates"](spark, good, SF)
    kept = sorted(r.doc_id for r in single.collect())
    assert single.columns == columns
    assert kept == [k for k, _, _, stays in brute_near([(r.doc_id, r.text) for r in rows]) if stays]
    clean = stages["decontamination"](spark, single, SF)
    items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean.columns == columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(
        r.doc_id for r in single.collect() if not any(i in normal(r.text) for i in items))
    mix = stages["source mix"](spark, clean, SF)
    assert mix.columns == columns
    out = stages["shards"](spark, mix, SF)
    assert out.columns == [*columns, "shard"] and out.count() == mix.count()
    assert [len(n) for n in [corpus_pipeline.STAGES]] == [5] and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
