"""The registered queries over a whole small table: DuckDB where SQL can say it, brute force elsewhere."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_mod
from cityzones.llm.queries import ORACLE, QUERIES

from .test_dedup import brute_repeats, normal
from .test_output import brute_capacity, brute_targets
from .test_text_operators import brute_base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "pages", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, source FROM documents").fetchall()


def result(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_names():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: (n == "pipeline", len(n.split("_")[0]), n))] == [
        *(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    order = [c[0] for c in cur.description]
    assert sorted(order) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=str)
    assert got == sorted(cur.fetchall(), key=str) and got


def test_op1_finds_every_planted_item_and_nothing_else(spark, con, documents):
    items = [(i, normal(t)) for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()]
    want = {(d, i) for d, t, _ in documents for i, x in items if x in normal(t)}
    assert {(r.doc_id, r.item_id) for r in result(spark, "op1_decontamination")} == want and want


def test_op5_targets(spark, documents):
    out = {r.doc_id: r for r in result(spark, "op5_mixing")}
    sizes, taken = {}, {}
    for d, t, s in documents:
        assert out[d]["size"] == len((t or "").encode().split())
        sizes[s] = sizes.get(s, 0) + out[d]["size"]
        taken[s] = taken.get(s, 0) + out[d].taken
    want = brute_targets(sizes)
    for d, _, s in documents:
        assert out[d].target == pytest.approx(want[s]) and out[d].source_size == sizes[s]
        assert out[d].taken <= 2 * out[d]["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(out[d]["size"] for d, _, x in documents if x == s) / 2 + 1e-6


def test_op6_shards(spark, documents):
    out = result(spark, "op6_sharding")
    text = {d: t.encode() for d, t, _ in documents}
    load, slots = {}, {}
    for r in out:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (
            len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]), "bytes", None)
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(out) == len(documents)
    groups = {}
    for t in text.values():
        groups[t] = groups.get(t, 0) + len(t) + 1
    order = sorted(groups, key=lambda t: hashlib.sha256(t).digest())
    assert max(load.values()) == brute_capacity([groups[t] for t in order], 16)


def test_op7_removed_bytes(spark, documents):
    want = [(k, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
            for k, n, spans, kept in brute_repeats([(d, t) for d, t, _ in documents], 50)]
    assert sorted(tuple(r) for r in result(spark, "op7_suffix_dedup")) == sorted(want)


def test_op9_token_ids(spark, documents):
    plain, at, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for d, t, _ in sorted(documents, key=lambda r: r[0]):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in result(spark, "op9_token_ids")) == want


def test_op10_base_spans(spark, documents):
    out = {r.doc_id: r for r in result(spark, "op10_secret_scan")}
    for d, t, _ in documents:
        base = brute_base(t)
        assert out[d].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in base.split(",")]
        assert (out[d].n_assign, out[d].n_access, out[d].n_hex) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert set(filter(None, base.split(","))) <= set(out[d].spans.split(","))


def test_pipeline_runs_and_reruns_alike(spark, documents):
    first, again = result(spark, "pipeline"), result(spark, "pipeline")
    assert sorted(map(str, first)) == sorted(map(str, again)) and first
    assert {r.doc_id for r in first} <= {d for d, _, _ in documents}
