"""Sharding: minimax contiguous partition of atomic groups.

Documents with equal texts are one group.  Groups stand in the order of their
text's digest, which spreads sources and lengths evenly, and are cut into
``n_shards`` contiguous runs whose largest is as small as possible: the
smallest capacity for which greedy filling needs no more shards is searched
for, checking many capacities per pass, and the greedy cuts of that capacity
are the shard ends.

The check never gathers the groups: a greedy step asks, for every candidate
capacity at once, for the last group end within reach, an aggregate over the
few groups near the possible cuts (the table of ends is sorted, so the scan
skips the rest).  Rows keep their order from one range shuffle of narrow rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityzones.llm.common import let, materialize, running_totals

CANDIDATES = 1024  # capacities checked per pass
_FINE = 32


def text_digest(text: Column) -> Column:
    """Binary SHA-256 of the text; of nothing at all for a null text, so null and empty are two groups."""
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b""))


def _sql_longs(values: list[int]) -> str:
    return "array(" + ", ".join(f"{v}L" for v in values) + ")"


def _longs(values: list[int]) -> Column:
    """One constant array, parsed at once rather than built from single literals."""
    return F.expr(_sql_longs(values))


def _below(end: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are smaller than ``end``: coarse steps first, then one fine stretch."""
    coarse = _longs(bounds[::_FINE])
    stretches = F.expr("array(" + ", ".join(
        _sql_longs(bounds[i:i + _FINE]) for i in range(0, len(bounds), _FINE)) + ")")
    return let(F.size(F.filter(coarse, lambda b: b < end)), lambda c: F.when(c == 0, 0).otherwise(
        (c - 1) * _FINE + F.size(F.filter(F.get(stretches, c - 1), lambda b: b < end))))


def _reach(ends: DataFrame, bounds: list[int], widest: int) -> list[int]:
    """For each bound the largest group end that is not above it."""
    order = sorted(set(bounds))
    near = ends.where((F.col("end") > order[0] - widest) & (F.col("end") <= order[-1]))
    best = near.groupBy(_below(F.col("end"), order).alias("b")).agg(F.max("end").alias("end"))
    at, last = [0] * len(order), 0
    found = {r["b"]: r["end"] for r in best.collect()}  # at most one row per bound
    for i in range(len(order)):
        last = max(last, found.get(i, 0))
        at[i] = last
    return [at[bisect_right(order, b) - 1] for b in bounds]


def minimax_cuts(ends: DataFrame, total: int, widest: int, n_shards: int) -> list[int]:
    """Ends of the shards, for the smallest feasible capacity.

    ``ends`` holds the running total at the end of each group, ``widest`` the largest group.  The capacity lies
    between the mean shard and the mean plus one group; each pass splits what is left by CANDIDATES."""
    low = max(-(-total // n_shards), widest)
    high = -(-total // n_shards) + widest
    cuts: list[int] | None = None
    while cuts is None or low < high:
        step = max(1, -(-(high - low) // CANDIDATES))
        tried = sorted({*range(low, high, step), high})
        at, paths = [0] * len(tried), [[] for _ in tried]
        for _ in range(n_shards):
            open_ = [i for i, p in enumerate(at) if p < total]
            if not open_:
                break
            reached = _reach(ends, [min(total, at[i] + tried[i]) for i in open_], widest)
            for i, p in zip(open_, reached):
                at[i] = p
                paths[i].append(p)
        best = next(i for i, p in enumerate(at) if p >= total)
        cuts, high = paths[best], tried[best]
        low = tried[best - 1] + 1 if best else high
    return cuts


def _plan(df: DataFrame, n_shards: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """(rows in order with their running bytes and rank, sorted group ends with their digest, cuts)."""
    t = F.col(text_col)
    rows = df.select(F.col(id_col).alias("id"), text_digest(t).alias("digest"),
                     (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
                     F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    ranked = materialize(running_totals(
        rows, ["digest", "id"], {"end": F.col("size"), "rank": F.lit(1).cast("long")}, "shard"), "shard-rows")
    groups = ranked.groupBy("digest").agg(F.max("end").alias("end"), F.min(F.col("end") - F.col("size")).alias("start"))
    ends = materialize(groups.select("digest", "end", (F.col("end") - F.col("start")).alias("width"))
                       .repartitionByRange("end").sortWithinPartitions("end"), "shard-ends")
    total, widest = ends.agg(F.coalesce(F.max("end"), F.lit(0)), F.coalesce(F.max("width"), F.lit(0))).first()
    return ranked, ends, minimax_cuts(ends, total, widest, n_shards) if total else []


def _after(value: Column, cuts: list[Column]) -> Column:
    """How many of the cuts lie before ``value``."""
    which = F.lit(0)
    for c in cuts:
        which = which + (value > c).cast("int")
    return which


def shard(df: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, size, text_crc32, shard, slot), one per row of ``df``; all other columns are left out.

    Size: UTF-8 bytes plus 1 (null text: no bytes, checksum 0).  Equal texts share a shard; null texts are one group,
    empty texts another.  Shards hold contiguous runs of groups; slots count from 0 in each shard in (digest, id)
    order; repeated rows get slots of their own; null ids come first.  An empty table gives an empty result; with fewer
    groups than shards the last shards stay empty."""
    ranked, _, cuts = _plan(df, n_shards, id_col, text_col)
    dealt = ranked.withColumn("shard", _after(F.col("end"), [F.lit(c) for c in cuts[:-1]]))
    firsts = dict(dealt.groupBy("shard").agg(F.min("rank")).collect())  # one row per shard
    first = F.element_at(_longs([firsts.get(i, 0) for i in range(n_shards)]), F.col("shard") + 1)
    return dealt.select("id", "size", "text_crc32", "shard", (F.col("rank") - first).alias("slot"))


def with_shard(df: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
               out: str = "shard") -> DataFrame:
    """``df`` with the shard of ``shard`` appended (a column of that name is replaced).

    The cuts are read as digests, so rows are assigned where they are: nothing but the narrow ranking is shuffled."""
    _, ends, cuts = _plan(df, n_shards, id_col, text_col)
    inner = cuts[:-1]
    marks = [r["digest"] for r in ends.where(F.col("end").isin(inner)).select("digest").collect()] if inner else []
    return df.withColumn(out, _after(text_digest(F.col(text_col)), [F.lit(bytes(d)) for d in marks]))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op6_sharding": op6_sharding}
ORACLE = {}
