"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target share of the words; a document's expected number of
copies is target / source size.  The whole part is given to all documents; the
fractional parts are rounded dependently: two fractions trade words, in a
random direction that keeps both expectations, until one of them is integral.
A trade keeps their common number of words, so the words of a whole source stay
at its target up to its last fraction.

Trades run as a reduction tree: documents are dealt into blocks of bounded size
by a hash, each block leaves at most one fraction, and blocks of these meet on
the next level until a source has one.  All randomness comes from a seed and
the rows themselves, so a rerun and a retried task decide alike.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityzones.llm.common import WORD, materialize, running_totals

WEIGHTS = (3, 1, 2)  # of the sources by code point, repeating
SHARE = (3, 2)       # of all words, as a fraction
MOST = 2             # copies of a document
BLOCK_ROWS = 4096
FAN_IN = 512


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """Append ``target`` to rows (source, source_size): a share of all words dealt by weight, no source above ``most``
    times its size, what is cut off dealt again by weight until none is above.

    Sources rank by code point, null last.  Raising the common level until it stands still gives the same result as
    dealing again: a source is at its cap or at weight times level."""
    ranked = running_totals(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"],
                            {"rank": F.lit(1).cast("long")}, "mix-sources")
    weight = F.element_at(F.lit(list(weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.select(
        "source", "source_size", "n_rows", weight.alias("weight"), (F.col("source_size") * most).alias("cap")),
        "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    words = total * share[0] / share[1]
    level = 0.0
    while words:
        capped = F.col("cap") <= F.col("weight") * level
        c, w = ranked.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0)),
                          F.sum(F.when(~capped, F.col("weight")).otherwise(0))).first()
        new = (words - c) / w if w else level
        if new <= level:
            break
        level = new
    at = F.col("weight") * F.lit(float(level))
    return ranked.withColumn("target", F.when(F.col("cap") <= at, F.col("cap").cast("double")).otherwise(at)) \
        .drop("cap")


def _trader(seed: int, level: int):
    def trade(frame: pd.DataFrame) -> pd.DataFrame:
        return _trade(frame, seed, level)

    return trade


def _trade(frame: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """Round the fractions ``p`` of one block of one source; at most one stays between 0 and 1, unless ``last``."""
    frame = frame.sort_values(["size", "key"], ascending=[False, True], kind="stable", ignore_index=True)
    name = frame["source"].iat[0]
    rng = np.random.default_rng([seed, level, int(frame["block"].iat[0]), 0 if name is None else 1,
                                 zlib.crc32(str(name).encode())])
    luck = rng.random(len(frame))
    size, p = frame["size"].to_numpy(), frame["p"].to_numpy(copy=True)
    held = -1  # the row whose fraction is still open
    for i in range(len(frame)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = float(size[held]), float(size[i])
        up = min((1.0 - p[held]) * a, p[i] * b)      # words that can move to the held row
        down = min(p[held] * a, (1.0 - p[i]) * b)    # words that can move away from it
        move = up if luck[i] * (up + down) < down else -down
        x, y = p[held] + move / a, p[i] - move / b
        x, y = (round(v) if abs(v - round(v)) < 1e-9 else v for v in (x, y))
        p[held], p[i] = x, y
        if not 0.0 < x < 1.0:
            held = i if 0.0 < y < 1.0 else -1
    if held >= 0 and frame["last"].iat[0]:
        p[held] = round(p[held])
    return frame.assign(p=p)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17,
        weights=WEIGHTS, share=SHARE, most: int = MOST, block_rows: int = BLOCK_ROWS, fan_in: int = FAN_IN,
        key: list[str] | None = None, size: Column | None = None) -> DataFrame:
    """Rows (id, source, size, source_size, target, copies, taken), one per row of ``df``, with the ``key`` columns.

    Size: number of words (null text: 0), or the column ``size``.  copies: 0 to ``most``; taken: copies times size.  Documents without words
    take nothing.  The last open fraction of a source goes to the nearer whole number, so its taken words differ from
    the target by at most half of one document.  Repeated rows are documents of their own: rows alike in id, source,
    size and key are counted before the shuffle and numbered afterwards, so that they spread over the blocks too."""
    key = key or []
    keys = [f"_k_{k}" for k in key]
    alike = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), *[F.col(k).alias(f"_k_{k}") for k in key],
        (n_words(F.col(text_col)) if size is None else size).alias("size")) \
        .groupBy("id", "source", *keys, "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(_numbered(alike, "n", block_rows).drop("n"), "mix-sizes")
    sources = source_targets(sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")), weights, share, most)
    sources = materialize(sources.select(
        "source", "source_size", "target", F.ceil(F.col("n_rows") / block_rows).alias("blocks"),
        (F.col("target") / F.greatest("source_size", F.lit(1))).alias("rate")), "mix-targets")
    rows = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select(
        "id", *keys, "nth", sizes["source"], "size", "source_size", "target", "blocks",
        F.floor("rate").cast("int").alias("base"), (F.col("rate") - F.floor("rate")).alias("p"),
        F.xxhash64(F.col("id"), F.col("size"), *keys, F.col("nth")).alias("key"))
    open_ = (F.col("size") > 0) & (F.col("p") > 0) & (F.col("p") < 1)
    done = [rows.where(~open_).withColumn("p", F.lit(0.0))]
    left, level = rows.where(open_), 0
    most_blocks = sources.agg(F.max("blocks")).first()[0] or 0
    fields = left.withColumns({"block": F.lit(0).cast("long"), "last": F.lit(True)}).schema
    while most_blocks:
        block = F.pmod(F.col("key"), F.col("blocks")) if level == 0 else F.floor(F.col("block") / fan_in)
        dealt = left.withColumns({"block": block.cast("long"), "last": F.col("blocks") <= 1})
        traded = materialize(dealt.select(*fields.names).groupBy("source", "block").applyInPandas(
            _trader(seed, level), fields), f"mix-level{level}")
        settled = (F.col("p") <= 0) | (F.col("p") >= 1)
        done.append(traded.where(settled).drop("block", "last"))
        left = traded.where(~settled).withColumn("blocks", F.ceil(F.col("blocks") / fan_in))
        most_blocks, level = (-(-most_blocks // fan_in) if most_blocks > 1 else 0), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = F.col("base") + F.col("p").cast("int")
    return out.select("id", *[F.col(f"_k_{k}").alias(k) for k in key], "source", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _numbered(df: DataFrame, n: str, step: int) -> DataFrame:
    """Every row ``n`` times, with ``nth`` from 1 to n; two levels, so that no array is longer than n / step + step."""
    first = F.explode(F.sequence(F.lit(1).cast("long"), F.col(n), F.lit(step).cast("long")))
    return df.withColumn("nth", first).withColumn("nth", F.explode(F.sequence(
        F.col("nth"), F.least(F.col("nth") + (step - 1), F.col(n)))))


def _row_hash(df: DataFrame, row: str) -> Column:
    """Hash of all columns in the struct ``row`` (maps and variants by their JSON text, which Spark can hash)."""
    def value(field) -> Column:
        v = F.col(f"{row}.`{field.name.replace('`', '``')}`")
        kind = field.dataType.simpleString()
        return F.to_json(F.struct(v.alias("v"))) if "map<" in kind or "variant" in kind else v

    return F.xxhash64(*[value(f) for f in df.schema[row].dataType.fields])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, source and any others) with every row as often as the mix takes it, up to ``most`` times.

    Further columns pass through, whatever their names.  Rows alike in all columns are counted and kept once until the
    copies are made, so a group of copies meets no window; a null doc_id is an id as any other."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col("row.doc_id").alias("id"), _row_hash(rows, "row").alias("hash"))
    narrow = rows.select("id", "hash", F.col("row.source").alias("source"), n_words(F.col("row.text")).alias("size"))
    plan = mix(narrow, id_col="id", key=["hash"], size=F.col("size"), **options).where("copies > 0")
    plan = materialize(plan.groupBy("id", "hash").agg(F.sum("copies").alias("copies")), "mix-plan")
    plan = plan.select(F.col("id").alias("to_id"), F.col("hash").alias("to_hash"), "copies")
    once = rows.groupBy("id", "hash").agg(F.first("row").alias("row"))
    taken = once.join(plan, once["id"].eqNullSafe(plan["to_id"]) & (once["hash"] == plan["to_hash"]))
    return _numbered(taken.select("row", "copies"), "copies", BLOCK_ROWS).select("row.*")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES = {"op5_mixing": op5_mixing}
ORACLE = {}
