"""Near-duplicate documents by b-bit MinHash.

One pass over the texts hashes each document's 5-word shingles and keeps the
minimum under each of PERMUTATIONS hash functions.  Bands of full minima give
the candidate buckets; of each minimum only the low BITS are retained, packed
into words, and a candidate pair's similarity is estimated by counting equal
lanes with bit operations, corrected for lanes that agree by chance.  Pairs
whose estimate is far below the threshold (six standard errors) are dropped;
the others are confirmed on the full shingle sets.

Copies (equal word sequences) are one class with one representative.  Inside a
bucket no list of all pairs is made: members are compared with one hub, and
only buckets whose members still lie in different components are looked at
again, first with another hub, then exhaustively, outsiders against the rest.
Pairs inside one component need no test, so no link between components is lost.
The last comparison happens inside the join: besides the estimate, each set's
bitmap bounds the overlap from above (a set bit that the other set lacks is at
least one shingle it lacks), so only pairs that may well be links become rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityzones.llm.common import let, materialize
from cityzones.llm.graph import components
from cityzones.llm.hashing import distinct, mix, shingles

WORDS = 5
PERCENT = 75           # least similarity
BAND_ROWS, BANDS = 4, 40
PERMUTATIONS = BAND_ROWS * BANDS
BITS = 4               # retained of each minimum
LEAST_ESTIMATE = 0.53  # 0.75 less six standard errors of the estimate
BITMAP_WORDS = 32      # 64-bit words of a set's bitmap
CHUNK_BYTES = 4_000_000
_FACTORS = np.random.default_rng(4321).integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TILE = 1 << 16

SKETCH = "doc_id bigint, raw binary, digest binary, n_shingles bigint, signature array<bigint>, bands array<bigint>"


def signatures(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed, bands) of texts with at least one shingle each.

    packed: 64 / BITS lanes a word; bands: one 64-bit hash of BAND_ROWS full minima and the band's number."""
    n = len(first) - 1
    minima = np.empty((n, PERMUTATIONS), np.uint64)
    d = 0
    while d < n:  # tiles that stay in the processor's cache
        e = max(d + 1, int(np.searchsorted(first, first[d] + _TILE, "right")) - 1)
        x, at = hashes[first[d]:first[e]], first[d:e] - first[d]
        for k in range(PERMUTATIONS):
            minima[d:e, k] = np.minimum.reduceat(x * _FACTORS[k], at)
        d = e
    lanes = mix(minima) & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    packed = np.bitwise_or.reduce(lanes.reshape(n, -1, per) << shifts, axis=2)
    rows = minima.reshape(n, BANDS, BAND_ROWS)
    bands = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (n, BANDS)).copy()
    for j in range(BAND_ROWS):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, j])
    return packed.view(np.int64), bands.view(np.int64)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def _raw(texts) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        texts = _raw(f["text"])
        for a, b in _chunks(texts):
            part = texts[a:b]
            hashes, first = shingles(part, WORDS)
            n = np.diff(first)
            some = n > 0
            sets = distinct(hashes, first)
            packed, bands = signatures(hashes, np.concatenate([[0], np.cumsum(n[some])]))
            where = np.cumsum(some) - 1
            yield pd.DataFrame({
                "doc_id": f["doc_id"].iloc[a:b].array, "raw": f["raw"].iloc[a:b].array,
                "digest": [hashlib.blake2b(b" ".join(t.lower().split()), digest_size=16).digest() if s else None
                           for t, s in zip(part, some)],
                "n_shingles": [len(s) for s in sets],
                "signature": [packed[where[i]] if s else None for i, s in enumerate(some)],
                "bands": [bands[where[i]] if s else None for i, s in enumerate(some)]})


def sketch(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): raw text digest, word-sequence digest, set size, signature, bands.

    The last three but the size are null for a text without words."""
    raw = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.select(F.col("doc_id").cast("long"), "text", raw.alias("raw")).mapInPandas(_sketch, SKETCH)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: the share of equal lanes, less what agrees by chance."""
    lanes = int("1" * (64 // BITS), 16)

    def unequal(x: Column, y: Column) -> Column:
        return let(x.bitwiseXOR(y), lambda z: let(
            z.bitwiseOR(F.shiftrightunsigned(z, 1)), lambda o: F.bit_count(
                o.bitwiseOR(F.shiftrightunsigned(o, 2)).bitwiseAND(F.lit(lanes)))))

    apart = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda total, n: total + n)
    chance = 2.0 ** -BITS
    return ((1 - apart / PERMUTATIONS) - chance) / (1 - chance)


def _confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose full shingle sets are similar enough; a hub's set is computed once per batch."""
    for f in frames:
        a, b = f["a"].to_numpy(), f["b"].to_numpy()
        texts = dict(zip(np.concatenate([a, b]).tolist(), [*f["text_a"], *f["text_b"]]))
        nodes, raws, sets = list(texts), _raw(texts.values()), {}
        for x, y in _chunks(raws):
            sets.update(zip(nodes[x:y], distinct(*shingles(raws[x:y], WORDS))))
        yes = np.zeros(len(f), bool)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = sets[x], sets[y]
            if 100 * min(len(x), len(y)) >= PERCENT * max(len(x), len(y)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                yes[i] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield f.loc[yes, ["a", "b"]]


def _mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Set size and bitmap of every node's shingle set."""
    width = np.uint64(64 * BITMAP_WORDS)
    for f in frames:
        raws, rows = _raw(f["text"]), []
        for a, b in _chunks(raws):
            for x in distinct(*shingles(raws[a:b], WORDS)):
                bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
                bits[((x >> np.uint64(32)) % width).astype(np.int64)] = 1
                rows.append((len(x), np.packbits(bits).view(np.int64)))
        yield pd.DataFrame({"node": f["node"].array, "n": [n for n, _ in rows], "bits": [b for _, b in rows]})


def _may_link(n_x: Column, bits_x: Column, n_y: Column, bits_y: Column) -> Column:
    """False only for sets that cannot be similar enough, by an upper bound of their overlap."""
    def lacking(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0),
                           lambda total, k: total + k)

    overlap = F.least(n_x - lacking(bits_x, bits_y), n_y - lacking(bits_y, bits_x))
    return let(overlap, lambda o: 100 * o >= PERCENT * (n_x + n_y - o))


def _pairs(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _links(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The candidate ``pairs`` (a, b) that are links: estimate first, then full sets."""
    sig = reps.select("node", "signature")
    near = (pairs.distinct().join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")
            .where(estimate(F.col("sa"), F.col("sb")) >= LEAST_ESTIMATE).select("a", "b"))
    return _confirmed(near, texts)


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    near = materialize(pairs, "near-pairs")
    t = texts.select("node", "text")
    both = near.join(t.toDF("a", "text_a"), "a").join(t.toDF("b", "text_b"), "b")
    return materialize(both.select("a", "b", "text_a", "text_b").mapInPandas(_confirm, "a bigint, b bigint"), "near-links")


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (bucket, node, root) of the buckets that hold more than one component."""
    m = members.select("bucket", "node").join(roots, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root"))
    several = (m.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
               .where(F.col("lo") != F.col("hi")).select("bucket"))
    return m.join(several, "bucket")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per row of ``docs`` (doc_id, text; others are left out).

    Two documents are linked when they share at least 75 % of the union of their shingle sets; component_id is the
    smallest doc_id that links reach.  Texts without words (null, empty, blank) are linked with nothing.  A null doc_id
    is never the smallest unless all are null.  Rows that repeat a doc_id are one class if their words agree, else
    classes of their own; all rows whose doc_id is their component's are kept.  An empty table gives an empty result."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rows = materialize(sketch(docs), "near-sketch")
    classes = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "raw", "signature", "bands"), F.coalesce("doc_id", F.lit(2**63 - 1))).alias("r"))
    reps = materialize(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "r.*"), "near-classes")

    entries = reps.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1")
    members = materialize(entries.join(shared.select("bucket", "hub"), "bucket"), "near-members")
    wanted = reps.join(members.select("node").distinct(), "node").select("node", "doc_id", "raw")
    texts = docs.withColumn("raw", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    texts = wanted.join(texts, wanted["doc_id"].eqNullSafe(texts["doc_id"]) & (wanted["raw"] == texts["raw"]))
    texts = materialize(texts.groupBy("node").agg(F.first("text").alias("text")), "near-texts")

    links = _links(members.where("node != hub").select(*_pairs("node", "hub")), reps, texts)
    roots = materialize(components(links, "a", "b"), "near-roots")

    again = materialize(_mixed(members, roots), "near-mixed")
    hubs = again.groupBy("bucket").agg(F.max_by(F.struct(F.col("node").alias("hub"), F.col("root").alias("hub_root")),
                                                F.xxhash64("node", "bucket")).alias("h")).select("bucket", "h.*")
    more = _links(again.join(hubs, "bucket").where("root != hub_root").select(*_pairs("node", "hub")), reps, texts)
    links = links.unionByName(more)
    roots = materialize(components(links, "a", "b"), "near-roots")

    rest = _mixed(again, roots)
    marks = rest.select("node").distinct().join(texts, "node").select("node", "text").mapInPandas(
        _mark, "node bigint, n bigint, bits array<bigint>")
    marks = materialize(marks.join(reps.select("node", "signature"), "node"), "near-marks")
    rest = materialize(rest.join(marks, "node"), "near-mixed")
    per = rest.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("members"))
    main = per.groupBy("bucket").agg(F.max_by("root", F.struct("members", "root")).alias("main"))
    outside = rest.join(main, "bucket").where("root != main").select(
        "bucket", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "n", "bits", "signature")])
    close = ((outside["bucket"] == rest["bucket"]) & (F.col("x_root") != F.col("root"))
             & (estimate(F.col("x_signature"), F.col("signature")) >= LEAST_ESTIMATE)
             & _may_link(F.col("x_n"), F.col("x_bits"), F.col("n"), F.col("bits")))
    more = _confirmed(outside.join(rest, close).select(*_pairs("x_node", "node")).distinct(), texts)
    roots = materialize(components(links.unionByName(more), "a", "b"), "near-roots")

    named = reps.join(roots, "node", "left").select("digest", "doc_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = materialize(named.join(least, "root").select("digest", "component_id"), "near-named")
    out = rows.join(named, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id.

    Rows that repeat both doc_id and text are one document.  Documents with a null doc_id are only compared with each
    other's ids as far as equal texts go: linked ones that all lack an id stay.
    Further columns pass through, whatever their names."""
    keep = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("keep")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64("text").alias("hash"))
    rows = rows.join(keep, rows["id"].eqNullSafe(keep["keep"]), "left_semi")
    return rows.dropDuplicates(["id", "hash"]).select("row.*")


def op3_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_minhash_near_dedup": op3_minhash_near_dedup}
ORACLE = {"op3_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS (SELECT r, len(s) AS n, unnest(s) AS g FROM s),
f AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
p AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
      FROM e a JOIN e b ON a.g = b.g AND a.r <> b.r AND a.g IN (SELECT g FROM f) GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * k >= 75 * (na + nb - k)),
c AS (SELECT r AS a, r AS b FROM s UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
m AS (SELECT c.a AS r, min(s.doc_id) AS component_id FROM c JOIN s ON s.r = c.b GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m USING (r)"""}
