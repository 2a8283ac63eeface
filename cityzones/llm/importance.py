"""Importance resampling towards a target text collection, over hashed word n-grams.

Features of a text are its runs of 1 to ORDER consecutive words, counted in
BUCKETS buckets by the CRC-32 of their bytes.  A chunk of texts gets a
dictionary of its distinct words, each between delimiters, with its CRC and
length as payload; an Aho-Corasick automaton of that dictionary scans the texts
and emits the payloads in order.  The CRC of a longer feature is composed from
the payloads of adjacent words alone (appending L bytes is a linear map of the
CRC), so no n-gram text is ever built.

One pass counts buckets, a sum per bucket gives the gains (a table of BUCKETS
numbers), a second pass adds the gains up per document, and a two-level running
count over the scores ranks them.  Dictionaries live for one chunk, so memory
does not grow with the number of distinct words of the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.llm.common import running_totals
from cityzones.llm.hashing import release
from cityzones.session import materialize

BUCKETS = 10_000
ORDER = 3
LEAST_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42
CHUNK_BYTES = 2_000_000

# Every byte that is not of a word (digits, letters, bytes beyond ASCII) becomes the delimiter; A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_DELIMITER = np.uint32(zlib.crc32(b" "))


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255]
            ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24])


def _shift_tables() -> list[np.ndarray]:
    """For each j the map of a CRC under 2**j appended bytes, as four tables over its bytes."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (register >> 1)
    byte = np.arange(256, dtype=np.uint32)
    one = np.stack([register, byte, byte << np.uint32(8), byte << np.uint32(16)])  # one zero byte
    out = [one]
    for _ in range(31):
        out.append(np.stack([_apply(out[-1], t) for t in out[-1]]))
    return out


_SHIFT = _shift_tables()


def appended(crc: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of ``x + tail`` from the CRC of x, the CRC of the tail and the tail's length in bytes."""
    out = crc.copy()
    for j in range(int(length.max(initial=0)).bit_length()):
        on = np.flatnonzero(length >> j & 1)
        out[on] = _apply(_SHIFT[j], out[on])
    return out ^ tail


def scan(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc, length, first): payloads of all words in order; those of text d are first[d]:first[d + 1]."""
    folded = [t.translate(_FOLD).decode("latin-1") for t in texts]
    words = set()
    for t in folded:
        words.update(t.split(" "))
    words.discard("")
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    crc, length = np.zeros(len(words), np.uint32), np.zeros(len(words), np.int64)
    for i, w in enumerate(words):
        automaton.add_word(f" {w} ", i)
        crc[i], length[i] = zlib.crc32(w.encode("latin-1")), len(w)
    automaton.make_automaton()
    at = [np.fromiter((i for _, i in automaton.iter(f" {t} ")), np.int64) for t in folded]
    hit = np.concatenate(at)
    return crc[hit], length[hit], np.concatenate([[0], np.cumsum([len(a) for a in at], dtype=np.int64)])


def feature_buckets(texts: list[bytes], buckets: int = BUCKETS, order: int = ORDER):
    """(bucket, text, n_words): bucket and text number of every feature, and the number of words of every text."""
    crc, length, first = scan(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    found, owner, run, at = [crc], [text], crc, np.arange(len(crc))
    for n in range(1, order):
        # runs of n words that end at ``at`` grow by the next word of the same text
        grows = at + 1 < len(crc)
        grows[grows] = text[at[grows] + 1] == text[at[grows]]
        at = at[grows] + 1
        spaced = _apply(_SHIFT[0], run[grows]) ^ _DELIMITER
        run = appended(spaced, crc[at], length[at])
        found.append(run)
        owner.append(text[at])
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), np.concatenate(owner), np.diff(first)


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and UTF-8 texts (null: empty), a bounded number of bytes at a time; a longer text is a chunk of its own."""
    for f in frames:
        ids, texts, size = [], [], 0
        for k, t in zip(f["id"], f["text"]):
            raw = b"" if t is None else t.encode("utf-8", "surrogatepass")
            if texts and size + len(raw) > CHUNK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(None if pd.isna(k) else int(k))
            texts.append(raw)
            size += len(raw)
        if texts:
            yield ids, texts
    release()


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """Rows (bucket, n): how many features of all texts fall into each bucket; buckets without features are absent."""
    def count(frames):
        total = np.zeros(buckets, np.int64)
        for _, texts in _chunks(frames):
            total += np.bincount(feature_buckets(texts, buckets, order)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    texts = df.select(F.lit(0).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS,
          order: int = ORDER) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target to corpus frequency, per bucket, rounded down."""
    def totals(df: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in bucket_counts(df, text_col, buckets, order).collect():  # at most one row per bucket
            out[r["bucket"]] = r["n"]
        return out

    s, t = totals(corpus), totals(target)
    whole_s, whole_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((y + 1) * whole_s / ((x + 1) * whole_t)))
                     for x, y in zip(s.tolist(), t.tolist())], np.int64)


def weights(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            order: int = ORDER) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight), one per row of ``df``."""
    def weigh(frames):
        for ids, texts in _chunks(frames):
            bucket, text, n_words = feature_buckets(texts, len(gain), order)
            n, k = np.bincount(text, minlength=len(ids)), len(ids)
            ordered = np.concatenate([[0], np.cumsum(gain[bucket[np.argsort(text, kind="stable")]])])
            ends = np.cumsum(n)
            yield pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "n_words": n_words[:k], "n_features": n,
                                "weight": ordered[ends] - ordered[ends - n]})

    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score, rank), one per row of ``df``.

    ``score`` is the weight plus Gumbel noise fixed by seed and id; of the N rows with ``least_words`` words or more
    the floor(percent * N / 100) highest scores are drawn and ranked from 1, ties by id; others have no rank.

    A null text has no words and weight 0; a null id takes the noise of the empty id and comes first among ties.
    Repeated rows each count and each get a rank of their own.  Other columns play no part.  An empty table gives no
    rows, an empty target gains from smoothing alone.  A very long text is worked on whole."""
    gain = gains(df, target, text_col)
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
                                     256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((draw + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = materialize(weights(df, gain, id_col, text_col).withColumn("score", F.col("weight") + noise),
                         "importance-scores")
    enough = F.col("n_words") >= least_words
    n_drawn = percent * scored.where(enough).count() // 100
    # the row number splits ties between equal rows over ranges; the scores are a stored table, so it is stable
    ranked = running_totals(scored.withColumn("_row", F.monotonically_increasing_id()),
                            [enough.desc(), F.col("score").desc(), F.col("doc_id"), F.col("_row")],
                            {"_at": F.lit(1)}, "importance-ranks")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(F.col("_at") <= n_drawn, F.col("_at")).cast("long").alias("rank"))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    out = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 of a feature: exclusive or of what each byte contributes at its distance from the end, and of the start value's
# share for that length.
_SQL = r"""
WITH RECURSIVE
texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (
  SELECT side, id, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM words, unnest([1, 2, 3]) AS u(k), unnest(range(1, len(w) - k + 2)) AS v(i)),
counted AS (SELECT side, id, g, count(*) AS n FROM grams GROUP BY ALL),
features AS (SELECT g, hex(encode(g)) AS x, length(hex(encode(g))) // 2 AS len
  FROM (SELECT DISTINCT g FROM counted)),
single AS (
  SELECT b, list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, y: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v
  FROM range(256) r(b)),
share AS (
  SELECT b, 1 AS d, v FROM single
  UNION ALL
  SELECT s.b, d + 1, xor(s.v >> 8, t.v) FROM share s JOIN single t ON t.b = s.v & 255
  WHERE d < (SELECT max(len) FROM features)),
opening AS (
  SELECT 0 AS d, 4294967295::BIGINT AS v
  UNION ALL
  SELECT d + 1, xor(o.v >> 8, t.v) FROM opening o JOIN single t ON t.b = o.v & 255
  WHERE d < (SELECT max(len) FROM features)),
coded AS (SELECT printf('%02X', b) AS h, d, v FROM share),
bytes AS (SELECT g, len, len - i AS d, substr(x, 2 * i + 1, 2) AS h FROM features, unnest(range(len)) AS u(i)),
hashed AS (
  SELECT g, xor(xor(any_value(o.v), bit_xor(c.v)), 4294967295::BIGINT) % 10000 AS bucket
  FROM bytes JOIN coded c USING (d, h) JOIN opening o ON o.d = bytes.len GROUP BY g),
placed AS (SELECT side, id, bucket, n FROM counted JOIN hashed USING (g)),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::BIGINT AS s, coalesce(sum(n) FILTER (side = 1), 0)::BIGINT AS t
  FROM placed GROUP BY bucket),
whole AS (SELECT sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM totals),
gain AS (
  SELECT bucket, floor(1000 * ln((a.t + 1)::DOUBLE * (w.s + 10000) / ((a.s + 1)::DOUBLE * (w.t + 10000))))::BIGINT AS v
  FROM totals a, whole w),
weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * v)::BIGINT AS weight FROM placed JOIN gain USING (bucket)
  WHERE side = 0 GROUP BY id),
scored AS (
  SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS enough,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weighed USING (id) WHERE side = 0),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY enough DESC, score DESC, doc_id) AS r, count(*) FILTER (enough) OVER () AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END AS rank FROM ranked
"""

QUERIES = {"op12_importance_resampling": op12_importance_resampling}
ORACLE = {"op12_importance_resampling": _SQL}
