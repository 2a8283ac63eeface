"""Periodic runs of words: Lyndon roots from suffix grouping, extended into runs.

A run is a maximal stretch of words with smallest period q.  By the runs
theorem the root of every run is the longest Lyndon word at some position,
under an order of the words or under its reverse.  Both Lyndon arrays come
straight from the first phase of Baier's suffix sorter, which groups suffixes
by their longest Lyndon prefix: groups are taken in descending order, every
suffix of a group points to the nearest suffix before it that lies in a lower
group, and the suffixes pointed to move into a new group above their old one,
their prefix grown by the group's.  No suffix array is needed.  Each root is
then extended to both sides by longest common extensions of positions one
period apart.

Only stretches that may hold a run of LEAST_LENGTH words and LEAST_POWER
periods are grouped: inside such a run every three words come again within one
period.  That condition is exact and decided per document for all words, by
powers of two of the period.  Everything happens inside one pass over the
documents, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6
LEAST_POWER = 4
CHUNK_BYTES = 2_000_000
_FAR = np.int64(2**62)
_GRAM = 3

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = f"doc_id bigint, n_words bigint, runs array<{RUN}>, dropped array<struct<start:bigint,end:bigint>>, kept binary"


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position (first phase of Baier's suffix sorter).

    Groups are intervals of ``order``; a group's number is its first slot, so numbers compare like contexts."""
    n = len(ranks)
    order = sorted(range(n), key=ranks.__getitem__)
    slot, group, size = [0] * n, [0] * n, [0] * n
    start, last = 0, None
    for at, i in enumerate(order):
        if ranks[i] != last:
            start, last = at, ranks[i]
        slot[i], group[i] = at, start
        size[start] += 1
    length, prev, times = [1] * n, [-1] * n, [0] * n
    end = n
    while end > 0:  # groups by descending number; those moved up lie above
        start = group[order[end - 1]]
        members = sorted(order[start:end]) if end - start > 1 else order[start:end]
        grown, pointed = length[members[0]], []
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                if not times[j]:
                    pointed.append(j)
                times[j] += 1
        if len(pointed) > 1:
            pointed.sort(key=times.__getitem__, reverse=True)
        at = 0
        while at < len(pointed):  # those pointed to most often first: they end up in the higher new group
            k = times[pointed[at]]
            stop = at
            while stop < len(pointed) and times[pointed[stop]] == k:
                stop += 1
            taken: dict[int, int] = {}
            for j in pointed[at:stop]:
                old = group[j]
                taken[old] = taken.get(old, 0) + 1
                top = old + size[old] - taken[old]  # swap with the last slot that is not taken yet
                other = order[top]
                order[slot[j]], order[top] = other, j
                slot[other], slot[j] = slot[j], top
                length[j] += k * grown
            for old, m in taken.items():
                size[old] -= m
                new = old + size[old]
                size[new] = m
                for at_slot in range(new, new + m):
                    group[order[at_slot]] = new
            at = stop
        for j in pointed:
            times[j] = 0
        end = start
    return length


def _equal_from(words: np.ndarray, a: int, b: int) -> int:
    """Longest common extension to the right of positions a < b."""
    n, at, step = len(words), 0, 16
    while b + at < n:
        diff = words[a + at:a + at + min(step, n - b - at)] != words[b + at:b + at + step]
        if diff.any():
            return at + int(diff.argmax())
        at += len(diff)
        step *= 2
    return at


def _equal_to(words: np.ndarray, a: int, b: int) -> int:
    """Longest common extension to the left, positions a < b themselves excluded."""
    at, step = 0, 16
    while at < a:
        k = min(step, a - at)
        diff = (words[a - at - k:a - at] != words[b - at - k:b - at])[::-1]
        if diff.any():
            return at + int(diff.argmax())
        at += k
        step *= 2
    return at


def find_runs(words: np.ndarray, parts: list[tuple[int, int]], power: int = LEAST_POWER,
              least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of at least ``power`` periods and ``least`` words, by start, then period.

    ``words`` are numbers; every run wanted lies inside one of the stretches ``parts``.  ``power`` is 2 or more."""
    found = set()
    for a, b in parts:
        piece = words[a:b]
        _, ranks = np.unique(piece, return_inverse=True)
        for order in (ranks, ranks.max() - ranks):
            period = np.array(lyndon_lengths(order.tolist()), np.int64)
            at = np.arange(len(piece))
            # the first root of a run is followed by power - 1 whole periods less one word at most
            ok = at + (power - 1) * period <= len(piece)
            at, period = at[ok], period[ok]
            if power > 2:
                for back in (0, 1):
                    probe = at + (period - 1) * back
                    ok = piece[probe] == piece[probe + period]
                    at, period = at[ok], period[ok]
            first = np.lexsort((at, period))
            known_period = known_end = -1
            for i, p in zip((at[first] + a).tolist(), period[first].tolist()):
                if p == known_period and i + p <= known_end:
                    continue  # another root of the run found just before
                right = _equal_from(words, i, i + p) if i + p < len(words) else 0
                if right + p < (power - 1) * p:
                    continue
                left = _equal_to(words, i, i + p)
                known_period, known_end = p, i + p + right
                if left + p + right >= max(least, power * p):
                    found.add((i - left, left + p + right, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of ``words`` (numbers from 0; text d is first[d]:first[d + 1]) that may hold a run.

    In a run of period q all three-word pieces but those of its last q + 2 words come again q words on."""
    n = len(words)
    if n < LEAST_LENGTH:
        return []
    w = words.astype(np.int64)
    if w.max() < 1 << 21:
        gram = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:]
    else:
        pair = np.unique((w[:-1] << 32) | w[1:], return_inverse=True)[1]
        gram = (pair[:-1] << 32) | pair[1:]
    order = np.argsort(gram, kind="stable")
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    again = np.full(n, _FAR)
    a, b = order[:-1], order[1:]
    same = (gram[a] == gram[b]) & (text[a] == text[b])
    again[a[same]] = (b - a)[same]
    inside = text[:-2] == text[2:]
    again[:-2][~inside] = _FAR
    longest = int(np.diff(first).max(initial=0))
    found, q = [], 1
    while LEAST_POWER * q <= longest:
        wide = 2 * q - 1  # periods q to wide
        need = min(max(LEAST_LENGTH, LEAST_POWER * p) - p for p in range(q, min(wide, q + LEAST_LENGTH) + 1)) - _GRAM + 1
        near = again <= wide
        edge = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]]).astype(np.int8)))
        start, stop = edge[::2], edge[1::2]
        keep = stop - start >= need
        found.extend(zip(start[keep].tolist(), (stop[keep] + wide + _GRAM - 1).tolist()))
        q *= 2
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        b = min(b, int(first[np.searchsorted(first, a, "right")]))
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def covered(runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches (start, end) of words that some run holds after its first period."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s + q, s + n) for s, n, q in runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _chunk(ids: list, texts: list[list[bytes]]) -> pd.DataFrame:
    number: dict[bytes, int] = {}
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    words = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(first[-1]))
    by_text: dict[int, list[tuple[int, int]]] = {}
    for a, b in stretches(words, first):
        by_text.setdefault(int(np.searchsorted(first, a, "right")) - 1, []).append((a, b))
    rows = []
    for d, (k, text) in enumerate(zip(ids, texts)):
        base = int(first[d])
        runs = find_runs(words[base:first[d + 1]], [(a - base, b - base) for a, b in by_text[d]]) if d in by_text else []
        gone, kept, at = covered(runs), [], 0
        for a, b in gone:
            kept += text[at:a]
            at = b
        kept += text[at:]
        rows.append((k, len(text), [{"start": s, "length": n, "period": q} for s, n, q in runs],
                     [{"start": a, "end": b} for a, b in gone], b" ".join(kept)))
    out = pd.DataFrame(rows, columns=["doc_id", "n_words", "runs", "dropped", "kept"])
    return out.astype({"doc_id": "Int64"})


def _runs(change):
    """Runs of every text, a bounded number of bytes at a time (a longer text is a chunk of its own)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ids, texts, size = [], [], 0
            for k, t in zip(f["doc_id"], f["text"]):
                raw = b"" if t is None else t.encode("utf-8", "surrogatepass")
                if texts and size + len(raw) > CHUNK_BYTES:
                    yield _chunk(ids, texts)
                    ids, texts, size = [], [], 0
                k = None if pd.isna(k) else int(k)
                words = raw.split()  # exactly the six ASCII white-space characters
                ids.append(k)
                texts.append(change(k, words) if change else words)
                size += len(raw)
            if texts:
                yield _chunk(ids, texts)

    return run


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None) -> DataFrame:
    """Rows (doc_id, n_words, runs, dropped, kept), one per row of ``df`` (repeated rows included).

    runs: every run by start, then period; dropped: stretches of words that a run repeats; kept: the other words, joined
    by one space, as UTF-8.  A null text has no words, a null id stays null; other columns play no part.  A very long
    text is worked on as a whole, in memory proportional to its size.  An empty table gives no rows.  ``change`` maps
    (id, words) to the words to use instead, inside the same pass."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInPandas(_runs(change), RESULT)


def _planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's periodic ends: every tenth document by hash repeats a stretch of its words up to its end."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a:a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[:n - a]


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    out = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), change=_planted)
    # the greatest length, then the smallest start, then the smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    named = out.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return named.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        length.alias("length"), period.alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"))


# The same runs from all pairs of equal words at one distance: stretches of consecutive pairs, less those that a shorter
# period explains.  crc32 is written out over the digits of doc_id.
_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v
    FROM range(256) r(b))),
texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
      lambda d: ascii(d)::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM documents, crc_table),
shapes AS (
  SELECT doc_id, w, len(w) AS n, h, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a
  FROM texts),
planted AS (
  SELECT doc_id, n, w, a, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM shapes),
changed AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(n), lambda i: w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) END AS w
  FROM planted),
words AS (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM changed),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word
  AND y.i > x.i),
marked AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM pairs),
found AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM marked GROUP BY doc_id, q, stretch
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found g WHERE g.doc_id = f.doc_id AND g.q < f.q AND g.s <= f.s AND g.s + g.n >= f.s + f.n)),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    arg_min((s, n, q), (-n, s, q)) AS best FROM runs GROUP BY doc_id),
dropped AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN dropped d
  ON w.doc_id = d.doc_id AND w.i = d.i GROUP BY w.doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
  1000 * best[2] // best[3] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM changed LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLE = {"op13_periodic_runs": _SQL}
