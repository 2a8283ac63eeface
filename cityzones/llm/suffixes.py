"""Repeated passages across documents: a depth-limited radix sort of suffixes.

Every suffix of at least DEPTH bytes is a window.  Windows are sorted through
their first DEPTH bytes only, most significant digit first, and groups of one
are dropped after each digit; windows still together after the last digit are
exactly the repeated ones.  Since only groups matter, digits are hashes:

* the first digit of a window is the smallest hash of its GRAM-byte pieces.
  Equal windows have equal digits, and neighbouring windows mostly share one,
  so a run of windows is one entry.  Blocks of documents send their distinct
  digits, five bytes each, to the bucket of their leading bits and learn which
  ones another block has, too.
* the last digit is the hash of all DEPTH bytes.  Blocks send the bytes of the
  runs that are left, once for equal windows of a block, and the bucket of the
  digit compares them and answers with the places of the block whose windows a
  smaller document holds.

A window that many documents share leaves each block once, so hot passages cost
no more than the number of blocks.  What a block finds in itself travels with
its runs and comes back with the answers, so that the last pass cuts the texts
without hashing them again.  The texts are dealt into blocks by one shuffle
that all passes read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.llm.hashing import mix, powers, prefix_sums, release

DEPTH = 50
GRAM = 18
BLOCK_BYTES = 1_000_000
TILE = 1 << 16
LEAST_BUCKETS = 64
_U = np.uint64
_KEY_BYTES = 5
_LAST = 2**63 - 1  # a null id comes after all others

_PLACE = "<u4"  # positions in a block

SHARED = "block bigint, bucket int, bits binary"
RUNS = "block bigint, bucket int, owners binary, starts binary, counts binary, text binary, known binary, again binary"
ANSWER = "block bigint, hits binary, known binary, again binary"
RESULT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def _lean(group):
    """A group function that leaves no memory behind."""
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        out = group(frame)
        release()
        return out

    def two(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = group(left, right)
        release()
        return out

    return one if group.__code__.co_argcount == 1 else two


class Texts:
    """The documents of one block in ascending id order."""

    def __init__(self, frame: pd.DataFrame):
        raws = [b"" if t is None else t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass")
                for t in frame["text"]]
        ids = [None if pd.isna(k) else int(k) for k in frame["doc_id"]]
        order = sorted(range(len(raws)), key=lambda i: (_LAST if ids[i] is None else ids[i], raws[i]))
        self.raws, self.ids = [raws[i] for i in order], [ids[i] for i in order]
        self.joined = b"".join(self.raws)
        if len(self.joined) >= 2**32:
            raise ValueError("a block of documents holds 4 GiB or more")
        self.buf = np.frombuffer(self.joined, np.uint8)
        self.first = np.concatenate([[0], np.cumsum([len(r) for r in self.raws], dtype=np.int64)])


class Block(Texts):
    """The documents of one block, and the runs of windows with one first digit."""

    def __init__(self, frame: pd.DataFrame, depth: int):
        super().__init__(frame)
        self.depth = depth
        self.key, self.start, self.count = self._runs()

    def left(self, answers: pd.DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The runs that another document may share, by bucket and position; their buckets and owners."""
        keys, inverse = np.unique(self.key, return_inverse=True)
        rank = np.array([_LAST if k is None else k for k in self.ids], np.int64)
        owner = rank[np.searchsorted(self.first, self.start, "right") - 1]
        low, high = np.full(len(keys), _LAST), np.full(len(keys), -_LAST - 1)
        np.minimum.at(low, inverse, owner)
        np.maximum.at(high, inverse, owner)
        alive = _bits(answers, _bucket(keys, buckets)) | (low != high)
        run = np.flatnonzero(alive[inverse])
        bucket = _bucket(self.key[run], buckets)
        order = np.argsort(bucket, kind="stable")  # positions ascend inside a bucket
        return run[order], bucket[order], owner[run[order]]

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, depth, gram = len(self.buf), self.depth, min(GRAM, self.depth)
        out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a in range(0, n - depth + 1, TILE):
            size = min(TILE, n - depth + 1 - a)  # windows of this tile
            part = self.buf[a:a + size + depth - 1]
            s = prefix_sums(part)
            m = mix((s[gram:] - s[:-gram]) * powers(len(s))[1][:len(s) - gram])
            width, have = depth - gram + 1, 1
            while have < width:
                step = min(have, width - have)
                m = np.minimum(m[:-step], m[step:])
                have += step
            edge = np.empty(size, bool)
            edge[0] = True
            np.not_equal(m[1:], m[:-1], out=edge[1:])
            lost = np.zeros(size + 1, np.int64)  # windows that would cross into the next document
            ends = self.first[1:-1]
            ends = ends[(ends > a) & (ends < a + size + depth)]
            np.add.at(lost, np.clip(ends - depth + 1 - a, 0, size), 1)
            np.add.at(lost, np.clip(ends - a, 0, size), -1)
            good = np.cumsum(lost[:-1]) == 0
            edge[1:] |= good[1:] != good[:-1]
            at = np.flatnonzero(edge)
            length = np.diff(np.append(at, size))
            keep = good[at]
            # mixed again: smallest hashes crowd near zero, and buckets go by leading bits
            out.append((mix(m[at[keep]]), at[keep] + a, length[keep]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def hashes(self, run: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hashes of the windows of the runs given, ``at`` their positions."""
        wanted = np.zeros(len(self.buf) + 1, np.int8)
        wanted[self.start[run]] += 1  # runs do not overlap
        wanted[self.start[run] + self.count[run]] -= 1
        wanted = np.cumsum(wanted[:-1], dtype=np.int8).view(bool)
        place = np.flatnonzero(wanted)
        out = np.empty(len(self.buf), np.uint64)
        for a in range(0, len(self.buf), TILE):
            i, j = np.searchsorted(place, [a, a + TILE])
            if i < j:
                here = place[i:j]
                out[here] = window_hashes(self.buf[a:a + TILE + self.depth - 1], here - a, self.depth)
        return out[at]


def window_hashes(buf: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    s = prefix_sums(buf)
    return mix((s[at + depth] - s[at]) * powers(len(s))[1][at])


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Leading bits: the range of the digit that a bucket sorts."""
    return (((keys >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _cuts(sorted_buckets: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    edges = np.searchsorted(sorted_buckets, np.arange(buckets + 1))
    for b in np.flatnonzero(edges[1:] > edges[:-1]):
        yield int(b), int(edges[b]), int(edges[b + 1])


def _first_digits(depth: int, buckets: int):
    """Of each block its distinct first digits, five bytes each, by bucket."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(Block(frame, depth).key)
        raw = keys.view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES]
        rows = [(int(frame["block"].iat[0]), b, raw[i:j].tobytes())
                for b, i, j in _cuts(_bucket(keys, buckets), buckets)]
        return pd.DataFrame(rows, columns=["block", "bucket", "entries"])

    return run


def _shared_digits(frame: pd.DataFrame) -> pd.DataFrame:
    """Answers of one bucket: which entries of a block another block has, too."""
    sizes = [len(e) // _KEY_BYTES for e in frame["entries"]]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :_KEY_BYTES] = np.frombuffer(b"".join(frame["entries"]), np.uint8).reshape(-1, _KEY_BYTES)
    _, inverse, n = np.unique(wide.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
    shared = np.split(n[inverse] > 1, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"],
                         "bits": [np.packbits(x).tobytes() for x in shared]})


def _bits(answers: pd.DataFrame, buckets: np.ndarray) -> np.ndarray:
    """The answers to entries whose sorted buckets are given, in their order."""
    out = np.zeros(len(buckets), bool)
    for b, raw in zip(answers["bucket"], answers["bits"]):
        i, j = np.searchsorted(buckets, [b, b + 1])
        out[i:j] = np.unpackbits(np.frombuffer(raw, np.uint8), count=j - i)
    return out


def _repeated(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of all groups of two and more equal digits, group by group and ascending; where a group begins."""
    order = np.argsort(digits)
    d = digits[order]
    same = np.concatenate([[False], d[1:] == d[:-1]])[:len(d)]
    in_group = same | np.append(same[1:], False)[:len(d)]
    group, member = np.cumsum(~same)[in_group], order[in_group]
    new = ~same[in_group]
    bits = int(len(d)).bit_length()
    if bits + int(len(d)).bit_length() < 63:
        return np.sort((group << bits) | member) & ((1 << bits) - 1), new
    return member[np.lexsort((member, group))], new


def _stretches(*ascending: np.ndarray) -> np.ndarray:
    """Where a stretch begins in which all columns go up by one."""
    edge = np.ones(len(ascending[0]), bool)
    edge[1:] = False
    for x in ascending:
        edge[1:] |= x[1:] != x[:-1] + 1
    return np.flatnonzero(edge)


def _lengths(begin: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(begin, total))


def _places(*columns: np.ndarray) -> bytes:
    return np.stack(columns, 1).astype(_PLACE).tobytes() if len(columns[0]) else b""


def _read_places(raws, columns: int) -> np.ndarray:
    """Rows of ``columns`` places each, from all values given."""
    return np.frombuffer(b"".join(r for r in raws if r), _PLACE).reshape(-1, columns).astype(np.int64)


def _runs_left(depth: int, buckets: int):
    """The bytes of the runs that are left, once for equal windows of the block, by bucket.

    One of the rows of a block carries what the block finds in itself.  ``known``: stretches (start, count) of windows
    that a smaller document of the block holds.  ``again``: stretches (start, count, back) of windows that the block's
    smallest document with them holds before, ``back`` bytes earlier; the answer to the earlier one holds for them."""
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(docs, depth)
        runs, bucket, owner = block.left(answers, buckets)
        n = block.count[runs]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(n) else 0
        at = np.arange(total) + np.repeat(block.start[runs] - (ends - n), n)
        of = np.repeat(np.arange(len(runs)), n)
        # equal windows have one bucket, so they ascend by position, and with it by their documents' ids
        member, new = _repeated(block.hashes(runs, at))
        head = np.flatnonzero(new)
        holder = owner[of[member]]
        larger = holder > np.repeat(holder[head], _lengths(head, len(member)))
        repeat = np.flatnonzero(~new & ~larger)
        back = at[member[repeat]] - at[member[repeat - 1]]
        sent = np.ones(total, bool)
        sent[member[~new]] = False
        k = np.sort(at[member[larger]])
        i = _stretches(k)
        known = _places(k[i], _lengths(i, len(k)))
        k = at[member[repeat]]
        order = np.argsort(k)
        k, back = k[order], back[order]
        i = _stretches(k, k - back)
        again = _places(k[i], _lengths(i, len(k)), back[i])

        w = np.flatnonzero(sent)
        a, of = at[w], of[w]
        edge = np.ones(len(w), bool)
        edge[1:] = (a[1:] != a[:-1] + 1) | (of[1:] != of[:-1])
        i = np.flatnonzero(edge)
        begin, count, of = a[i], _lengths(i, len(w)), of[i]
        texts = [block.joined[s:e] for s, e in zip(begin.tolist(), (begin + count + (depth - 1)).tolist())]
        owners, starts, counts = owner[of].astype("<i8"), begin.astype(_PLACE), count.astype("<u4")
        me = int(docs["block"].iat[0])
        rows = [(me, b, owners[i:j].tobytes(), starts[i:j].tobytes(), counts[i:j].tobytes(), b"".join(texts[i:j]),
                 None, None) for b, i, j in _cuts(bucket[of], buckets)]
        if known or again:
            carrier = me % len(rows)  # not the same bucket for all blocks
            rows[carrier] = (*rows[carrier][:-2], known, again)
        return pd.DataFrame(rows, columns=["block", "bucket", "owners", "starts", "counts", "text", "known", "again"])

    return run


def _smaller_elsewhere(depth: int):
    """Answers of one bucket: stretches (start, count) of windows that a smaller document of any block holds."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        owners, starts, digits, sizes = [], [], [], []
        for o, s, c, t in zip(frame["owners"], frame["starts"], frame["counts"], frame["text"]):
            n = np.frombuffer(c, "<u4").astype(np.int64)
            ends = np.cumsum(n)
            inside = np.arange(ends[-1])
            # run r starts at the windows before it plus depth - 1 bytes for each run before it
            digits.append(window_hashes(np.frombuffer(t, np.uint8),
                                        inside + np.repeat(np.arange(len(n)) * (depth - 1), n), depth))
            owners.append(np.repeat(np.frombuffer(o, "<i8"), n))
            starts.append(inside + np.repeat(np.frombuffer(s, _PLACE) - (ends - n), n))
            sizes.append(int(ends[-1]))
        owner, at = np.concatenate(owners), np.concatenate(starts)
        member, new = _repeated(np.concatenate(digits))
        covered = np.zeros(len(owner), bool)
        if len(member):
            head = np.flatnonzero(new)
            least = np.minimum.reduceat(owner[member], head)
            covered[member] = owner[member] > np.repeat(least, _lengths(head, len(member)))
        hits, a = [], 0
        for size in sizes:
            k = at[a:a + size][covered[a:a + size]]
            i = _stretches(k)
            hits.append(_places(k[i], _lengths(i, len(k))))
            a += size
        return pd.DataFrame({"block": frame["block"], "hits": hits, "known": frame["known"], "again": frame["again"]})

    return run


def _gone(answers: pd.DataFrame, size: int, depth: int) -> np.ndarray:
    """Which bytes of a block go."""
    hit = np.zeros(size + 1, np.int32)
    for column in ("hits", "known"):
        start, count = _read_places(answers[column], 2).T
        np.add.at(hit, start, 1)
        np.add.at(hit, start + count, -1)
    hit = np.cumsum(hit[:-1]) > 0
    # windows that are the same again, left to right: known ones are never among the earlier
    for start, count, back in _read_places(answers["again"], 3).tolist():
        hit[start:start + count] = np.resize(hit[start - back:start][:count], count)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    cover = np.zeros(size + 1, np.int32)
    np.add.at(cover, edge[::2], 1)
    np.add.at(cover, edge[1::2] + (depth - 1), -1)
    return np.cumsum(cover[:-1]) > 0


def _cut(depth: int):
    """Per document the spans to remove and the bytes that stay."""
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Texts(docs)
        gone = _gone(answers, len(block.buf), depth)
        rows = []
        for k, raw, a, b in zip(block.ids, block.raws, block.first[:-1].tolist(), block.first[1:].tolist()):
            g = gone[a:b]
            if not g.any():
                rows.append((k, len(raw), [], raw))
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8))).tolist()
            spans = [{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])]
            begins, ends = [0, *edge[1::2]], [*edge[::2], len(raw)]
            rows.append((k, len(raw), spans, b"".join([raw[s:e] for s, e in zip(begins, ends)])))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "spans", "kept"])
        return out.astype({"doc_id": "Int64"})

    return run


def remove_repeats(df: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (doc_id, n_bytes, spans, kept), one per row of ``df``: what is left of every text.

    A byte goes when a string of ``depth`` bytes that covers it also starts in a document with a smaller id; strings
    are judged on the input.  Texts are UTF-8 bytes, null texts empty; a null id comes after all others.  Rows with one
    id are one document as to who is smaller.  Texts shorter than ``depth`` stay whole.  Empty tables give no rows."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    buckets = max(LEAST_BUCKETS, n // 2)
    blocks = (docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))
              .withColumn("text", F.col("text").cast("binary")).repartition(n, "block"))
    digits = blocks.groupBy("block").applyInPandas(
        _lean(_first_digits(depth, buckets)), "block bigint, bucket int, entries binary")
    shared = digits.groupBy("bucket").applyInPandas(_lean(_shared_digits), SHARED)
    runs = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        _lean(_runs_left(depth, buckets)), RUNS)
    answers = runs.groupBy("bucket").applyInPandas(_lean(_smaller_elsewhere(depth)), ANSWER)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_lean(_cut(depth)), RESULT)


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
ORACLE = {}
