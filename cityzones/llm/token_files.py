"""Token-id files with a minimal perfect hash index.

A dataset is a Parquet folder of shards, one row each: the raw ids of
consecutive documents (little-endian, two bytes where the vocabulary allows,
else four), the document keys in order, and an index.  The index is a minimal
perfect hash of the shard's keys: a key goes to one slot that stores the key's
fingerprint and its first row; row offsets lead into the ids.  Access to a key
is constant time, and a fingerprint keeps absent keys from being found.

Documents are ranged by key, so shards are in ascending key order and no shard
depends on another; start offsets of the dataset come from the shard sizes when
the files are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.llm.common import materialize, running_totals
from cityzones.llm.hashing import mix
from cityzones.session import scratch_path

END_ID = 2
TASK_BYTES = 16_000_000    # of text per task
CHUNK_CHARS = 2_000_000    # encoded at once
SHARD_IDS = 2_000_000      # a shard closes after the document that reaches this
GAMMA = 2.0
SHARD = ("part int, seq int, first_key bigint, last_key bigint, n_docs bigint, n_ids bigint, width int, "
         "payload binary, keys binary, index binary")
_U = np.uint64


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.view(np.uint64) ^ mix(np.full(1, seed, np.uint64))[0])


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit arrays, a key's slot is the rank of its bit.

    A key sets its bit on the first level where no other key wants the same; the expected size is a few bits a key."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            m = max(8, int(GAMMA * len(keys)))
            at = (_hash(keys, len(sizes)) % _U(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where every level refuses it."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, m in enumerate(self.sizes):
            if not len(open_):
                break
            at = self.base[level] + (_hash(keys[open_], level) % _U(m)).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        return struct.pack(f"<I{len(self.sizes)}I", len(self.sizes), *self.sizes) + np.packbits(self.bits).tobytes()

    @classmethod
    def load(cls, raw: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes it took."""
        n = struct.unpack_from("<I", raw)[0]
        sizes = list(struct.unpack_from(f"<{n}I", raw, 4))
        begin, total = 4 + 4 * n, sum(sizes)
        used = -(-total // 8)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, used, begin), count=total).astype(bool)
        return cls(sizes, bits), begin + used


class Index:
    """Key -> rows of a shard.  ``nulls`` rows without key come first; repeated keys are one slot with a row count."""

    def __init__(self, nulls: int, offsets: np.ndarray, table: PerfectHash, prints: np.ndarray, rows: np.ndarray,
                 counts: np.ndarray):
        self.nulls, self.offsets, self.table = nulls, offsets, table
        self.prints, self.rows, self.counts = prints, rows, counts

    @staticmethod
    def fingerprints(keys: np.ndarray) -> np.ndarray:
        return (_hash(keys, 0xF1F1) >> _U(32)).astype(np.uint32)

    @classmethod
    def build(cls, nulls: int, keys: np.ndarray, lengths: np.ndarray) -> Index:
        """``keys``: sorted keys of the rows after the nulls; ``lengths``: ids of every row."""
        own, first, counts = np.unique(keys, return_index=True, return_counts=True)
        table = PerfectHash.build(own)
        slot = table.slots(own)
        prints, rows, many = np.zeros(len(own), "<u4"), np.zeros(len(own), "<u4"), np.zeros(len(own), "<u4")
        prints[slot], rows[slot], many[slot] = cls.fingerprints(own), first + nulls, counts
        return cls(nulls, np.concatenate([[0], np.cumsum(lengths)]).astype("<u8"), table, prints, rows, many)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row, number of rows) of each key; no rows for an absent one."""
        slot = self.table.slots(keys)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        hit = (slot >= 0) & (self.prints[slot] == self.fingerprints(keys))
        return self.rows[slot].astype(np.int64), np.where(hit, self.counts[slot], 0).astype(np.int64)

    def dump(self) -> bytes:
        head = struct.pack("<III", self.nulls, len(self.offsets), len(self.prints))
        return b"".join([head, self.offsets.tobytes(), self.prints.tobytes(), self.rows.tobytes(),
                         self.counts.tobytes(), self.table.dump()])

    @classmethod
    def load(cls, raw: bytes) -> Index:
        nulls, n, k = struct.unpack_from("<III", raw)
        at = 12
        offsets = np.frombuffer(raw, "<u8", n, at)
        parts = [np.frombuffer(raw, "<u4", k, at + 8 * n + 4 * k * i) for i in range(3)]
        return cls(nulls, offsets, PerfectHash.load(raw[at + 8 * n + 12 * k:])[0], *parts)


_ENCODERS: dict[str, object] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        from cityzones.llm.tokens import Encoder

        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class _Writer:
    """Collects the documents of one task and gives out closed shards."""

    def __init__(self, part: int, width: int):
        self.part, self.seq, self.kind = part, 0, "<u2" if width == 2 else "<u4"
        self.ids, self.lengths, self.keys, self.size = [], [], [], 0

    def add(self, keys: list, ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        """``ids`` and ``counts`` hold the end ids."""
        at = np.concatenate([[0], np.cumsum(counts)])
        begin = 0
        while begin < len(keys):
            end = min(len(keys), int(np.searchsorted(at, at[begin] + SHARD_IDS - self.size)))
            end = max(end, begin + 1)
            self.ids.append(ids[at[begin]:at[end]].astype(self.kind))
            self.lengths.append(counts[begin:end])
            self.keys.extend(keys[begin:end])
            self.size += int(at[end] - at[begin])
            begin = end
            if self.size >= SHARD_IDS:
                yield self.close()

    def close(self) -> tuple:
        keys = np.array([k for k in self.keys if k is not None], "<i8")
        nulls = len(self.keys) - len(keys)
        index = Index.build(nulls, keys, np.concatenate(self.lengths))
        row = (self.part, self.seq, int(keys[0]) if len(keys) else None, int(keys[-1]) if len(keys) else None,
               len(self.keys), self.size, 2 if self.kind == "<u2" else 4,
               b"".join(i.tobytes() for i in self.ids), keys.tobytes(), index.dump())
        self.seq += 1
        self.ids, self.lengths, self.keys, self.size = [], [], [], 0
        return row


_COLUMNS = [c.split()[0] for c in SHARD.split(", ")]


def _shards(path: str, end_id: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        width = 2 if max(len(encoder.last) - 1, end_id) < 1 << 16 else 4
        writer = None
        for f in frames:
            texts = f["text"].tolist()
            keys = [None if pd.isna(k) else int(k) for k in f["key"]]
            writer = writer or _Writer(int(f["part"].iat[0]), width)
            a = chars = 0
            for i in range(len(texts) + 1):
                if i == len(texts) or (chars and chars + len(texts[i]) > CHUNK_CHARS):
                    if a < i:
                        ids, counts = encoder.encode(texts[a:i])
                        ids = np.insert(ids, np.cumsum(counts), end_id)
                        for row in writer.add(keys[a:i], ids, counts + 1):
                            yield pd.DataFrame([row], columns=_COLUMNS)
                    a, chars = i, 0
                if i < len(texts):
                    chars += len(texts[i])
        if writer and writer.keys:
            yield pd.DataFrame([writer.close()], columns=_COLUMNS)

    return run


def write_ids(df: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, key_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Encode every text of ``df`` and write the shards to ``path``; returns them as read back.

    Ascending by key, null keys first; rows that repeat a key are ordered by their text's hash.  A null text is empty: its ids
    are the end id alone.  An empty table writes no shard.  ``tokenizer`` is a file that every worker can read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(key_col).cast("long").alias("key"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(max(1, -(-size // TASK_BYTES)), *order).sortWithinPartitions(*order)
    dealt.withColumn("part", F.spark_partition_id()).mapInPandas(_shards(tokenizer, end_id), SHARD).write.parquet(path)
    return df.sparkSession.read.schema(SHARD).parquet(path)


def _documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document's ids, found through the index by its key."""
    for f in frames:
        for s in f.itertuples(index=False):
            index, keys = Index.load(s.index), np.frombuffer(s.keys, "<i8")
            row, many = index.find(keys)
            # rows of a repeated key follow each other, and so do its entries in ``keys``
            nth = np.arange(len(keys)) - np.searchsorted(keys, keys)
            if not (many > nth).all():
                raise ValueError(f"index of shard {s.part}/{s.seq} misses a key")
            rows = np.concatenate([np.arange(index.nulls), row + nth])
            ids = np.frombuffer(s.payload, "<u2" if s.width == 2 else "<u4").astype("<u4")
            a, b = index.offsets[rows].astype(np.int64), index.offsets[rows + 1].astype(np.int64)
            yield pd.DataFrame({
                "part": s.part, "seq": s.seq,
                "key": pd.array([None] * index.nulls + keys.tolist(), dtype="Int64"), "at": a, "n_ids": b - a,
                "crc": [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(a, b)]})


def read_documents(shards: DataFrame) -> DataFrame:
    """Rows (key, start, n_ids, crc) of a dataset: ``start`` counts the ids of all documents before."""
    sizes = shards.select("part", "seq", "n_ids")
    upto = materialize(running_totals(sizes, ["part", "seq"], {"upto": F.col("n_ids")}, "id-shards").select(
        "part", "seq", (F.col("upto") - F.col("n_ids")).alias("before")), "id-starts")
    docs = shards.select("part", "seq", "width", "payload", "keys", "index").mapInPandas(
        _documents, "part int, seq int, key bigint, at bigint, n_ids bigint, crc bigint")
    return docs.join(upto, ["part", "seq"]).select("key", (F.col("before") + F.col("at")).alias("start"), "n_ids", "crc")


def lookup(shards: DataFrame, keys: list[int]) -> DataFrame:
    """Rows (key, ids) of the given keys by keyed access; absent keys have none, repeated documents one row each.

    A stated set of keys: shards whose key range holds none of them are skipped by the scan's statistics."""
    wanted = np.unique(np.asarray(keys, np.int64))

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in f.itertuples(index=False):
                near = wanted[(wanted >= s.first_key) & (wanted <= s.last_key)]
                index = Index.load(s.index)
                row, many = index.find(near)
                ids = np.frombuffer(s.payload, "<u2" if s.width == 2 else "<u4").astype(np.int64)
                out = [(int(k), ids[int(index.offsets[r + j]):int(index.offsets[r + j + 1])].tolist())
                       for k, r, m in zip(near, row, many) for j in range(m)]
                yield pd.DataFrame(out, columns=["key", "ids"])

    if not len(wanted):
        return shards.sparkSession.createDataFrame([], "key bigint, ids array<bigint>")
    held = shards.where((F.col("first_key") <= int(wanted[-1])) & (F.col("last_key") >= int(wanted[0])))
    return held.select("first_key", "last_key", "width", "payload", "index").mapInPandas(
        fetch, "key bigint, ids array<bigint>")


def op9_token_ids(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    shards = write_ids(docs, scratch_path(spark, "token-ids"), public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(shards).select(
        F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


QUERIES = {"op9_token_ids": op9_token_ids}
ORACLE = {}
