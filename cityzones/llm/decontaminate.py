"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into overlapping fragments.  A fragment of m characters
that occurs with at most k edits shares at least m + 1 - q (k + 1) of its
q-grams with the place, all within k diagonals of each other.  So a document is
first searched for zones with that many q-grams of any item; the q-grams of
these zones are counted per fragment in overlapping bands of diagonals; bands
that reach the bound are verified by a banded alignment.  The filter loses no
place within the edit budget.

Text is compared by letters and digits in lower case; everything between them
is one space.  The benchmark is the stated query set: it is read in blocks of
bounded size, each an index that the tasks hold while all documents stream by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityzones.llm.hashing import mix, powers

GRAM = 10
FRAGMENT, STRIDE = 80, 40   # characters of a fragment, and from one to the next
EDIT_PERCENT = 5            # of a fragment's characters
LEAST_CHARS = 32            # shorter items hold too few q-grams for a bound: found as whole words, without edits
BLOCK_CHARS = 2_000_000     # of benchmark text per index
CHUNK_CHARS = 2_000_000     # of documents at once
_U = np.uint64
_RNG = np.random.default_rng(7741)
_CODES = 1 << 16
_FILTER_BITS = 22

HITS = "doc_id bigint, item_id bigint, start bigint, end bigint, edits int, n_fragments int, n_found int"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower, word) by code point below 65536: lower-case form where that is one character; is it a letter or digit?"""
    lower = np.arange(_CODES, dtype=np.uint32)
    word = np.zeros(_CODES, bool)
    for c in range(_CODES):
        ch = chr(c)
        low = ch.lower()
        if len(low) == 1 and ord(low) < _CODES:
            lower[c] = ord(low)
        word[c] = ch.isalnum()
    return lower, word


_LOWER, _WORD = _tables()
_RANDOM = _RNG.integers(0, 2**64, _CODES, dtype=np.uint64)


def normalise(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, origin, first) of a list of texts laid end to end, a separator 0 after each.

    ``origin[i]`` is the code point position, within its text, of normalised character i; text d is
    codes[first[d]:first[d + 1] - 1]."""
    texts = ["" if t is None else t for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths)
    low = np.minimum(raw, _CODES - 1)
    codes, word = _LOWER[low], _WORD[low]
    rare = raw >= _CODES
    if rare.any():
        codes, word = np.where(rare, raw, codes), word | rare
    last = ends - 1  # the separators
    codes = np.where(word, codes, np.uint32(32))
    codes[last], word[last] = 0, True
    before = np.concatenate([[True], ~word[:-1]])
    before[ends[:-1]] = True  # no space at the beginning of a text
    keep = word | ~before
    at = np.flatnonzero(keep)
    doc = np.searchsorted(ends, at, "right")
    first = np.concatenate([[0], np.searchsorted(at, last) + 1])
    return codes[at], at - (ends - lengths)[doc], first


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at every position where one fits; those that hold a separator get hash 0."""
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(codes) + 1)
    s = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_RANDOM[codes & np.uint32(_CODES - 1)] * up[:-1], out=s[1:])
    h = mix((s[GRAM:] - s[:-GRAM]) * down[:n]) | _U(1)
    gaps = np.concatenate([[0], np.cumsum(codes == 0)])
    h[gaps[GRAM:] != gaps[:-GRAM]] = 0
    return h


@dataclass
class Index:
    """A block of the benchmark: items laid end to end, their q-grams sorted by hash, and their fragments."""

    ids: list[int]
    codes: np.ndarray
    first: np.ndarray
    hashes: np.ndarray      # sorted, one per posting
    at: np.ndarray          # position in codes
    filter: np.ndarray      # by the hash's leading bits: may it be a q-gram of the block?
    begin: np.ndarray       # of each fragment, ascending, a position in codes
    length: np.ndarray
    budget: np.ndarray      # edits
    needed: np.ndarray      # shared q-grams
    least: int              # the smallest of ``needed``
    item: np.ndarray        # of each fragment
    short: dict             # items (by number) of each text below LEAST_CHARS, words between single spaces

    @classmethod
    def build(cls, ids: list[int], texts: list[str]) -> Index:
        codes, _, first = normalise(texts)
        begin, length, item, short = [], [], [], {}
        for d, (a, b) in enumerate(zip(first[:-1].tolist(), (first[1:] - 1).tolist())):
            if b > a and codes[b - 1] == 32:
                b -= 1
            if b - a < LEAST_CHARS:
                words = _characters(codes[a:b]).strip(" ")
                if words:
                    short.setdefault(words, []).append(d)
                continue
            starts = [*range(a, max(a, b - FRAGMENT), STRIDE), max(a, b - FRAGMENT)]
            for s in starts:
                begin.append(s)
                length.append(min(FRAGMENT, b - s))
                item.append(d)
        begin, length, item = (np.array(x, np.int64) for x in (begin, length, item))
        budget = length * EDIT_PERCENT // 100
        needed = length + 1 - GRAM * (budget + 1)
        h = grams(codes)
        inside = np.zeros(len(h) + 1, np.int64)  # q-grams of some fragment
        if len(begin):
            np.add.at(inside, begin, 1)
            np.add.at(inside, begin + length - GRAM + 1, -1)
        at = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & (h != 0))
        order = np.argsort(h[at], kind="stable")
        table = np.zeros(1 << _FILTER_BITS, bool)
        table[(h[at] >> _U(64 - _FILTER_BITS)).astype(np.int64)] = True
        return cls(ids, codes, first, h[at][order], at[order], table, begin, length, budget, needed,
                   int(needed.min()) if len(needed) else 1, item, short)

    def dictionary(self) -> ahocorasick.Automaton:
        """The short texts between spaces, built once per worker."""
        if not hasattr(self, "_dictionary"):
            self._dictionary = ahocorasick.Automaton()
            for words in self.short:
                self._dictionary.add_word(f" {words} ", words)
            self._dictionary.make_automaton()
        return self._dictionary


def _zones(index: Index, h: np.ndarray) -> np.ndarray:
    """Positions of known q-grams that lie close to enough others to reach the smallest bound."""
    at = np.flatnonzero(index.filter[(h >> _U(64 - _FILTER_BITS)).astype(np.int64)])
    k = np.searchsorted(index.hashes, h[at])
    at = at[index.hashes[np.minimum(k, len(index.hashes) - 1)] == h[at]]
    if len(at) < index.least:
        return at[:0]
    span = FRAGMENT + int(index.budget.max()) - GRAM
    full = np.flatnonzero(at[index.least - 1:] - at[:len(at) - index.least + 1] <= span)
    mark = np.zeros(len(at) + 1, np.int64)
    np.add.at(mark, full, 1)
    np.add.at(mark, full + index.least, -1)
    return at[np.cumsum(mark[:-1]) > 0]


def _bands(index: Index, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, diagonal): bands of 2 (k + 1) diagonals from that one on that hold enough of the fragment's q-grams.

    Bands overlap by half, so any k + 1 neighbouring diagonals lie in one.  A q-gram of the document counts once."""
    low = np.searchsorted(index.hashes, h[at])
    n = np.searchsorted(index.hashes, h[at], "right") - low
    total = np.cumsum(n)
    where = np.repeat(at, n)
    post = index.at[np.arange(total[-1] if len(total) else 0) + np.repeat(low - (total - n), n)]
    # the fragments that hold the posting: those that begin at it or shortly before
    last = np.searchsorted(index.begin, post, "right") - 1
    out = []
    reach = 1 + FRAGMENT // STRIDE + 1
    for back in range(reach):
        f = last - back
        ok = f >= 0
        f, p, w = f[ok], post[ok], where[ok]
        ok = p + GRAM <= index.begin[f] + index.length[f]
        f, p, w = f[ok], p[ok], w[ok]
        width = index.budget[f] + 1
        band = (w - p) // width
        for b in (band, band - 1):
            out.append((f, b, w))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    f, b, w = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((w, b, f))
    f, b, w = f[order], b[order], w[order]
    once = np.concatenate([[True], (f[1:] != f[:-1]) | (b[1:] != b[:-1]) | (w[1:] != w[:-1])])[:len(f)]
    f, b = f[once], b[once]
    new = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (b[1:] != b[:-1])])[:len(f)])
    count = np.diff(np.append(new, len(f)))
    f, b = f[new], b[new]
    good = count >= index.needed[f]
    return f[good], b[good] * (index.budget[f[good]] + 1)


def _align(index: Index, codes: np.ndarray, frag: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
    """Banded alignment of whole fragments: (edits, start, end) of the best place near each band, a position in codes.

    Row i of the table is the fragment's first i characters; column j is diagonal - budget + i + j of the document.
    Characters of the document before and after the place are free."""
    k = int(index.budget[frag].max()) if len(frag) else 0
    width = 2 * (k + 1) + 2 * k + 1
    begin, length = index.begin[frag], index.length[frag]
    base = begin + diagonal - index.budget[frag]
    far = 1 << 20
    cost = np.zeros((len(frag), width), np.int64)
    start = base[:, None] + np.arange(width)
    best, best_start, best_end = np.full(len(frag), far), np.zeros(len(frag), np.int64), np.zeros(len(frag), np.int64)
    for i in range(1, FRAGMENT + 1):
        live = i <= length
        if not live.any():
            break
        at = base[:, None] + i - 1 + np.arange(width)  # the document's character of each column
        inside = (at >= 0) & (at < len(codes))
        doc = np.where(inside, codes[np.clip(at, 0, len(codes) - 1)], 0)
        own = index.codes[np.minimum(begin + i - 1, len(index.codes) - 1)][:, None]
        new = cost + np.where((doc == own) & (doc != 0), 0, np.where(doc == 0, far, 1))
        from_ = start.copy()
        up = np.concatenate([cost[:, 1:], np.full((len(frag), 1), far)], axis=1) + 1   # a fragment character left out
        up_start = np.concatenate([start[:, 1:], start[:, -1:]], axis=1)
        take = up < new
        new, from_ = np.where(take, up, new), np.where(take, up_start, from_)
        for j in range(1, width):  # a document character left out
            side = new[:, j - 1] + np.where(doc[:, j] == 0, far, 1)
            take = side < new[:, j]
            new[:, j] = np.where(take, side, new[:, j])
            from_[:, j] = np.where(take, from_[:, j - 1], from_[:, j])
        cost, start = np.where(live[:, None], new, cost), np.where(live[:, None], from_, start)
        done = i == length
        if done.any():
            j = cost[done].argmin(axis=1)
            rows = np.flatnonzero(done)
            best[done], best_start[done] = cost[rows, j], start[rows, j]
            best_end[done] = base[rows] + i + j
    return best, best_start, best_end


def _characters(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _search_short(index: Index, doc_ids: list, codes: np.ndarray, origin: np.ndarray, first: np.ndarray) -> list[tuple]:
    """Rows of HITS of the short items: the first place in each document that holds all their words, unchanged."""
    text = " " + _characters(np.where(codes == 0, 32, codes)) + " "
    found: dict[tuple[int, str], tuple[int, int]] = {}
    for end, words in index.dictionary().iter(text):
        b = end - 1  # positions in codes: the text has a space more in front
        a = b - len(words)
        d = int(np.searchsorted(first, a, "right")) - 1
        if b < first[d + 1]:  # not across two documents
            found.setdefault((d, words), (a, b))
    return [(doc_ids[d], index.ids[item], int(origin[a]), int(origin[b - 1]) + 1, 0, 1, 1)
            for (d, words), (a, b) in sorted(found.items()) for item in index.short[words]]


def search(index: Index, doc_ids: list, texts: list[str | None]) -> list[tuple]:
    """Rows of HITS for the documents of one chunk."""
    if not len(index.hashes) and not index.short:
        return []
    codes, origin, first = normalise(texts)
    rows = _search_short(index, doc_ids, codes, origin, first) if index.short else []
    return rows + _search_long(index, doc_ids, codes, origin, first) if len(index.hashes) else rows


def _search_long(index: Index, doc_ids: list, codes: np.ndarray, origin: np.ndarray, first: np.ndarray) -> list[tuple]:
    """Rows of HITS of the items with fragments."""
    h = grams(codes)
    at = _zones(index, h)
    if not len(at):
        return []
    frag, diagonal = _bands(index, h, at)
    if not len(frag):
        return []
    edits, start, end = _align(index, codes, frag, diagonal)
    ok = edits <= index.budget[frag]
    found: dict[tuple[int, int], dict[int, tuple]] = {}
    for f, e, a, b in zip(frag[ok].tolist(), edits[ok].tolist(), start[ok].tolist(), end[ok].tolist()):
        d = int(np.searchsorted(first, a, "right")) - 1
        own = found.setdefault((d, int(index.item[f])), {})
        own[f] = min(own.get(f, (e, a, b)), (e, a, b))
    of_item = np.bincount(index.item, minlength=len(index.ids))
    rows = []
    for (d, item), frags in sorted(found.items()):
        rows.append((doc_ids[d], index.ids[item], int(origin[min(a for _, a, _ in frags.values())]),
                     int(origin[max(b for _, _, b in frags.values()) - 1]) + 1,
                     min(e for e, _, _ in frags.values()), int(of_item[item]), len(frags)))
    return rows


def _parts(texts: list) -> Iterator[tuple[int, int]]:
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > CHUNK_CHARS:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def _finder(index):
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in HITS.split(", ")]
        for f in frames:
            texts, ids = f["text"].tolist(), [None if pd.isna(k) else int(k) for k in f["doc_id"]]
            for a, b in _parts(texts):
                rows = search(index.value, ids[a:b], texts[a:b])
                yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64", "item_id": "Int64"})

    return find


def _dropper(index):
    def drop(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f["text"].tolist()
            leaks = np.zeros(len(f), bool)
            for a, b in _parts(texts):
                leaks[[r[0] for r in search(index.value, list(range(a, b)), texts[a:b])]] = True
            yield f[~leaks]

    return drop


def blocks(benchmark: DataFrame) -> Iterator:
    """Broadcast indexes of the benchmark (item_id, text), each of at most BLOCK_CHARS characters or one item.

    Null texts are empty; null ids stay null."""
    sc = benchmark.sparkSession.sparkContext
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = row["text"] or ""
        if texts and size + len(text) > BLOCK_CHARS:
            yield sc.broadcast(Index.build(ids, texts))
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(text)
        size += len(text)
    if texts:
        yield sc.broadcast(Index.build(ids, texts))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, start, end, edits, n_fragments, n_found): which items occur in which documents.

    start and end: code points of the text from the first to the last fragment found; edits: of the best fragment;
    n_found of the item's n_fragments occur.  Null and empty texts and items give no row.  Items below LEAST_CHARS characters
    are one fragment, found where all their words stand next to each other, unchanged and whole.  Repeated documents and
    items give a row each; repeats of an item inside a document give one."""
    found = docs.sparkSession.createDataFrame([], HITS)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    for index in blocks(benchmark):
        found = found.unionByName(rows.mapInPandas(_finder(index), HITS))
    return found


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a fragment of any benchmark item; one pass, nothing is shuffled."""
    for index in blocks(benchmark):
        docs = docs.mapInPandas(_dropper(index), docs.schema)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                      spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op1_decontamination": op1_decontamination}
ORACLE = {}
