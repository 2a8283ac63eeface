"""Exact, batch-wise encoding with a word-level tokenizer of the ``tokenizers`` library (runs inside tasks).

The tokenizer of "word_bpe" files normalises, splits into pieces (letters,
single digits, other signs, the contractions of English) and encodes every
piece alone, so a piece always gets the same ids.  Texts of Latin letters are
therefore split with array operations, each distinct piece of a batch is
looked up once, and only pieces not seen lately go to the library.  All other
texts (other scripts, control characters, special tokens' strings) go to the
library whole; the result is the same either way.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, normalizers, pre_tokenizers

# Texts with other characters than these take the library's own path.  Below U+0180 every character is its own normal
# form, lower case has the same class, and two UTF-8 bytes at most.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įĲ-ňŊ-ž]*")
CACHE_PIECES = 300_000  # pieces remembered per worker; forgetting them only costs encoding them again

_SPACE, _LETTER, _DIGIT, _SIGN = range(4)


def _class_of(c: str) -> int:
    return _SPACE if c.isspace() else _LETTER if c.isalpha() else _DIGIT if c.isnumeric() else _SIGN


def _tables() -> tuple[np.ndarray, np.ndarray]:
    one = np.zeros(128, np.uint8)
    for c in range(128):
        one[c] = _class_of(chr(c))
    two = np.zeros(0x180, np.uint8)
    for c in range(0x80, 0x180):
        two[c] = _class_of(chr(c))
    return one, two


_ONE, _TWO = _tables()
_CONTRACTED = [(b"re", 2), (b"ve", 2), (b"ll", 2), (b"s", 1), (b"t", 1), (b"m", 1), (b"d", 1)]


class Encoder:
    """Encodes lists of texts to one flat id array and the number of ids of each text."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.piece = Tokenizer.from_file(path)
        self.piece.normalizer = normalizers.Sequence([])
        self.piece.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.last[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}   # piece -> its number; piece k has the ids flat[first[k]:first[k + 1]]
        self.flat, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _fast(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts), as ``encode_batch(texts, add_special_tokens=False)`` gives them."""
        fast = np.fromiter((self._fast(t) for t in texts), bool, len(texts))
        ids, counts = self._pieces([t for t, f in zip(texts, fast) if f])
        if fast.all():
            return ids, counts
        parts, each = [], np.zeros(len(texts), np.int64)
        each[fast] = counts
        own = np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []
        others = iter([np.asarray(e.ids, np.uint32) for e in self.whole.encode_batch(
            [t for t, f in zip(texts, fast) if not f], add_special_tokens=False)])
        own = iter(own)
        for i, f in enumerate(fast):
            parts.append(next(own) if f else next(others))
            each[i] = len(parts[-1])
        return np.concatenate(parts), each

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        raws = [t.lower().encode() for t in texts]
        buf = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
        ends = np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws)))
        kind = _ONE[buf & 0x7F]
        lead = np.flatnonzero(buf >= 0xC0)  # a lead byte and its one continuation byte have one class
        if len(lead):
            kind[lead] = kind[lead + 1] = _TWO[((buf[lead] & 0x1F).astype(np.int32) << 6) | (buf[lead + 1] & 0x3F)]
        start = np.empty(len(buf), bool)
        start[0] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start |= (kind == _DIGIT) & ((buf < 0x80) | (buf >= 0xC0))
        self._contractions(buf, kind, start)
        solid = kind != _SPACE
        at = np.flatnonzero(start & solid)
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        kept = np.cumsum(solid, dtype=np.int32)  # bytes that are not white space, up to and with each byte
        offsets = np.concatenate([kept[at] - 1, kept[-1:]])
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(buf[solid])])
        coded = pieces.dictionary_encode()
        which = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        begin = self.first[which]
        n = self.first[which + 1] - begin
        total = np.cumsum(n)
        ids = self.flat[np.arange(total[-1]) + np.repeat(begin - (total - n), n)]
        upto = np.concatenate([[0], total])[np.searchsorted(at, ends)]
        return ids, np.diff(np.concatenate([[0], upto]))

    @staticmethod
    def _contractions(buf: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
        """A lone apostrophe takes the letters of a contraction with it; what follows them is a new piece."""
        a = np.flatnonzero((buf[:-1] == 0x27) & start[:-1] & start[1:])
        if not len(a):
            return
        padded = np.concatenate([buf, np.zeros(3, np.uint8)])
        taken = np.zeros(len(a), np.int64)
        for letters, n in reversed(_CONTRACTED):
            same = padded[a + 1] == letters[0]
            if n == 2:
                same &= padded[a + 2] == letters[1]
            taken[same] = n
        hit = taken > 0
        a, taken = a[hit], taken[hit]
        start[a + 1] = False
        after = a + 1 + taken
        inside = after < len(start)
        start[after[inside]] = True

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The numbers of distinct pieces; those not known are encoded and remembered."""
        unseen = [p for p in pieces if p not in self.known]
        if len(self.known) + len(unseen) > CACHE_PIECES:
            self._forget()
            unseen = pieces
        flat, ends = [self.flat], [self.first]
        for i in range(0, len(unseen), 4096):
            ids = np.asarray(self.piece.encode_batch_fast(
                [b" ".join(unseen[i:i + 4096]).decode()], add_special_tokens=False)[0].ids, np.uint32)
            flat.append(ids)
            ends.append(ends[-1][-1] + np.flatnonzero(self.last[ids]) + 1)
        if unseen:
            self.known.update(zip(unseen, range(len(self.known), len(self.known) + len(unseen))))
            self.flat, self.first = np.concatenate(flat), np.concatenate(ends)
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
