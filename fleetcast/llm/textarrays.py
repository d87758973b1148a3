"""Numpy views of Arrow text batches, shared by the operators that read words.

A batch is cut into slices of a few MB, and everything below works on one
slice: its bytes with one separator after each text, word and line positions,
and hashes of any byte or word range in O(1) from prefix sums.  Words are the
runs of bytes other than 0x20 and 0x09-0x0D; in UTF-8 these bytes are never
part of a longer character, so byte positions are enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so that they have inverses mod 2^64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` mod 2^64 for i < n (kept between calls up to a few slices)."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        base = _BASES[which]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 4 * SLICE_BYTES:
            _POWERS[which] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark longs."""
    return x.view(np.int64)


class Ranges:
    """Hashes of ranges of an array of numbers."""

    def __init__(self, values: np.ndarray, which: int = 0):
        fwd, self._back = powers(which, len(values) + 1)
        self._sums = np.zeros(len(values) + 1, U)
        np.cumsum(values.astype(U, copy=False) * fwd[:len(values)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``values[start:end]``, the same wherever the range stands; lengths count too."""
        raw = (self._sums[end] - self._sums[start]) * self._back[start]
        return mix(raw + (end - start).astype(U) * U(0xA24BAED4963EE407))


class Texts:
    """Words and lines of a slice of texts."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        if pa.types.is_large_string(texts.type):
            offs = np.frombuffer(texts.buffers()[1], np.int64)
        else:
            offs = np.frombuffer(texts.buffers()[1], np.int32)
        offs = offs[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offs[0]:offs[-1]]
        offs = offs - offs[0]
        self.n = len(texts)
        self.bytes = np.insert(raw, offs[1:], 0x20)
        self.start = offs[:-1] + np.arange(self.n)          # of each text in ``bytes``
        self.end = offs[1:] + np.arange(self.n)
        b = self.bytes
        self.in_word = (b != 0x20) & ((b < 9) | (b > 13))
        edge = np.flatnonzero(np.diff(self.in_word, prepend=False, append=False))
        self.word_start, self.word_end = edge[::2], edge[1::2]
        self.first_word = np.searchsorted(self.word_start, np.append(self.start, len(b)))
        self.n_words = np.diff(self.first_word)

    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def word_hash(self, which: int = 0, values: np.ndarray | None = None) -> np.ndarray:
        b = self.bytes if values is None else values
        return Ranges(b.astype(U) + U(1), which).of(self.word_start, self.word_end)

    def shingles(self, words: np.ndarray, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of every run of k words inside one text."""
        at = np.arange(len(words))
        last = np.repeat(self.first_word[1:], self.n_words)
        at = at[at + k <= last]
        return at, Ranges(words, which).of(at, at + k)

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """Number of true bytes in each text."""
        sums = np.concatenate(([0], np.cumsum(mask)))
        return sums[self.end] - sums[self.start]

    def lowered(self) -> np.ndarray:
        """The bytes with A-Z as a-z."""
        b = self.bytes.copy()
        b[(b >= 0x41) & (b <= 0x5A)] += 0x20
        return b


def in_doc(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One key for (text of the slice, hash)."""
    return mix(h + mix(doc.astype(U) + U(0x632BE59BD9B4E019)))


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys, and the length of the array at the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]))


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over x[i:i+width], for each i that has a whole window."""
    out, have = x, 1
    while have * 2 <= width:
        out = op(out[:-have], out[have:]) if len(out) > have else out[:0]
        have *= 2
    rest = width - have
    if rest:
        out = op(out[:-rest], out[rest:]) if len(out) > rest else out[:0]
    return out


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[i], start[i]+1, ... length[i] numbers each, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text, one text at least."""
    if not batch.num_rows:
        return
    texts = batch.column(column)
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offs = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
