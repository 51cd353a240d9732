"""Words and word shingles of many documents at once, as numpy arrays.

Texts arrive lower-cased from Spark (``F.lower``). A word is a run of ASCII letters and
digits and of any byte beyond ASCII; everything else stands between words. Documents
are handled a megabyte at a time, a longer one by itself, so memory follows the
longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
CHUNK_BYTES = 1 << 20
_RANDOM = np.random.default_rng(7)
_ODD = lambda n: _RANDOM.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE, _PLACE, _STEP = _ODD(256), _ODD(64), _ODD(WIDTH)
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[128:] = True
for _low, _high in ((48, 57), (65, 90), (97, 122)):
    _IN_WORD[_low:_high + 1] = True


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Hashes of the words of some documents; document d has words first[d] to first[d + 1]."""

    hashes: np.ndarray
    first: np.ndarray

    def shingles(self, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``width`` words, and where each document's begin.

        A document with fewer words, but at least one, has one window of all of them.
        """
        h, first = self.hashes, self.first
        n = np.diff(first)
        counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
        begin = np.concatenate(([0], np.cumsum(counts)))
        out = np.zeros(begin[-1], dtype=np.uint64)
        if len(out) == 0:
            return out, begin
        at = np.repeat(first[:-1] - begin[:-1], counts) + np.arange(len(out))
        last = np.repeat(first[1:], counts)
        for j in range(width):
            inside = at + j < last
            out += np.where(inside, h[np.minimum(at + j, len(h) - 1)] * _STEP[j], np.uint64(0))
        return mixed(out), begin


@dataclass
class Text:
    """Bytes of some documents with a line feed after each, and the words in them."""

    data: np.ndarray
    inside: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A hash for each word, from its bytes and length."""
        if len(self.starts) == 0:
            return np.zeros(0, dtype=np.uint64)
        at, lengths = np.flatnonzero(self.inside), self.ends - self.starts
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(len(at)) - np.repeat(begin, lengths)
        # beyond 64 bytes the multipliers repeat; the block number keeps the places apart
        value = _BYTE[self.data[at]] * _PLACE[place & 63]
        if (long := place >= 64).any():
            value[long] = mixed(value[long], 1) * (place[long] >> 6).astype(np.uint64)
        return mixed(np.add.reduceat(value, begin) + lengths.astype(np.uint64))


def split(texts: list[bytes], word_bytes: np.ndarray = _IN_WORD) -> Text:
    """Words are the runs of bytes for which ``word_bytes`` is true; no line feed may be one."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = word_bytes[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    return Text(data, inside, edges[::2], edges[1::2], np.searchsorted(edges[::2], np.concatenate(([0], np.cumsum(sizes)))))


def word_hashes(texts: list[bytes]) -> Words:
    text = split(texts)
    return Words(text.hashes(), text.first)


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each; a longer text is a slice by itself."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size + 1
        if begin < len(sizes):
            yield batch.slice(begin)


def chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the bytes of their texts (null: none)."""
    for piece in pieces(batches, column, CHUNK_BYTES):
        yield piece, [text or b"" for text in piece.column(column).cast(pa.binary()).to_pylist()]


def distinct(shingles: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of every document sorted and once each."""
    shingles = shingles.copy()
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        shingles[a:b].sort()
    if len(shingles) == 0:
        return shingles, begin
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = shingles[1:] != shingles[:-1]
    new[begin[:-1][np.diff(begin) > 0]] = True
    return shingles[new], np.concatenate(([0], np.cumsum(new)))[begin]
