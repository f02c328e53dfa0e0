"""Words of Arrow batches as flat arrays, so that a task works on a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of words: ASCII letters and digits and everything beyond ASCII; A-Z become lower case.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_PRIME = 0x9E3779B97F4A7C15 | 1
_PRIME_INVERSE = pow(_PRIME, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base ** (0 .. n - 1), modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    return out[:n]


class Words:
    """The words of some texts: ``start`` and ``end`` in ``data`` (bytes), ``hash`` and ``doc`` of each,
    and ``first``, where the words of each text begin (with the total at the end).

    Words are runs of word bytes (``by_space=False``: letters, digits and bytes beyond ASCII) or of
    anything but ASCII white space. The hash is that of the folded bytes: A-Z in lower case, and in the
    first case accented Latin capitals too.
    """

    def __init__(self, texts: list[bytes], by_space: bool = False) -> None:
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.doc_start = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=self.doc_start[1:])
        inside = ~_IS_SPACE[data] if by_space else _IS_WORD[data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.raw = data
        self.data = _FOLD[data]
        if not by_space:
            # Latin capitals with accents: second bytes 80 to 9E after C3, but for the multiplication sign.
            accented = np.flatnonzero(data[:-1] == 0xC3) + 1
            second = data[accented]
            self.data[accented[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]] += 32
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.doc_start)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self._powers = None
        self._sums = None
        self.hash = mix64(self.span_hash(self.start, self.end))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A polynomial hash of the folded bytes of each span, wherever it stands."""
        if self._sums is None:
            n = len(self.data)
            weighted = (self.data.astype(np.uint64) + np.uint64(1)) * _powers(_PRIME, n)
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(weighted, out=self._sums[1:])
            self._powers = _powers(_PRIME_INVERSE, n + 1)
        return (self._sums[end] - self._sums[start]) * self._powers[start]

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def column_bytes(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8; null is empty."""
    if pa.types.is_large_string(column.type):
        return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20):
    """Parts of a batch whose texts take about ``most_bytes``, so that memory is bounded by the
    longest text and not by the batch."""
    lengths = np.array([len(x) + 64 for x in column_bytes(batch.column(column))], dtype=np.int64)
    part = np.cumsum(lengths) // most_bytes
    begin = 0
    for stop in [*(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]:
        if stop > begin:
            yield batch.slice(begin, stop - begin)
        begin = stop
