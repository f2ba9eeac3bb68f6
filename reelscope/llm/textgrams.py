"""Word and n-gram hashes of whole text columns, vectorised in numpy.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``; as
these separators are ASCII, working on the UTF-8 bytes gives the same words
as working on characters.  A word's hash is a polynomial over its bytes with
a random value per byte, an n-gram's hash a rolling polynomial over its words'
hashes (both differences of two prefix sums, whatever the length), both modulo
2^64 and finalised, so equal texts have equal hashes in every task.  Everything runs over flat arrays of a slice of rows whose size
in bytes is bounded; a longer text is a slice of its own and is hashed in
segments that end at a separator.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SEGMENT_BYTES = 1 << 14  # its powers and sums stay near the processor

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)  # modulo 2^64


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of uint64."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
# Base of the n-gram polynomials and its inverse modulo 2^64.
_GRAM = 0xD1342543DE82EF95
_GRAM_INVERSE = pow(_GRAM, -1, 1 << 64)

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def _powers(n: int, base: int = _BASE) -> np.ndarray:
    p = np.full(n, base, dtype=_U)
    p[:1] = 1
    return np.multiply.accumulate(p)


@lru_cache(maxsize=2)
def _segment_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(n), _powers(n + 1, _BASE_INVERSE)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column laid end to end, and its row offsets."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()  # the worker lives on for other tasks


@dataclass
class Words:
    """Words of some texts: ``starts``/``ends`` are byte positions in ``data``."""

    data: np.ndarray
    rows: np.ndarray  # byte offsets of the texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @cached_property
    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the hashes before each word, times the base to the word's index, and the inverse powers."""
        n = len(self.hashes)
        sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(self.hashes * _powers(n, _GRAM), out=sums[1:])
        return sums, _powers(n, _GRAM_INVERSE)

    def run(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hashes of the runs of ``n`` words from each word index in ``at``."""
        sums, inverse = self._sums
        return mix((sums[at + n] - sums[at]) * inverse[at] + np.asarray(n).astype(_U))

    def gram(self, n: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions (word indexes) and hashes of the n-grams inside one text each."""
        room = np.repeat(self.first[1:], self.counts)  # one past the last word of the text
        at = np.arange(len(self.hashes)) if at is None else at
        at = at[at + n <= room[at]] if len(at) else at
        return at, self.run(at, n)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of byte spans in ascending order that do not overlap; with ``lower`` A-Z hash as a-z."""
    table = _BYTE_LOWER if lower else _BYTE
    hashes = np.empty(len(starts), dtype=_U)
    if not len(starts):
        return hashes
    power, inverse = _segment_powers(SEGMENT_BYTES)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SEGMENT_BYTES, side="right")))
        lo, hi = int(starts[at]), int(ends[to - 1])
        value = table.take(data[lo:hi])
        value *= power[: hi - lo] if hi - lo <= SEGMENT_BYTES else _powers(hi - lo)
        sums = np.zeros(hi - lo + 1, dtype=_U)
        np.cumsum(value, out=sums[1:])
        heads = starts[at:to] - lo  # only a span alone is longer than the segment, and begins at 0
        hashes[at:to] = (sums[ends[at:to] - lo] - sums[heads]) * inverse[heads]
        at = to
    return mix(hashes + (ends - starts).astype(_U))


def words(column: pa.Array, lower: bool = False, hashed: bool = True) -> Words:
    """Words of every text; with ``lower`` A-Z hash as a-z, without ``hashed`` their places only."""
    data, rows = utf8(column)
    inner = np.zeros(len(data) + 1, dtype=bool)  # True where a word may run on from the byte before
    inner[: len(data)] = ~_SEPARATOR[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[rows] = True
    before = np.r_[False, inner[:-1]]
    starts = np.flatnonzero(inner & (fresh | ~before))
    ends = np.flatnonzero(before & (fresh | ~inner))
    first = np.searchsorted(starts, rows)
    first[-1] = len(starts)
    hashes = span_hashes(data, starts, ends, lower) if hashed else np.zeros(0, dtype=_U)
    return Words(data, rows, starts, ends, first, hashes)


def sequences(w: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of all texts in order, and each text's
    first one.  A text of fewer words has its whole sequence as the one
    shingle, a text without words has none."""
    at, h = w.gram(n)
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        at = np.r_[at, w.first[short]]
        h = np.r_[h, w.run(w.first[short], w.counts[short])]
        order = np.argsort(at, kind="stable")
        at, h = at[order], h[order]
    return h, np.searchsorted(at, w.first)


def shingles(w: Words, n: int = 5) -> list[np.ndarray]:
    """Each text's distinct n-word shingles as a sorted array."""
    h, first = sequences(w, n)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        s = np.sort(h[a:b])
        out.append(s if len(s) < 2 else s[np.r_[True, s[1:] != s[:-1]]])
    return out
