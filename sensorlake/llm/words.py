"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of ASCII letters and digits and of any character beyond ASCII, with A-Z
lowered. Every byte of a character beyond ASCII is at least 0x80, so bytes can be
classified one by one without decoding.
"""

import numpy as np
import pyarrow as pa

#: Texts are taken in slices of about so many bytes; one longer text is a slice alone.
SLICE_BYTES = 1 << 21

_WORD = np.zeros(256, bool)
_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
for _a, _z in ((48, 57), (65, 90), (97, 122)):
    _WORD[_a : _z + 1] = True
_LOWER[65:91] += 32

# odd multipliers of the polynomial hashes
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_powers = {}


def mix(x):
    """Spreads the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base, n):
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def text_slices(column):
    """(first row, offsets, bytes) of consecutive rows of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(n, max(row + 1, end))
        lo, hi = int(offsets[row]), int(offsets[end])
        yield row, offsets[row : end + 1] - lo, data[lo:hi]
        row = end


class Words:
    """The words of some texts: ``row`` of each, its bytes ``start:end`` in ``low``, its
    64-bit ``hash``; ``first[i]:first[i + 1]`` are those of text ``i``."""

    def __init__(self, offsets, data):
        self.low = _LOWER[data]
        inside = _WORD[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before &= ~cut[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after &= ~cut[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = self._hashes()

    def _hashes(self):
        if not len(self.start):
            return np.zeros(0, np.uint64)
        n = len(self.low)
        terms = (self.low.astype(np.uint64) + np.uint64(1)) * _power(_BYTE_BASE, n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=total[1:])
        undo = _power(pow(_BYTE_BASE, -1, 1 << 64), n)
        value = (total[self.end] - total[self.start]) * undo[self.start]
        return mix(value + (self.end - self.start).astype(np.uint64) * np.uint64(_WORD_BASE))

    def __len__(self):
        return len(self.start)

    def counts(self):
        return np.diff(self.first)

    def word(self, i):
        return self.low[self.start[i] : self.end[i]].tobytes()

    def grams(self, k):
        """Hash of the k words from each word on, and whether one text holds them all."""
        return grams(self.hash, k), whole(self.row, k)


def grams(hashes, k):
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    factor = 1
    for j in range(min(k, n)):
        total[: n - j] += hashes[j:] * np.uint64(factor)
        factor = factor * _WORD_BASE % (1 << 64)
    return mix(total)


def whole(rows, k):
    ok = np.zeros(len(rows), bool)
    if len(rows) >= k:
        ok[: len(rows) - k + 1] = rows[k - 1 :] == rows[: len(rows) - k + 1]
    return ok
