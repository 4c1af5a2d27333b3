"""Word and shingle hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_BYTES = np.random.default_rng(12345).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Separators of words: space and the five control characters from tab to return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers so that all their bits depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes of the words of texts, A-Z lower-cased; words are what stands between ``separators``."""

    def __init__(self, separators: np.ndarray = _SPACE):
        self.separators = separators
        self._size = 0

    def _tables(self, n: int) -> None:
        if n > self._size:
            self._size = max(n, CHUNK_BYTES)
            self._up, self._down = _powers(_BASE, self._size), _powers(_INVERSE, self._size)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of the texts ``data[starts:ends]`` that lie one after the other, and where each text's begin."""
        low, high = int(starts[0]), int(ends[-1])
        text = data[low:high]
        n = len(text)
        if n == 0:
            return np.empty(0, dtype=np.uint64), np.zeros(len(starts) + 1, dtype=np.int64)
        self._tables(n + 1)
        text = _LOWER[text]
        inside = ~self.separators[text]
        before = np.empty(n, dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        first = starts - low
        before[first[first < n]] = False
        begin = np.flatnonzero(inside & ~before)
        after = np.empty(n, dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        last = ends - low - 1
        after[last[ends > starts]] = False
        end = np.flatnonzero(inside & ~after) + 1
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTES[text] * self._up[:n], out=sums[1:])
        hashes = mixed((sums[end] - sums[begin]) * self._down[begin] + (end - begin).astype(np.uint64))
        bounds = np.searchsorted(begin, np.append(first, n))
        return hashes, bounds


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of an Arrow string column; null texts are empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of fewer words, the one whole sequence."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(n, width)
    out = np.zeros(n - k + 1, dtype=np.uint64)
    for j in range(k):
        out += mixed(hashes[j : n - k + 1 + j] ^ _STEPS[j % 5]) * _STEPS[(j + 1) % 5]
        out = out * _BASE
    return mixed(out + np.uint64(k))
