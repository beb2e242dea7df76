"""Word spans and 64-bit word hashes of Arrow text columns, with numpy over the raw UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

# Byte classes: 0 separates, 1 letters, digits and all bytes of non-ASCII characters, 2 other signs.
CLASSES = np.zeros(256, np.uint8)
CLASSES[0x21:0x7F] = 2
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    CLASSES[ord(_first):ord(_last) + 1] = 1
CLASSES[0x80:] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and each text's offsets into them; null is empty."""
    array = array.cast(pa.large_binary()).fill_null(b"")
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset:array.offset + len(array) + 1] if buffers[1] else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one non-zero byte class, cut at text borders."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes[data]
    change = np.empty(len(data) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] > 0
    return starts[real], ends[real]


def mix(h: np.ndarray) -> np.ndarray:
    """Final avalanche of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < n:
        _tables["up"], _tables["down"] = _powers(_BASE, max(n, 2 * _BLOCK)), _powers(_INVERSE, max(n, 2 * _BLOCK))
    return _tables["up"], _tables["down"]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """Polynomial hash of every span after ``fold``, a block of bytes at a time."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _BLOCK)))
        first, last = int(starts[i]), int(ends[j - 1])
        up, down = _tables_for(last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((fold[data[first:last]].astype(np.uint64) + np.uint64(1)) * up[:last - first], out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mix(out)


def blocks(offsets: np.ndarray, size: int = 4 * _BLOCK):
    """Ranges of texts of about ``size`` bytes, one text at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = j


def owners(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the text that holds each position."""
    return np.searchsorted(offsets, starts, side="right") - 1
