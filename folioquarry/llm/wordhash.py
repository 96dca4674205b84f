"""Vectorised hashing of the words of a UTF-8 text with numpy.

A word is a maximal run of bytes outside ``0x20`` and ``0x09-0x0D``; in UTF-8 those bytes
never occur inside a longer character. Every word gets a 64-bit polynomial hash (modulo
2**64, then mixed), computed for all words of a text at once from prefix sums.

Long texts are worked in blocks that end at a separator, so memory stays bounded by
``BLOCK`` bytes (or by the longest single word) however long the text is.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 19
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_MASK = (1 << 64) - 1

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; those of a block are kept, longer ones are not."""
    if _tables and n <= len(_tables[0]):
        return _tables[0][:n], _tables[1]
    found = []
    for base in (_P, np.uint64(pow(int(_P), -1, 1 << 64))):
        powers = np.full(max(BLOCK + 1, n), base, dtype=np.uint64)
        powers[0] = 1
        found.append(np.cumprod(powers, dtype=np.uint64))
    if n <= BLOCK + 1:
        _tables[:] = found
    return found[0][:n], found[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the sequence ``values[starts[i]:ends[i]]`` for each i; equal sequences of bytes or of hashes give equal hashes."""
    powers, inverses = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[: len(values)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def blocks(data: np.ndarray, separator: np.ndarray = SEPARATOR):
    """Slices of ``data`` that end at a separator, of about ``BLOCK`` bytes; a longer word is not cut."""
    at, n = 0, len(data)
    while n - at > BLOCK:
        size = BLOCK
        while True:
            cut = np.flatnonzero(separator[data[at : at + size]])
            if len(cut) or at + size >= n:
                break
            size *= 2
        end = at + int(cut[-1]) + 1 if len(cut) else n
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """The hashes of all words of a text, in order. ``lower`` folds A-Z first."""
    out = []
    for part in blocks(data):
        if len(part):
            part = LOWER[part] if lower else part
            starts, ends = runs(~SEPARATOR[part])
            if len(starts):
                out.append(span_hashes(part, starts, ends))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` words; with fewer words, of the whole sequence as one."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    h = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n])
    return h


def byte_rows(column) -> list[np.ndarray | None]:
    """The texts of an Arrow string column as arrays of bytes without a copy; None for null."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    null = column.is_null().to_numpy(zero_copy_only=False)
    return [None if null[i] else raw[at[i] : at[i + 1]] for i in range(len(column))]
