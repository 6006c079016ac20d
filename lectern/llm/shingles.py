"""Words and word shingles of a text as 64-bit hashes, in numpy; used inside tasks.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, which is what ``bytes.lower().split()``
gives. A text's set holds its distinct shingles of five words; a shorter text is one shingle of
all its words, and a text without words (or null) has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

SHINGLE = 5
_KEPT_WORDS = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
# One odd multiplier for each place of a word in its shingle.
_PLACES = np.array([xxhash.xxh64_intdigest(f"place {j}") | 1 for j in range(SHINGLE)], dtype=np.uint64)


class _WordHashes(dict):
    """Hashes of the words met so far in this worker; emptied when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of ``text`` as sorted unsigned 64-bit hashes."""
    found = words(text)
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(SHINGLE, len(found))
    count = len(found) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for j in range(width):
        total += hashes[j : j + count] * _PLACES[j]
    return np.unique(_mixed(total))


def as_long(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return values.view(np.int64)


def portions(lengths: list[int], limit: int = 1_000_000) -> Iterator[slice]:
    """Slices of consecutive rows whose lengths add up to about ``limit`` (one row at least)."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total + n > limit and i > start:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield slice(start, len(lengths))
