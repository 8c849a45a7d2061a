"""64-bit hashes of all words of whole texts, with numpy inside tasks.

Words are runs of other bytes than the six ASCII white-space bytes; A-Z count as
a-z. A word's hash is a polynomial over random values of its bytes, modulo
2**64, taken from running sums over a stretch of bytes, then mixed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Bytes hashed at a time: bounds the memory a text of any length takes.
STRETCH = 1 << 20
#: Longer words are hashed alone.
LONG_WORD = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Tables:
    """Random values of bytes, and powers of the base and of its inverse; made once per worker."""

    def __init__(self):
        self.value = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64)
        self.value[65:91] = self.value[97:123]
        self.power = self._powers(_BASE)
        self.inverse = self._powers(pow(_BASE, -1, 1 << 64))

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        out = np.full(STRETCH + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)


_TABLES: list[_Tables] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stretches(data: bytes) -> Iterator[tuple[int, int]]:
    """Bounds of stretches that end at white space; a word that fills one is a stretch alone."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + STRETCH, n)
        if end < n:
            spaces = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, end - at, at)])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                while end < n:
                    more = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, min(STRETCH, n - end), end)])
                    if len(more):
                        end += int(more[0])
                        break
                    end = min(end + STRETCH, n)
        yield at, end
        at = end


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of ``data``."""
    if not _TABLES:
        _TABLES.append(_Tables())
    t, hashes, starts = _TABLES[0], [], []
    for at, end in _stretches(data):
        raw = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.concatenate([[False], ~_SPACE[raw], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[0::2], edges[1::2]
        size = last - first
        if len(raw) > STRETCH:
            found = np.zeros(len(first), np.uint64)
        else:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(t.value[raw] * t.power[:len(raw)], dtype=np.uint64)])
            found = mix((sums[last] - sums[first]) * t.inverse[first] + size.astype(np.uint64) * np.uint64(_BASE))
        for k in np.flatnonzero(size > LONG_WORD):
            word = data[at + int(first[k]):at + int(last[k])].lower()
            found[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        hashes.append(found)
        starts.append(first + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def batches_of(texts: list[bytes], limit: int = 2 * STRETCH) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: bounds, the hashes of all their words, and where each text's words begin (with the end)."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= limit):
            size += len(texts[last]) + 1
            last += 1
        data = b"\n".join(texts[first:last])
        begins = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts[first:last]])])
        hashes, starts = word_hashes(data)
        yield first, last, hashes, np.searchsorted(starts, begins)
        first = last
