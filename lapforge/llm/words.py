"""Vectorised words, hashes and shingles of many texts at once (numpy, in tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 18  # texts are hashed in blocks of about this many bytes
MULTIPLIER = np.uint64(0x9E3779B97F4A7C13)

_A, _B, _C = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def byte_table(separators: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(byte -> is it part of a word, byte -> the byte after A-Z lower-casing)."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    same = np.arange(256, dtype=np.uint8)
    if lower:
        same[65:91] += 32
    return inside, same


# words of the n-gram join: anything but space and \t \n \v \f \r
SPACES = byte_table(b" \t\n\x0b\x0c\r")
# words of letters, digits and non-ASCII bytes
LETTERS = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(256, dtype=np.uint64), 7)


class Hasher:
    """Word hashes by one polynomial prefix sum over a block of bytes."""

    def __init__(self, table: tuple[np.ndarray, np.ndarray]):
        self.inside, same = table
        self.codes = _CODES[same]
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
        first = np.ones(n, np.uint64)
        first[1:] = MULTIPLIER
        self.up = np.multiply.accumulate(first)
        first[1:] = inverse
        self.down = np.multiply.accumulate(first)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every span of bytes."""
        if len(data) > len(self.up):
            self._powers(max(len(data), BLOCK_BYTES + (BLOCK_BYTES >> 1)))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.down[starts], 1)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word, index of its text), in order."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        inside = self.inside[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        return self.spans(data, starts, ends), np.searchsorted(np.cumsum(lengths), starts, side="right")

    def grams(self, texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every run of ``width`` word bytes, index of its text)."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        n = len(data) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        inside = self.inside[data]
        whole = inside[:n].copy()
        for j in range(1, width):
            whole &= inside[j:n + j]
        at = np.flatnonzero(whole)
        codes = self.codes[data]
        h = np.zeros(len(at), np.uint64)
        for j in range(width):
            h = h * MULTIPLIER + codes[at + j]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return mix(h, 3), np.searchsorted(np.cumsum(lengths), at, side="right")


def blocks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about BLOCK_BYTES together: (index of the first, texts)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_BYTES:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def shingles(h: np.ndarray, owner: np.ndarray, n_texts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles per text: (hash, owner), sorted by owner, hash.

    A text of fewer words has its whole sequence as its one shingle; a text
    without words has none.
    """
    counts = np.bincount(owner, minlength=n_texts)
    total = len(h)
    k = np.full(total, 0, np.uint64)
    first = np.cumsum(counts) - counts
    if total >= width:
        full = np.zeros(total - width + 1, np.uint64)
        for j in range(width):
            full = full * _C + h[j:total - width + 1 + j]
        k[:total - width + 1] = full
        valid = np.zeros(total, bool)
        valid[:total - width + 1] = owner[:total - width + 1] == owner[width - 1:]
    else:
        valid = np.zeros(total, bool)
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        s = first[i]
        value = np.uint64(counts[i])
        for j in range(counts[i]):
            value = value * _C + h[s + j]
        k[s], valid[s] = value, True
    k, who = mix(k[valid], 2), owner[valid]
    order = np.lexsort((k, who))
    k, who = k[order], who[order]
    if len(k):
        fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (who[1:] != who[:-1])))
        k, who = k[fresh], who[fresh]
    return k, who
