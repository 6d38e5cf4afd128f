"""Hashes of words and of runs of words, for whole Arrow batches at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as texts have needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(2 * n, _BASE, _U), np.full(2 * n, pow(_BASE, -1, 2**64), _U)
            for step in steps:
                step[0] = 1
            self.up, self.down = map(np.cumprod, steps)
        return self.up, self.down


_powers = _Powers()


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between the offsets, and the number of words before each offset."""
    size = len(data)
    if not size:
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    word = ~_GAP[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = offsets[(offsets > 0) & (offsets < size)]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers.upto(size + 1)
    sums = np.zeros(size + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:size], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mixed(value + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93)), np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts of about ``most`` bytes, or single longer ones: the index of the first, the
    hashes of all their words, and where each text's words begin and the last one's end.

    Words are runs of bytes other than the six ASCII gaps; a text is hashed whole. Null: empty.
    """
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        after = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        after = min(after, n)
        begin = offsets[first]
        hashes, bounds = _hashed(data[begin : offsets[after]], offsets[first : after + 1] - begin)
        yield first, hashes, bounds
        first = after


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words that begin at each word; the last ``n - 1`` have none."""
    count = max(len(hashes) - n + 1, 0)
    total = np.zeros(count, _U)
    for i in range(n):
        total = (total * _U(0x100000001B3)) ^ mixed(hashes[i : i + count] + _U(i))
    return mixed(total)


def long_runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Other hashes of the runs of ``n`` words, in a time that doesn't grow with ``n``."""
    count = max(len(hashes) - n + 1, 0)
    up, down = _powers.upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mixed((sums[n : n + count] - sums[:count]) * down[:count])
