"""Stretches of words that repeat with a period, by string synchronising sets.

A run is found at the scale to which its period belongs. At a scale, positions are chosen by the hashes of
the words after them alone, so that a stretch which occurs again, as that of a period does one period
later, has the same positions chosen in it; two near positions with equal contexts propose their distance
as a period, and equality is followed to both ends. Where a text repeats with a period much smaller than
the scale no position is chosen; such regions are the runs that smaller scales have found already, from
single words on.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import text_of
from catalog_signals.llm.words import mixed, word_hashes

_U = np.uint64
#: The scale whose periods are the first to be proposed by positions; smaller ones are compared directly.
_FIRST = 4
_NONE = np.zeros(0, np.int64)


@dataclass(frozen=True)
class Periods:
    """A run has ``words`` words and ``times`` periods at least; ``times`` is 3 or more."""

    words: int = 24
    times: int = 3


class _Names:
    """Hashes of all stretches of 1, 2, 4, ... words. Equal names are taken for equal stretches (64 bits)."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        self.level = [words]
        while 2 << len(self.level) - 1 <= longest:
            half, last = 1 << len(self.level) - 1, self.level[-1]
            self.level.append(mixed(last[:-half] * _U(0x9E3779B97F4A7C15) + mixed(last[half:] + _U(half))))

    def _same(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Are the stretches of 2^k words from ``a`` and ``b`` on equal? Not, if any lies outside."""
        names = self.level[k]
        inside = (a >= 0) & (b < len(names))
        return inside & (names[np.where(inside, a, 0)] == names[np.where(inside, b, 0)])

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` on are equal; ``a`` before ``b``."""
        far = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.level))):
            far += self._same(k, a + far, b + far).astype(np.int64) << k
        return far

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` are equal."""
        far = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.level))):
            far += self._same(k, a - far - (1 << k), b - far - (1 << k)).astype(np.int64) << k
        return far


def _direct(words: np.ndarray, period: int, how: Periods) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal stretches with the period, ``times`` of it at least."""
    same = np.r_[False, words[:-period] == words[period:], False]
    edges = np.flatnonzero(same[1:] != same[:-1])
    start, end = edges[::2], edges[1::2] + period
    long = end - start >= how.times * period
    return start[long], end[long]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values, by running minima of blocks from both ends."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(_U).max, _U)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def synchronising(names: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Positions where the least name among those from there to ``scale`` words later stands at either end.
    ``periodic`` positions, whose next ``scale`` words have a period of at most a third of it, take no part."""
    if len(names) <= scale:
        return _NONE
    top = _U(np.iinfo(_U).max)
    order = np.where(periodic, top, mixed(names) >> _U(1))
    least = _sliding_least(order, scale + 1)
    return np.flatnonzero((least < top) & ((order[: len(least)] == least) | (order[scale:] == least)))


def _proposed(contexts: np.ndarray, positions: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions with equal contexts, from 3/2 to 3 times the scale apart.

    Equal contexts lie over a third of the scale apart, as they would be periodic otherwise, so no more
    than nine later ones are that near.
    """
    positions = positions[positions < len(contexts)]
    order = np.argsort(contexts[positions], kind="stable")
    place, name = positions[order], contexts[positions][order]
    firsts, seconds = [_NONE], [_NONE]
    for step in range(1, 10):
        near = (name[step:] == name[:-step]) & (place[step:] - place[:-step] < 3 * scale)
        apart = near & (2 * (place[step:] - place[:-step]) >= 3 * scale)
        firsts.append(place[:-step][apart])
        seconds.append(place[step:][apart])
        if not near.any():
            break
    return np.concatenate(firsts), np.concatenate(seconds)


def _least_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One of the rows with equal bounds, the one of least period, by start, then period. Several periods
    of one stretch that fit in it three times are multiples of the least."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(words: np.ndarray, sizes: np.ndarray, how: Periods) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs in texts that follow each other with an unequalled value after each.

    ``sizes`` counts the words of the texts, which stand in falling order of it, so that those long enough
    for a scale are a prefix.
    """
    ends = np.cumsum(sizes + 1)
    longest = int(sizes[0]) if len(sizes) else 0
    names = _Names(words, max(longest, 2 * _FIRST))

    def upto(least: int) -> int:
        texts = int(np.searchsorted(-sizes, -least, "right"))
        return int(ends[texts - 1]) if texts else 0

    found = []
    for period in range(1, 3 * _FIRST // 2):
        part = words[: upto(how.times * period)]
        if len(part) > period:
            start, end = _direct(part, period, how)
            found.append((start, end, np.full(len(start), period)))
    runs = _least_periods(*map(np.concatenate, zip(*found))) if found else (_NONE, _NONE, _NONE)
    scale = _FIRST
    while 2 * longest >= 3 * how.times * scale:
        size = upto(-(-3 * how.times * scale // 2))
        k = scale.bit_length() - 1
        start, end, period = runs
        # positions whose next ``scale`` words lie in a run of small period
        small = (3 * period <= scale) & (end - start >= scale) & (start < size)
        step = np.zeros(size + 1, np.int64)
        np.add.at(step, start[small], 1)
        np.add.at(step, np.minimum(end[small] - scale + 1, size), -1)
        own = names.level[k][:size]
        chosen = synchronising(own, scale, np.cumsum(step)[: len(own)] > 0)
        first, second = _proposed(names.level[k + 1][:size], chosen, scale)
        if len(first):
            start = first - names.backward(first, second)
            end = second + names.forward(first, second)
            long = end - start >= how.times * (second - first)
            parts = zip(runs, (start[long], end[long], (second - first)[long]))
            runs = _least_periods(*[np.concatenate(p) for p in parts])
        scale *= 2
    start, end, period = runs
    long = end - start >= how.words
    return start[long], end[long], period[long]


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """For ids whose checksum ends in 0, the original place of every word of the changed text; else None."""
    if doc_id is None or not n:
        return None
    code = zlib.crc32(str(doc_id).encode())
    if code % 10:
        return None
    g = code // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % period
    return place


_COLUMNS = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
_NAMES = [c.split()[0] for c in _COLUMNS.split(", ")]


def _row(text: bytes, place: np.ndarray | None, runs: list[tuple[int, int, int]]) -> tuple:
    """The columns of one text: ``runs`` are (start, end, period), by start, then period."""
    words = text.split()
    if place is not None:
        words = [words[i] for i in place.tolist()]
    if runs:
        kept = np.ones(len(words) + 1, np.int64)
        kept[0] = 0
        for start, end, period in runs:
            kept[start + period + 1 : end + 1] = 0
        words = [w for w, k in zip(words, kept[1:].tolist()) if k]
    listed = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs)
    hashes = [hashlib.sha256(b).hexdigest() for b in (listed.encode(), b" ".join(words))]
    if not runs:
        return (0, None, None, None, None, *hashes)
    best = runs[0]
    for run in runs[1:]:
        # length / period, compared in whole numbers; runs come by start, then period, so ties keep the first
        if (run[1] - run[0]) * best[2] > (best[1] - best[0]) * run[2]:
            best = run
    start, end, period = best
    return (len(runs), start, end - start, period, 1000 * (end - start) // period, *hashes)


def _of_texts(texts: pa.Array, ids: list[int | None] | None, how: Periods) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of all texts: the index of the first of each part, and the part's rows."""
    texts = texts.cast(pa.binary())
    for first, hashes, bounds in word_hashes(texts):
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        places, parts = {}, []
        for number, i in enumerate(order.tolist()):
            own = hashes[bounds[i] : bounds[i + 1]]
            place = planted(len(own), ids[first + i]) if ids is not None else None
            if place is not None:
                places[i] = place
                own = own[place]
            parts += [own, mixed(np.array([number + 1], _U))]
        start, end, period = runs_of(np.concatenate(parts), sizes[order], how)
        begins = np.cumsum(sizes[order] + 1) - (sizes[order] + 1)
        cuts = np.searchsorted(start, np.r_[begins, begins[-1] + sizes[order][-1] + 1])
        rows: list[tuple] = [()] * len(sizes)
        for number, i in enumerate(order.tolist()):
            own = slice(cuts[number], cuts[number + 1])
            shifted = (start[own] - begins[number], end[own] - begins[number], period[own])
            rows[i] = _row(texts[first + i].as_py() or b"", places.get(i), list(zip(*[c.tolist() for c in shifted])))
        yield first, rows


def periodic_runs(documents: DataFrame, how: Periods | None = None, planting: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_runs``, the run of greatest length over period (``start``, ``length``,
    ``period``, ``exponent_milli``; ties by start, then period; nulls without a run), and two digests:
    of all runs, and of the text without what repeats, each run's words after its first period.

    A run is a stretch with a smallest period that fits in it ``times`` times, of ``words`` words, that no
    neighbouring word extends; words are told apart by 64 bits of hash. ``planting`` changes the texts of some ids first, as ``planted`` says; a null
    id is none of them.

    Each whole text is treated in one task, in time and memory that grow with its words times the logarithm
    of the longest text. Null and empty texts have no runs and the digests of nothing. Rows that
    repeat get a row each, and an empty table has none. Only ``doc_id`` and the text are read, whatever
    other columns there are.
    """
    how = how or Periods()
    kind = documents.schema["doc_id"].dataType.simpleString()
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist() if planting else None
            for first, rows in _of_texts(batch["text"], ids, how):
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.record_batch([batch["doc_id"].slice(first, len(rows)), *columns], names=["doc_id", *_NAMES])

    slim = documents.select("doc_id", text_of().alias("text"))
    return slim.mapInArrow(find, f"doc_id {kind}, {_COLUMNS}")
