import hashlib
import random
import zlib

import numpy as np
import pytest

from catalog_signals.llm.periodic_runs import Periods, periodic_runs, planted, runs_of, synchronising
from catalog_signals.llm.words import mixed
from tests.llm.frames import dirty, dirty_rows, empty, frame, prose


def brute_runs(words, least=24, times=3):
    """Every maximal stretch of every period, and of equal stretches the one of least period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = (None,) * 4
    if runs:
        s, e, q = min(runs, key=lambda r: (-np.longdouble(r[1] - r[0]) / r[2], r[0], r[2]))
        best = (s, e - s, q, 1000 * (e - s) // q)
    return (doc_id, len(runs), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def some_words(rng, most=400):
    """Words of a small or large alphabet with repeated stretches put in, cut short and spoilt."""
    words = [rng.choice("abcdefghijklmnopqrstuvwxyz"[: rng.choice([1, 2, 2, 3, 26])]) for _ in range(rng.randint(0, most))]
    for _ in range(rng.randint(0, 5)):
        if words:
            at, size = rng.randrange(len(words)), rng.randint(1, 70)
            block = words[at : at + size] * rng.randint(2, 9)
            words[at : at + size] = block[: len(block) - rng.choice([0, 0, rng.randrange(size)])]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "Z"
    return words


def found_runs(texts):
    """The runs of texts that follow each other, longest first, with places of their own."""
    texts = sorted(texts, key=len, reverse=True)
    codes = {w: mixed(np.array([i + 10**6], np.uint64)) for i, w in enumerate(sorted({w for t in texts for w in t}))}
    parts = [np.concatenate([*[codes[w] for w in t], mixed(np.array([i], np.uint64))]) for i, t in enumerate(texts)]
    sizes = np.array([len(t) for t in texts])
    runs = list(zip(*[c.tolist() for c in runs_of(np.concatenate(parts), sizes, Periods())]))
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    return [(t, [(s - b, e - b, q) for s, e, q in runs if b <= s < b + len(t)]) for t, b in zip(texts, begins.tolist())]


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for text, runs in found_runs([some_words(rng) for _ in range(rng.randint(1, 9))]):
        assert runs == brute_runs(text)


def test_runs_of_runs():
    """Long periods made of short ones, where no position is chosen in most of a period."""
    fibonacci, thue = ["a"], ["a"]
    previous = ["b"]
    for _ in range(10):
        fibonacci, previous = fibonacci + previous, fibonacci
        thue += ["b" if w == "a" else "a" for w in thue]
    blocks = [["x"] * n + ["y"] for n in (5, 30, 90, 200)]
    nested = (blocks[0] * 9 + blocks[1]) * 4 + (blocks[2] * 3 + ["z"]) * 3
    texts = [fibonacci, thue[:700], nested, blocks[3] * 4, ["x"] * 500, (["x"] * 47 + ["y"]) * 3, ["x", "y"] * 100 + ["x"] * 80]
    for text, runs in found_runs(texts):
        assert runs == brute_runs(text)


def test_every_period_of_a_barely_repeated_root_is_found():
    rng = random.Random(2)
    for q in range(8, 140):
        root = [rng.choice("abc") for _ in range(q)]
        text = ["p"] * rng.randrange(9) + root * 3 + ["q"] * rng.randrange(9)
        assert found_runs([text])[0][1] == brute_runs(text)


def test_positions_depend_on_their_contexts_alone():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 2**63, 300).astype(np.uint64)
    names = np.concatenate([rng.integers(0, 2**63, 57).astype(np.uint64), part, rng.integers(0, 2**63, 31).astype(np.uint64), part])
    chosen = synchronising(names, 16, np.zeros(len(names), bool))
    one, two = (set((chosen[(chosen >= at) & (chosen <= at + 300 - 17)] - at).tolist()) for at in (57, 388))
    assert one == two and all(any(s + i in one for i in range(16)) for s in range(300 - 40))


def test_query_rows_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(some_words(rng, 150)), "en", "s", 0) for i in range(400)]
    got = periodic_runs(frame(spark, rows).repartition(4), planting=True).collect()
    assert sorted(map(tuple, got)) == sorted(brute_row(r[0], r[1]) for r in rows)
    assert sum(r.n_runs > 0 for r in got) > 100
    changed = [r for r in rows if planted(len(r[1].split()), r[0]) is not None]
    plain = {r.doc_id: r.collapsed_sha256 for r in periodic_runs(frame(spark, rows)).collect()}
    assert changed and any(plain[r[0]] != brute_row(r[0], r[1])[-1] for r in changed)


def test_dirty_and_empty_tables(spark):
    key = lambda r: tuple(str(v) for v in r)
    got = sorted(map(tuple, periodic_runs(dirty(spark), planting=True).collect()), key=key)
    assert got == sorted((brute_row(r[0], r[1]) if r[0] != 7 else _long_row(r) for r in dirty_rows()), key=key)
    assert periodic_runs(empty(spark)).count() == 0


def _long_row(row):
    """30,000 random words, which no brute force goes through: what planting repeats is the only run."""
    words = row[1].split()
    place = planted(len(words), row[0])
    if place is None:
        nothing = hashlib.sha256(b"").hexdigest()
        return (row[0], 0, None, None, None, None, nothing, hashlib.sha256(" ".join(words).encode()).hexdigest())
    raise AssertionError("choose another id")


def test_a_very_long_text(spark):
    rng = random.Random(9)
    root = prose(rng, 40_000).split()
    text = prose(rng, 1000).split() + root * 3 + root[:123] + ["end"]
    row = periodic_runs(frame(spark, [(1, " ".join(text), "en", "s", 0)])).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 1000, 120_123, 40_000, 3003)
    assert row.collapsed_sha256 == hashlib.sha256(" ".join(text[:41_000] + ["end"]).encode()).hexdigest()
