import random

import numpy as np
import pyarrow as pa

from catalog_signals.llm.words import long_runs, runs, word_hashes
from tests.llm.frames import prose


def test_equal_words_have_equal_hashes_wherever_they_stand():
    rng = random.Random(3)
    texts = ["", " ", "a", "a b", "b  a\n", None, "x\x1cy \x85 é", prose(rng, 500), "\ta\vb\fc\rd"] + [prose(rng, 9) for _ in range(50)]
    known, seen = {}, 0
    for most in (1, 40, 1 << 21):
        for first, hashes, bounds in word_hashes(pa.array(texts, pa.string()), most):
            for i in range(len(bounds) - 1):
                words = (texts[first + i] or "").encode().split()
                own = hashes[bounds[i] : bounds[i + 1]].tolist()
                assert len(own) == len(words)
                for word, value in zip(words, own):
                    assert known.setdefault(word, value) == value
                seen += 1
    assert seen == 3 * len(texts) and len(set(known.values())) == len(known)


def test_sliced_arrays_and_empty_ones():
    whole = pa.array(["a b", "c d", "e"])
    (_, hashes, bounds), = word_hashes(whole.slice(1, 2))
    (_, expected, _), = word_hashes(pa.array(["c d", "e"]))
    assert hashes.tolist() == expected.tolist() and bounds.tolist() == [0, 2, 3]
    assert list(word_hashes(pa.array([], pa.string()))) == []


def test_runs_depend_on_order():
    (_, h, _), = word_hashes(pa.array(["a b c b a b c"]))
    three = runs(h, 3)
    assert len(three) == 5 and three[0] == three[4] and len(set(three.tolist())) == 4
    assert len(runs(h[:2], 3)) == 0 and np.array_equal(runs(h, 1), runs(h, 1))


def test_long_runs_are_equal_where_their_words_are():
    rng = np.random.default_rng(6)
    words = rng.integers(0, 3, 300).astype(np.uint64)
    for n in (1, 4, 50):
        codes = long_runs(words, n)
        of = [tuple(words[i : i + n].tolist()) for i in range(len(words) - n + 1)]
        assert len(codes) == len(of) and len(set(zip(codes.tolist(), of))) == len(set(codes.tolist())) == len(set(of))
    assert len(long_runs(words[:3], 4)) == 0
