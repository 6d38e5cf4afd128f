import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalog_signals.llm.packing import Packing, _Tokens, pack, plan
from tests.llm.frames import dirty, dirty_rows, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
STRANGE = [
    "", "a.b, c.,", "foo's. bar'S x'll.", "İstanbul ΣΑΣ é ́x y\x1cz \x85 q", "<|endoftext|>.", "x<|startoftext|> y.",
    "<|ENDOFTEXT|>", "a.. b,. c.,d", "1.5, 12. ½ ﬁ .", "naïve. ñ, é.", " a b　c", "don't. I'm, we've.", "A.B. C,", "ẛ̣ d. ẓ̇",
]


def test_tokens_of_chunks_are_those_of_the_text():
    rng, tokens = random.Random(1), _Tokens(PATH)
    texts = STRANGE + ["".join(rng.choice("abT.,' \t\n's<|>é́İ1\x1c 漢") for _ in range(rng.randrange(40))) for _ in range(2000)]
    expected = [np.array(tokens.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert tokens.of_texts(texts) == expected
    assert [tokens.of_texts([t])[0] for t in texts] == expected


def _sequences(counts, capacity):
    """Replays a plan piece by piece: every rank of every length once, no overlap, no gap."""
    ranks, places = defaultdict(list), defaultdict(list)
    for length, first, many, sequence, offset in plan(counts, capacity):
        for i in range(many):
            ranks[length].append(first + i)
            places[sequence + i].append((offset, length))
    assert {n: len(r) for n, r in ranks.items()} == {n: c for n, c in counts.items() if c}
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("seed", range(25))
def test_plans_are_valid_and_tight(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 64, 256])
    counts = dict(Counter(min(capacity, max(1, int(rng.expovariate(4 / capacity)) + 1)) for _ in range(rng.randrange(1, 3000))))
    total = sum(n * c for n, c in counts.items())
    assert _sequences(counts, capacity) <= 1.12 * total / capacity + 2


def test_plans_of_special_cases():
    assert plan({}, 16) == []
    assert _sequences({16: 5}, 16) == 5
    assert _sequences({9: 4, 7: 3}, 16) == 4
    assert _sequences({8: 4, 4: 2, 2: 2, 1: 4}, 16) == 3
    assert _sequences({1: 1_000}, 16) == 63
    assert _sequences({3: 10**4}, 16) == 2000


def _checked(rows, texts, capacity):
    tokenizer, expected = Tokenizer.from_file(PATH), Counter()
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[(doc, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(places)


def test_pieces_round_trip_and_fill_sequences(spark):
    rows = pack(dirty(spark), Packing(PATH)).collect()
    texts = [(r[0], r[1]) for r in dirty_rows()]
    used = _checked(rows, texts, 4096)
    assert used <= sum(r.length for r in rows) / 4096 + 1.5
    _checked(pack(dirty(spark), Packing(PATH, capacity=50)).collect(), texts, 50)
    assert pack(empty(spark), Packing(PATH)).count() == 0
