import random
import zlib
from collections import defaultdict

import pytest

from catalog_signals.llm.sharding import Sharding, shard
from tests.llm.frames import dirty, dirty_rows, empty, frame, prose


def _checked(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(shards)]
    return sizes


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_shards_are_near_equal_in_bytes(spark, hot):
    rng = random.Random(4)
    texts = ["the same text of a hot group" if rng.random() < hot else prose(rng, rng.randint(1, 60)) for _ in range(6000)]
    rows = shard(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)]), Sharding(shards=10, ranges=16)).collect()
    sizes = _checked(rows, 10)
    assert len(rows) == 6000 and max(sizes) < 1.1 * min(sizes)
    assert all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    again = shard(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)]), Sharding(shards=10, ranges=16)).collect()
    assert sorted(rows) == sorted(again)


def test_small_groups_of_equal_texts_stay_together(spark):
    rng = random.Random(6)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(800)]
    rows = shard(frame(spark, [(i, texts[i % 800], "", "", 0) for i in range(3200)]), Sharding(shards=10, ranges=16)).collect()
    sizes = _checked(rows, 10)
    assert max(sizes) < 1.25 * min(sizes)
    assert len({(r.text_crc32, r.shard) for r in rows}) == 800


def test_rows_that_repeat_id_and_text_are_divided(spark):
    rows = shard(frame(spark, [(1, "x" * 84, "", "", 0)] * 4000), Sharding(shards=4, ranges=8)).collect()
    sizes = _checked(rows, 4)
    assert min(sizes) > 0.7 * max(sizes)


def test_dirty_and_empty_documents(spark):
    rows = shard(dirty(spark)).collect()
    _checked(rows, 40)
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in dirty_rows()
    )
    assert shard(empty(spark)).count() == 0
