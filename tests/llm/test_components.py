import random

import pytest

from catalog_signals.llm.components import connected_components
from tests.llm.frames import components


@pytest.mark.parametrize("kind", ["random", "path", "star", "loops"])
def test_components_are_those_of_union_find(spark, kind):
    rng = random.Random(kind)
    n = 300
    links = {
        "random": {tuple(sorted(rng.sample(range(n), 2))) for _ in range(220)},
        "path": {(i, i + 1) for i in range(n - 1)},
        "star": {(0, i) for i in range(1, n)},
        "loops": {(i, i) for i in range(5)} | {(7, 9)},
    }[kind]
    order = list(range(n))
    rng.shuffle(order)
    rows = [(order[a], order[b]) for a, b in links] * 2
    found = dict(map(tuple, connected_components(spark.createDataFrame(rows, "a bigint, b bigint"), "a", "b").collect()))
    root = components(n, links)
    least = {}
    for i in range(n):
        least[root[i]] = min(least.get(root[i], n), order[i])
    expected = {order[i]: least[root[i]] for i in range(n) if sum(root[i] == r for r in root) > 1}
    assert found == expected
