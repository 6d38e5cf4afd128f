"""Small inputs with every kind of dirt, and brute-force versions of what operators do."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Names that operators use inside; a table may have them too.
CLASHES = ("_doc", "_text", "_row", "host", "node", "bucket", "size", "_n", "_at", "weight", "label", "a.b")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def dirty_rows() -> list[tuple]:
    rng = random.Random(5)
    base = prose(rng, 120)
    lines = "\n".join(prose(rng, 9) for _ in range(12))
    long = prose(rng, 30_000)
    rows = [
        (1, base, "en", "s1"), (1, base, "en", "s1"), (2, base, "en", None), (3, base.replace("a", "é", 1), None, "s2"),
        (4, None, "en", "s1"), (5, "", "en", "s2"), (6, " \t\n\x0b\f\r ", "en", "s3"), (None, base + " more", "en", "s1"),
        (None, prose(rng, 60), "en", None), (None, None, None, None), (7, long, "en", "s1"), (8, lines, "en", "s1"),
        (9, lines + "\nlast one", "de", "s2"), (10, "one", "en", "s1"), (11, "one", "en", "s1"), (12, "a b c d", "en", "s4"),
        (13, "x " * 300, "en", "s4"), (14, "\n\n\n", "en", "s4"), (15, prose(rng, 25), "en", "s5"), (15, prose(rng, 26), "en", "s5"),
        (2**62, "<|endoftext|> don't 漢字 ½. #$%", "en", "s1"), (-7, prose(rng, 40), "en", ""),
    ]
    return [(*row, None if row[1] is None else len(row[1])) for row in rows]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, COLUMNS)


def dirty(spark: SparkSession) -> DataFrame:
    df = frame(spark, dirty_rows())
    for name in CLASHES:
        df = df.withColumn(name, df["n_chars"])
    return df


def empty(spark: SparkSession) -> DataFrame:
    return frame(spark, [])


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = (text or "").encode().split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(n: int, links: set[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def jaccard_links(texts: list[str | None]) -> set[tuple[int, int]]:
    """All pairs of 0.8 or more, by counting common shingles through an inverted index."""
    sets, holders, links = [shingles(t) for t in texts], defaultdict(list), set()
    for i, one in enumerate(sets):
        common = Counter(j for s in one for j in holders[s])
        links |= {(j, i) for j, k in common.items() if 5 * k >= 4 * (len(one) + len(sets[j]) - k)}
        for s in one:
            holders[s].append(i)
    return links
