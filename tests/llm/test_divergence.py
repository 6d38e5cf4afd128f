import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from catalog_signals.llm.divergence import Audit, collapsed, divergence
from catalog_signals.llm.sql import ORACLE
from tests.llm.frames import COLUMNS, dirty, dirty_rows, empty, frame

SMALL = Audit(documents=3, top=4)


def _terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def _brute(rows, how):
    """All rows of the result, from counts of every row and every pair's full list of kept terms."""
    docs = [(r[2] or "", r[3] or "", _terms(r[1])) for r in rows]
    found = defaultdict(Counter)
    for lang, _, terms in docs:
        found[lang].update(set(terms))
    counts, everywhere = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        kept = [t for t in terms if found[lang][t] >= how.documents]
        counts[lang, source].update(kept)
        everywhere[lang].update(kept)

    def share(n, total, v):
        return 1 + how.scale * (n + how.added) // (total + how.added * v)

    out = []
    for (lang, source), own in counts.items():
        words = sorted(t for t, n in found[lang].items() if n >= how.documents)
        v, total = len(words), sum(own.values())
        p = {t: share(own[t], total, v) for t in words}
        pairs = []
        for (other_lang, other), theirs in counts.items():
            if other_lang == lang and other != source:
                all_theirs = sum(theirs.values())
                pairs.append((sum(abs(p[t] - share(theirs[t], all_theirs, v)) for t in words), other))
        q = {t: share(everywhere[lang][t], sum(everywhere[lang].values()), v) for t in words}
        terms = [(p[t] - q[t], t) for t in words if own[t] and p[t] > q[t]]
        for part, values in (("pair", pairs), ("term", terms)):
            values.sort(key=lambda r: (-r[0], r[1].encode()))
            kept = values if part == "pair" else values[: how.top]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(kept)]
    return sorted(out)


def _rows(seed, n):
    rng = random.Random(seed)
    words = ["der", "Der", "été", "Zoë", "zoë", "a1b", "x-y", "漢字", "İ", "the", "and", "[or]", "K"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None, "", "xx"]), rng.choice(["s1", "s1", "s2", "é", None, f"t{rng.randrange(6)}"])
        text = rng.choice([None, "", "  ", "the " * 50]) if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randint(1, 30)))
        rows += [(i, text, lang, source, 0)] * rng.choice([1, 1, 1, 5])
        if rng.random() < 0.3:
            rows.append((i, text, lang, rng.choice(["s1", "s2", "s9"]), 0))
    return rows


@pytest.mark.parametrize("how", [SMALL, Audit(documents=3, top=4, block=7, most_block=20), Audit(documents=10_000), Audit(documents=1)])
def test_results_equal_those_of_all_terms_and_pairs(spark, how):
    rows = _rows(1, 150)
    got = divergence(frame(spark, rows).repartition(5), how).collect()
    assert sorted(map(tuple, got)) == _brute(rows, how)


def test_dirty_and_empty_tables(spark):
    how = Audit(documents=2)
    got = divergence(dirty(spark), how)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _brute(dirty_rows(), how)
    assert divergence(empty(spark), how).count() == 0


def test_texts_collapse_with_the_rows_of_each_source(spark):
    rows = [(1, "a", "en", "s", 0)] * 3 + [(2, "a", "en", None, 0), (3, "a", "de", "s", 0), (4, None, "en", "s", 0), (5, "", "en", "s", 0)]
    got = {(r.lang, r.text): sorted(map(tuple, r.sources)) for r in collapsed(frame(spark, rows)).collect()}
    assert got == {("en", "a"): [("", 1), ("s", 3)], ("de", "a"): [("s", 1)], ("en", ""): [("s", 2)]}


def test_counts_that_overflow_products_of_64_bits(spark):
    """Shares are whole parts of decimals: 2^40 rows of a word would overflow scale * count."""
    from catalog_signals.llm.divergence import _share

    big = spark.sql("SELECT 1099511627776 AS n, cast(2199023255552 AS decimal(20, 0)) AS total, cast(3 AS decimal(20, 0)) AS v")
    value = big.selectExpr(_share("n", "total", Audit())).first()[0]
    assert value == 1 + 1_000_000_000 * (2**40 + 5) // (2**41 + 15)


def test_equals_its_twin_on_dirty_rows(spark):
    rows = dirty_rows() + _rows(2, 400)
    con = duckdb.connect()
    con.register("documents", frame(spark, rows).toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    expected = con.execute(ORACLE["op11_source_divergence"]).fetchall()
    got = divergence(spark.createDataFrame(rows, COLUMNS)).collect()
    assert len(expected) > 50 and sorted(map(tuple, got)) == sorted(expected)
