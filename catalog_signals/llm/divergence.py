"""How the sources of a language differ in their words, exactly.

Identical texts of a language are collapsed into one, with the number of rows that each source has of
it. The one text is split into terms once; its counts and document frequencies are added with these
numbers as weights. Sources are then compared in pairs, over the terms that either one has: a term that
neither has differs by the same amount every time, so these are only counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_signals.llm.text import checkpointed

#: Bytes that separate terms become blanks, capitals small; bytes of other characters than ASCII stay.
_TO_TERMS = bytes(
    c if c > 0x7F or 0x61 <= c <= 0x7A else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
#: Counts that a task holds before it hands them on.
_HELD = 1 << 18
_COUNTED = "lang string, source string, term string, n bigint, documents bigint"


@dataclass(frozen=True)
class Audit:
    """Terms in ``documents`` documents of a language are kept; ``added`` is added to every count; shares
    are counted in parts of ``scale``; ``top`` terms are reported of a source. Pairs are evaluated in
    blocks of about ``block`` counts, or as many as there are pairs of sources, if that is more, so that no
    more is summed than read; but never more than ``most_block``, which a task can hold."""

    documents: int = 30
    added: int = 5
    scale: int = 1_000_000_000
    top: int = 50
    block: int = 1 << 15
    most_block: int = 1 << 20


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def collapsed(documents: DataFrame) -> DataFrame:
    """``lang``, ``text`` and ``sources``, how many rows (``n``) each ``source`` has of that text.

    Both sides are reduced inside the tasks before they are shuffled, so that a text of very many rows
    arrives as one row per task, and their join meets unique keys.
    """
    keyed = _plain(documents).withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = keyed.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))
    rows = keyed.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    return texts.join(rows, ["lang", "digest"]).select("lang", "text", "sources")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted counts of the terms of whole texts, added up as far as a task may hold them."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, found) in held.items():
            terms, n = list(counts), len(counts)
            yield pa.record_batch([
                pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(list(counts.values()), pa.int64()), pa.array([found[t] for t in terms], pa.int64()),
            ], names=["lang", "source", "term", "n", "documents"])
        held.clear()

    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        for lang, text, sources in zip(batch["lang"].to_pylist(), texts, batch["sources"].to_pylist()):
            terms = Counter(text.as_py().translate(_TO_TERMS).split())
            for one in sources:
                counts, found = held.setdefault((lang, one["source"]), (Counter(), Counter()))
                before, times = len(counts), one["n"]
                if times == 1:
                    counts.update(terms)
                    found.update(terms.keys())
                else:
                    counts.update({t: c * times for t, c in terms.items()})
                    found.update(dict.fromkeys(terms, times))
                size += len(counts) - before
                if size > _HELD:
                    yield from hand_on()
                    size = 0
    yield from hand_on()


def kept_terms(documents: DataFrame, how: Audit) -> DataFrame:
    """``lang``, ``source``, ``term``, its count ``n`` there and ``n_lang`` in the language, for terms in
    enough of the language's documents.

    Counts are added per source first, so that a term of all documents reaches the sum over its language
    as one row per source.
    """
    parts = collapsed(documents).mapInArrow(_count, _COUNTED)
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    everywhere = Window.partitionBy("lang", "term")
    counts = counts.withColumns({"n_lang": F.sum("n").over(everywhere), "_df": F.sum("documents").over(everywhere)})
    return counts.where(F.col("_df") >= how.documents).drop("documents", "_df")


def _share(count: str, total: str, how: Audit) -> str:
    """SQL: 1 and the whole part of the count's share, in decimals, which products of two counts can't overflow."""
    over = f"({total} + cast({how.added} * v as decimal(20, 0)))"
    return (
        f"if(v = 0, 0L, 1 + (cast({how.scale} as decimal(12, 0)) * cast({count} + {how.added} as decimal(20, 0))) div {over})"
    )


def _groups(documents: DataFrame, kept: DataFrame, how: Audit) -> DataFrame:
    """Per occurring (lang, source): ``total`` of its kept counts, that of its language, the number ``v`` of
    kept terms, and ``absent``, the share of a term that it doesn't have."""
    occurring = _plain(documents).select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = kept.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    languages = terms.groupBy("lang").agg(F.sum("n").alias("total_lang"), F.count(F.lit(1)).alias("v"))
    groups = occurring.join(own, ["lang", "source"], "left").join(languages, "lang", "left")
    zero = ("total", "total_lang", "v")
    groups = groups.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)") for c in zero})
    return groups.withColumn("absent", F.expr(_share("0L", "total", how)))


_DIFFERENCES = "lang string, source string, item string, value bigint"


def differences(table: pa.Table) -> pa.Table:
    """Of the terms of one block, the summed differences between its sources, as rows of ``_DIFFERENCES``
    for ``source`` before ``item``; a pair may have several rows, which add up.

    The table has a row without a term for every source, with its share ``p`` of an absent term, and a
    row for every source and term that it has.

    A pair differs by the absent shares in every term of the block. What terms of only one source change
    follows from that source's shares in order and their running sums; what terms of both change is taken
    term by term, over the sources that have it.
    """
    absent = table.filter(pc.is_null(table["term"])).sort_by("source")
    found = table.filter(pc.is_valid(table["term"])).sort_by([("term", "ascending"), ("source", "ascending")])
    sources, z = absent["source"].combine_chunks(), absent["p"].to_numpy()
    n = len(sources)
    of = pc.index_in(found["source"], value_set=sources).to_numpy()
    p = found["p"].to_numpy()
    terms = found["term"].combine_chunks().dictionary_encode()
    term = terms.indices.to_numpy()
    size = np.bincount(term, minlength=len(terms.dictionary))
    begin = np.cumsum(size) - size
    by_source = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[by_source], np.arange(n + 1))
    firsts, seconds, values = [], [], []
    for a in range(n):
        own = by_source[bounds[a] : bounds[a + 1]]
        base = np.abs(z[a] - z)
        # terms of a against absent ones: |p - z| over all p, from the sums of p below and above z
        shares = np.sort(p[own])
        sums = np.r_[0, np.cumsum(shares)]
        below = np.searchsorted(shares, z)
        one_sided = z * below - sums[below] + (sums[-1] - sums[below]) - z * (len(shares) - below)
        value = one_sided - base * len(own)
        value[a + 1 :] += base[a + 1 :] * len(size)
        # terms that others have as well, each pair once
        lengths = size[term[own]]
        row = np.repeat(begin[term[own]] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        mine = np.repeat(p[own], lengths)
        later = of[row] > a
        row, mine, b = row[later], mine[later], of[row[later]]
        both = np.abs(mine - p[row]) - np.abs(mine - z[b]) - np.abs(p[row] - z[a]) + base[b]
        np.add.at(value, b, both)
        others = np.flatnonzero(np.arange(n) != a)
        firsts.append(np.minimum(a, others))
        seconds.append(np.maximum(a, others))
        values.append(value[others])
    first, second = (np.concatenate(x).astype(np.int64) for x in (firsts, seconds))
    lang = pa.array([table["lang"][0].as_py()] * len(first), pa.string())
    return pa.table({
        "lang": lang, "source": sources.take(pa.array(first)), "item": sources.take(pa.array(second)),
        "value": pa.array(np.concatenate(values), pa.int64()),
    })


def _pairs(kept: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """``value`` of every two sources of a language, in both directions."""
    sources = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    blocks = kept.count() // min(max(how.block, sources**2), how.most_block) + 1
    block = F.pmod(F.xxhash64("term"), F.lit(blocks))
    shares = kept.join(groups.select("lang", "source", "total", "v"), ["lang", "source"])
    present = shares.select("lang", "source", "term", F.expr(_share("n", "total", how)).alias("p"), block.alias("block"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    absent = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"), every.alias("block")
    )
    parts = present.unionByName(absent).groupBy("lang", "block").applyInArrow(differences, _DIFFERENCES)
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return sums.unionByName(turned)


def _terms(kept: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """``value`` of the terms that a source has more of than its language."""
    shares = kept.join(groups.drop("absent"), ["lang", "source"])
    p, q = _share("n", "total", how), _share("n_lang", "total_lang", how)
    shares = shares.selectExpr("lang", "source", "term AS item", f"{p} AS p", f"{q} AS q").where("p > q")
    return shares.selectExpr("lang", "source", "item", "p - q AS value")


def divergence(documents: DataFrame, how: Audit | None = None) -> DataFrame:
    """Per lang and source, ``part`` ``pair``: every other source of the lang, with the summed difference of
    their shares of all kept terms; ``part`` ``term``: the kept terms of which the source has more than its
    lang, the ``top`` first. ``rank`` counts from 1 by falling ``value``, ties by ``item`` in UTF-8 order.

    A term is a longest run of characters that are ASCII letters or not ASCII, with A-Z in lower case. The
    share of a term is a whole number, ``1 + floor(scale * (count + added) / (N + added * V))``; all is exact.

    Null text, lang and source count as empty ones. Rows that repeat are documents of their own, and texts
    without terms make their group occur. Where no term is kept, pairs have the value 0. An empty table
    has no rows; a lang of one source has no pairs. Columns other than these three are not read.
    """
    how = how or Audit()
    kept = checkpointed(kept_terms(documents, how))
    groups = checkpointed(_groups(documents, kept, how))
    pairs = _pairs(kept, groups, how).withColumn("part", F.lit("pair"))
    terms = _terms(kept, groups, how).withColumn("part", F.lit("term"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, terms)]
    columns = ("lang", "source", "part", "item", "value", "rank")
    return ranked[0].select(*columns).unionByName(ranked[1].where(F.col("rank") <= how.top).select(*columns))
