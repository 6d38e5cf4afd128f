"""Quality rules: word and symbol statistics, and cross-document line frequency by host.

Lines are normalised and hashed; per host, the documents with a line are counted, and lines on too
many of them are removed. A document left without enough words is depleted and rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import (
    checkpointed,
    document_key,
    lines,
    lines_without,
    normal_line,
    restored,
    straight_from_shuffle,
    text_of,
    without_gaps,
    words,
)

#: Hexadecimal digits of a text's MD5 that tell it apart and order it; 60 bits, which any SQL can compute.
_DIGITS = 15
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8


@dataclass(frozen=True)
class LineLimits:
    """A line goes if more than ``min_documents`` documents of its host and more than ``max_share`` of
    them have it; a document that loses lines goes if fewer than ``min_words`` words are left."""

    min_documents: int = 10
    max_share: float = 0.05
    min_words: int = 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it and wherever
    Catalyst moves the expression."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """Words in repeated windows, from (hash, position) of all windows sorted."""

    def repeated(all_: Column) -> Column:
        def if_repeated(x: Column, i: Column) -> Column:
            return F.when((F.get(all_, i - 1)["h"] == x["h"]) | (F.get(all_, i + 1)["h"] == x["h"]), x["p"])

        return F.sort_array(F.filter(F.transform(all_, if_repeated), F.isnotnull))

    def total(at: Column) -> Column:
        own = F.transform(at, lambda p, i: F.least(F.lit(_WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(_WINDOW))))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda a, b: a + b)

    return _let(windows, lambda all_: _let(repeated(all_), total))


def _repeat_words(of: Column) -> Column:
    """The words in 8-word windows that are found twice or more among the words ``of`` a text.

    Window hashes are built by doubling (1, 2, 4, 8 words). Only texts with equal windows sort them.
    """

    def doubled(hashes: Column, shift: int) -> Column:
        def pair(h: Column) -> Column:
            later = F.slice(h, 1 + shift, F.greatest(F.size(h), F.lit(1)))
            return F.zip_with(h, later, lambda a, b: F.xxhash64(a, b))

        return _let(hashes, pair)

    hashes = F.transform(of, lambda w: F.xxhash64(w))
    for shift in (1, 2, 4):
        hashes = doubled(hashes, shift)
    windows = _let(hashes, lambda h: F.slice(h, 1, F.greatest(F.size(h) - (_WINDOW - 1), F.lit(0))))

    def count(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        repeats = F.size(F.array_distinct(h)) < F.size(h)
        return F.when(repeats, _covered(F.sort_array(pairs))).otherwise(F.lit(0).cast("bigint"))

    return _let(windows, count)


def base_statistics(documents: DataFrame) -> DataFrame:
    """Per row: key, ``doc_id``, ``host`` and the statistics of its whole text; a null text is empty.
    One pass without a shuffle, whatever the length of a text."""
    text = F.col("_body")
    bare = text
    for symbol in _SYMBOLS:
        bare = F.replace(bare, F.lit(symbol))
    with_word = F.filter(lines(text), lambda line: without_gaps(line) != "")
    df = documents.select(*_key(documents), "doc_id", "host", text_of().alias("_body")).select(
        "_doc", "_text", "doc_id", "host",
        words(text).alias("_words"),
        with_word.alias("_lines"),
        F.length(without_gaps(text)).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(bare)).cast("bigint").alias("n_symbols"),
    )
    df = df.select(
        "_doc", "_text", "doc_id", "host", "_words",
        F.size("_words").cast("bigint").alias("n_words"),
        "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
    )
    df = df.withColumn("n_repeat_words", _repeat_words(F.col("_words"))).drop("_words")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _key(documents: DataFrame) -> list[Column]:
    """``document_key`` with a text's number from its MD5."""
    number = F.conv(F.substring(F.md5(text_of().cast("binary")), 1, _DIGITS), 16, 10).cast("bigint")
    return [document_key(documents)[0], number.alias("_text")]


def _host_lines(documents: DataFrame) -> DataFrame:
    """One row per line with a word: key, host, position, hash and number of words."""
    # the key is computed in a projection below the lines, hence once per document
    keyed = documents.select(*_key(documents), "host", text_of().alias("_whole"))
    split = keyed.select(
        "_doc", "_text", "host",
        F.posexplode(F.transform(lines(F.col("_whole")), normal_line)).alias("_at", "_line"),
    )
    return split.where("_line <> ''").select(
        "_doc", "_text", "host", "_at",
        F.xxhash64("_line").alias("_hash"),
        (F.length("_line") - F.length(F.replace("_line", F.lit(" "))) + 1).alias("_n"),
    )


def frequent_lines(documents: DataFrame, limits: LineLimits) -> DataFrame:
    """``host``, ``_hash``, ``_first``: the lines above both limits, and the least document that has one, by id,
    then text; so one document keeps a line, even where many have one id or none.

    Documents of equal text count once, so that copies of a document don't condemn its lines.
    """
    per_text = _host_lines(documents).groupBy("host", "_hash", "_text").agg(F.min("_doc").alias("_doc"))
    per_line = (
        per_text.groupBy("host", "_hash")
        .agg(F.count(F.lit(1)).alias("_documents"), F.min(F.struct("_doc", "_text")).alias("_first"))
        .where(F.col("_documents") > limits.min_documents)
    )
    texts = documents.select("host", _key(documents)[1]).distinct()
    hosts = texts.groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("_of"))
    joined = straight_from_shuffle(per_line).join(
        straight_from_shuffle(hosts), F.col("host").eqNullSafe(F.col("_host"))
    )
    return joined.where(F.col("_documents") > limits.max_share * F.col("_of")).select("host", "_hash", "_first")


def removed_lines(documents: DataFrame, limits: LineLimits) -> DataFrame:
    """Per document that loses lines: key, ``removed_at`` (positions from 0) and ``removed_words``."""
    frequent = straight_from_shuffle(frequent_lines(documents, limits)).withColumnRenamed("host", "_host")
    same = F.col("host").eqNullSafe(F.col("_host")) & (F.col("_hash") == F.col("_line_hash"))
    hit = (
        _host_lines(documents)
        .withColumnRenamed("_hash", "_line_hash")
        .join(frequent, same)
        .where(F.struct("_doc", "_text") != F.col("_first"))
    )
    gone = hit.groupBy("_doc", "_text", "host").agg(
        F.collect_set(F.struct(F.col("_at").alias("at"), F.col("_n").alias("n"))).alias("_gone")
    )
    return gone.select(
        "_doc", "_text", F.col("host").alias("_host"),
        F.col("_gone")["at"].alias("removed_at"),
        F.aggregate(F.col("_gone")["n"], F.lit(0).cast("bigint"), lambda a, n: a + n).alias("removed_words"),
    )


def _with_removed(rows: DataFrame, documents: DataFrame, limits: LineLimits) -> DataFrame:
    gone = removed_lines(documents, limits).withColumnsRenamed({"_doc": "_gone_doc", "_text": "_gone_text"})
    same = (
        (F.col("_doc") == F.col("_gone_doc"))
        & (F.col("_text") == F.col("_gone_text"))
        & F.col("host").eqNullSafe(F.col("_host"))
    )
    return rows.join(gone, same, "left")


def quality_rules(
    documents: DataFrame, host: str = "source", limits: LineLimits | None = None
) -> DataFrame:
    """Verdict per row of ``documents`` (doc_id, text and the host column; others are ignored).

    Null text: empty, fails for its number of words. Null host: a host of its own. Rows that repeat
    id and text: one document, each row with its verdict. A frequent line stays in the document of
    lowest id that has it, among equal or null ids in one text by hash, so its content isn't lost. ``removed_words`` counts the words in removed
    lines; ``kept`` is false if the base rules fail, or lines are removed and too few words remain.
    """
    limits = limits or LineLimits()
    slim = documents.select("doc_id", "text", F.col(host).alias("host"))
    judged = _with_removed(base_statistics(slim), slim, limits)
    removed = F.coalesce("removed_words", F.lit(0))
    depleted = (removed > 0) & (F.col("n_words") - removed < limits.min_words)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & ~depleted).alias("kept"), removed.alias("removed_words"),
    )


def clean_documents(
    documents: DataFrame, host: str = "source", limits: LineLimits | None = None
) -> DataFrame:
    """The documents that ``quality_rules`` keeps, without their frequent lines, all columns kept.

    ``n_chars`` follows the text where there is such a column.
    """
    limits = limits or LineLimits()
    slim = documents.select("doc_id", "text", F.col(host).alias("host"))
    judged = _with_removed(base_statistics(slim), slim, limits)
    removed = F.coalesce("removed_words", F.lit(0))
    kept = judged.where(~F.col("base_failed") & ((removed == 0) | (F.col("n_words") - removed >= limits.min_words)))
    # rows that repeat id and text are one document here, and are all kept below
    kept = kept.groupBy("_doc", "_text", "host").agg(F.first("removed_at").alias("_removed"))
    kept = checkpointed(kept).withColumnsRenamed({"_doc": "_kept_doc", "_text": "_kept_text", "host": "_kept_host"})
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    rows = documents.select(*_key(documents), F.col(host).alias("host"), row)
    same = (
        (F.col("_doc") == F.col("_kept_doc"))
        & (F.col("_text") == F.col("_kept_text"))
        & F.col("host").eqNullSafe(F.col("_kept_host"))
    )
    text = F.col("_row")["text"]
    new = F.when(F.col("_removed").isNull(), text).otherwise(lines_without(text, F.col("_removed")))
    return restored(rows.join(kept, same).withColumn("_new", new), documents, "_row", "_new")
