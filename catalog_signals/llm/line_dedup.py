"""Line dedup over overlapping windows of three lines.

Windows of consecutive lines are hashed, repeated windows are found over all documents, and the lines
that their later occurrences cover are removed. The order is that of ids, then of lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import (
    document_key,
    lines,
    lines_without,
    restored,
    straight_from_shuffle,
    text_of,
    without_gaps,
)


def line_windows(documents: DataFrame) -> DataFrame:
    """One row per window of three lines that follow each other (lines without a word are passed
    over): key, hash ``_window``, and the positions ``_at`` of its lines in the text."""
    hashed = F.transform(
        lines(text_of()), lambda line, i: F.struct(F.xxhash64(line).alias("h"), i.alias("at"), line.alias("l"))
    )
    worded = F.filter(hashed, lambda x: without_gaps(x["l"]) != "")
    slim = F.transform(worded, lambda x: F.struct(x["h"].alias("h"), x["at"].alias("at")))
    df = documents.select(*document_key(documents), slim.alias("_l"))

    def window(x, i):
        second, third = F.get("_l", i + 1), F.get("_l", i + 2)
        return F.struct(
            F.xxhash64(x["h"], second["h"], third["h"]).alias("w"), F.array(x["at"], second["at"], third["at"]).alias("at")
        )

    windows = F.slice(F.transform("_l", window), 1, F.greatest(F.size("_l") - 2, F.lit(0)))
    return df.select("_doc", "_text", F.inline(windows).alias("_window", "_at"))


def repeated_lines(documents: DataFrame) -> DataFrame:
    """Per document that loses lines: key and their positions, ``_removed``.

    A window that millions of documents share is counted in every task before the shuffle, and its
    rows join a single row of the other side, in as many tasks as adaptive execution makes of them.
    """
    place = F.struct("_doc", "_text", F.col("_at")[0].alias("_start"))
    repeated = (
        line_windows(documents)
        .groupBy(F.col("_window").alias("_w"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
        .where("_n > 1")
        .drop("_n")
    )
    later = (
        line_windows(documents)
        .join(straight_from_shuffle(repeated), F.col("_window") == F.col("_w"))
        .where(place > F.col("_first"))
    )
    covered = later.groupBy("_doc", "_text").agg(F.flatten(F.collect_set("_at")).alias("_removed"))
    return covered.select("_doc", "_text", F.array_distinct("_removed").alias("_removed"))


def _deduped(documents: DataFrame) -> DataFrame:
    """Per row: the row as a struct, the text that is left, and the counts of lines."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    rows = documents.select(*document_key(documents), row)
    gone = repeated_lines(documents).withColumnsRenamed({"_doc": "_gone_doc", "_text": "_gone_text"})
    same = (F.col("_doc") == F.col("_gone_doc")) & (F.col("_text") == F.col("_gone_text"))
    text = F.col("_row")["text"]
    return rows.join(gone, same, "left").select(
        "_row",
        F.when(F.col("_removed").isNull(), text).otherwise(lines_without(text, F.col("_removed"))).alias("_new"),
        F.coalesce(F.size(lines(text)), F.lit(0)).cast("bigint").alias("_n"),
        F.coalesce(F.size("_removed"), F.lit(0)).cast("bigint").alias("_lost"),
    )


def dedup_lines(documents: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, the ``text`` without the lines of later windows, ``n_lines``, ``n_removed``.

    The first occurrence of every line stays somewhere, as a line goes only if the same line stands
    earlier. Null text: no lines, unchanged. Texts with under three worded lines: no windows,
    unchanged. Rows that repeat id and text: one document. A text whose lines all go is empty.
    """
    return _deduped(documents).select(
        F.col("_row")["doc_id"].alias("doc_id"), F.col("_new").alias("text"),
        F.col("_n").alias("n_lines"), F.col("_lost").alias("n_removed"),
    )


def deduped_documents(documents: DataFrame) -> DataFrame:
    """The documents after line dedup, without those it left without a word; columns unchanged."""
    left = _deduped(documents).where((F.col("_lost") == 0) | (without_gaps(F.col("_new")) != ""))
    return restored(left, documents, "_row", "_new")
