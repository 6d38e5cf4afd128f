"""What the operators share: words and lines as native expressions, tables, row identity, lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters between words: blank and \t \n \v \f \r, in a Java character class.
WORD_GAP = r"[\x20\x09-\x0D]+"
_GAP_CHARACTERS = " \t\n\x0b\x0c\r"

#: Stands for a null doc_id where a key must not be null.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order: its longest runs of other characters than the six gaps."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def without_gaps(text: Column) -> Column:
    for gap in _GAP_CHARACTERS:
        text = F.replace(text, F.lit(gap))
    return text


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def lines_without(text: Column, removed: Column) -> Column:
    """The text without its lines at the positions ``removed``, from 0. Both the lines and the places that
    stay are made once per text, so that the time follows the lines, however many go."""

    def kept(split: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), removed)
        return F.transform(places, lambda at: split[at])

    return F.array_join(F.transform(F.array(lines(text)), kept)[0], "\n")


def normal_line(line: Column) -> Column:
    """A line in lower case, with single blanks between its words and none around them."""
    return F.trim(F.regexp_replace(F.lower(line), WORD_GAP, " "))


def document_key(df: DataFrame) -> list[Column]:
    """What tells documents apart: id and text. Rows that agree in both are one document, repeated,
    and get one result each. Neither part is null, so the key joins with ``=``."""
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID))
    return [doc.alias("_doc"), F.xxhash64(F.coalesce(df["text"], F.lit(""))).alias("_text")]


def restored(df: DataFrame, documents: DataFrame, row: str, text: str) -> DataFrame:
    """The columns of ``documents`` out of the struct ``row``, with ``text`` as the text and
    ``n_chars``, where there is such a column, following it."""
    new = {"text": F.col(text)}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length(text).cast(documents.schema["n_chars"].dataType)
    return df.select(*[new.get(c, F.col(row)[c]).alias(c) for c in documents.columns])


def straight_from_shuffle(df: DataFrame) -> DataFrame:
    """An aggregate dealt out by turns, so that a join on its key shuffles it once more.

    A join whose both sides come straight from a shuffle is one that adaptive execution can split at
    a hot key; over an aggregate on the same key there would be no shuffle. For small aggregates.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, stored in the cluster's checkpoint folder, with their lineage cut.

    The folder is the session's ``spark.checkpoint.dir``. A session that names none gets a folder of this
    machine, as in tests, but only if it runs on this machine alone; on a cluster that is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "llm-checkpoints"))
    return df.checkpoint()
