"""Mixing sources to target weights by systematic sampling.

The expected copies of a document are its source's target over its source's size. Within a source,
the copies are summed along a fixed order, one random offset is added, and a document is emitted once
for each integer its stretch of that sum crosses. The order goes by size first, so the words drawn
follow the target as closely as the number of documents does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_signals.llm.text import checkpointed, straight_from_shuffle, text_of, words


@dataclass(frozen=True)
class Mix:
    """Sources in code point order, null last, weigh ``weights`` in turn; a target is at most
    ``most_copies`` times its source's size. ``seed`` moves the offsets."""

    weights: tuple[int, ...] = (1, 2, 3)
    most_copies: int = 3
    seed: int = 0


def _unit(text: Column) -> Column:
    """A number from 0 to below 1 out of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def _size_class(size: Column) -> Column:
    """Classes that grow with the size, eight to each power of two: some 500 for all bigints."""
    bits = F.length(F.bin(size))
    return bits * 8 + F.expr("shiftright(_size, greatest(length(bin(_size)) - 4, 0))").bitwiseAND(7).cast("int")


def _placed(documents: DataFrame, source: str, *carry: Column) -> DataFrame:
    """Each row with its size and its place in the order of its source: class, bucket, key.

    The 256 buckets split the documents of one source and class, however many are equal.
    """
    size = F.size(words(text_of())).cast("bigint")
    df = documents.select(
        F.col("doc_id"), F.col(source).alias("_source"), size.alias("_size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_key"), *carry,
    )
    return df.select("*", _size_class(F.col("_size")).alias("_class"), F.substring("_key", 1, 2).alias("_bucket"))


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``_source``, ``source_size`` -> also ``target`` and ``copies``.

    Targets are weight times a common level, or the cap where that is less. With sources ordered by
    cap over weight, the level is the largest of (total - caps before) / (weights from here on): that
    share rises while the next source would exceed its cap, and falls afterwards. A mix names its
    sources, so that they number few enough to be ordered in one task; documents never are.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("_rank") - 1) % len(mix.weights) + 1)
    ranked = sources.withColumn("_rank", F.row_number().over(by_name)).withColumn("_weight", weight)
    capped = ranked.withColumn("_cap", F.col("source_size") * mix.most_copies)
    by_cap = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    every = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    shares = capped.withColumn("_level", rest.cast("double") / F.sum("_weight").over(onward))
    level = F.max("_level").over(every)
    target = F.least(F.col("_cap").cast("double"), level * F.col("_weight"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return shares.withColumn("target", target).select(
        "_source", "source_size", "target", copies.alias("copies")
    )


def _starts(placed: DataFrame, mix: Mix) -> DataFrame:
    """Per source, class and bucket: documents of the source before it, and the source's numbers.

    Sums go up in three steps and prefixes come down the same way, so no step orders more than the
    256 buckets of a class or the some 500 classes of a source.
    """
    slim = checkpointed(
        placed.groupBy("_source", "_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"))
    )
    classes = slim.groupBy("_source", "_class").agg(F.sum("_n").alias("_n"), F.sum("_words").alias("_words"))
    sources = classes.groupBy("_source").agg(F.sum("_words").alias("source_size"))

    def before(order: str, *within: str) -> Column:
        window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    offset = _unit(F.concat_ws("/", F.lit(str(mix.seed)), F.coalesce("_source", F.lit(""))))
    numbers = targets(sources, mix).withColumn("offset", offset).withColumnRenamed("_source", "_s")
    classes = (
        classes.select("_source", "_class", before("_class", "_source").alias("_before_class"))
        .join(numbers, F.col("_source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumnsRenamed({"_source": "_s", "_class": "_c"})
    )
    buckets = slim.select("_source", "_class", "_bucket", before("_bucket", "_source", "_class").alias("_before"))
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c"))
    joined = buckets.join(straight_from_shuffle(classes), same)
    return joined.select(
        F.col("_source").alias("_s"), F.col("_class").alias("_c"), F.col("_bucket").alias("_b"),
        (F.col("_before") + F.col("_before_class")).alias("_start"), "source_size", "target", "copies", "offset",
    )


def _drawn(placed: DataFrame, starts: DataFrame, *ties: str) -> DataFrame:
    """``placed`` with the source's numbers and ``_times``, how often each row is emitted."""
    order = Window.partitionBy("_source", "_class", "_bucket").orderBy("_key", "_size", *ties)
    same = (
        F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")) & (F.col("_bucket") == F.col("_b"))
    )
    ranked = placed.withColumn("_at", F.row_number().over(order)).join(starts, same)
    upto, whole = (F.col("_start") + F.col("_at")).cast("double"), F.floor("copies")
    # whole copies cross as many boundaries at every place; only what is left of them is a prefix sum, so
    # that rounding, however long the prefix, can't give a row more than one copy above the whole ones
    part = F.col("copies") - whole
    crossed = F.floor(F.col("offset") + upto * part) - F.floor(F.col("offset") + (upto - 1) * part)
    return ranked.withColumn("_times", (whole + F.least(crossed, F.lit(1))).cast("bigint"))


def mixture(documents: DataFrame, source: str = "source", mix: Mix | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``size`` in words, ``source_size``, ``target`` and ``taken`` words.

    Null text: size 0. Null source: a source of its own, ordered last. Repeated rows: drawn one by
    one. A row's draw depends on the seed, its source, size and id and on the sizes of the others,
    not on partitions, so reruns agree. No documents: no rows.
    """
    mix = mix or Mix()
    placed = checkpointed(_placed(documents, source))
    drawn = _drawn(placed, _starts(placed, mix))
    return drawn.select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * F.col("_times")).alias("taken"),
    )


def mixed_documents(documents: DataFrame, source: str = "source", mix: Mix | None = None) -> DataFrame:
    """The documents as the mixture has them, each row as often as it is drawn; columns unchanged."""
    mix = mix or Mix()
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    crc = F.crc32(text_of().cast("binary")).alias("_crc")
    starts = _starts(_placed(documents, source), mix)
    drawn = _drawn(_placed(documents, source, crc, row), starts, "_crc").where("_times > 0")
    emitted = drawn.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy"))
    return emitted.select(*[F.col("_row")[c].alias(c) for c in documents.columns])
