"""Sharding by sampled splitters.

Records have a key: a hash of the text, then of the id. A size-weighted sample of keys gives quantile
boundaries of many small ranges; records are partitioned by range, the ranges are measured, and
overfull ones are subdivided by a sample of their own. Shards are runs of ranges of near equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from catalog_signals.llm.text import checkpointed, text_of

#: Bytes that a record needs besides its text.
OVERHEAD = 16


@dataclass(frozen=True)
class Sharding:
    """``ranges`` per shard before subdivision, ``samples`` keys per range (a bound on what the driver
    receives: shards * ranges * samples keys of 8 bytes, twice at most), up to ``rounds`` subdivisions
    of ranges with more than twice their share."""

    shards: int = 40
    ranges: int = 64
    samples: int = 32
    rounds: int = 3
    seed: int = 0


def _keyed(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and ``_key``: 32 bits of the text's hash, 20 of the id's, and
    12 of the row's number, which tell apart rows that repeat both.

    Equal texts are neighbours in the order of keys, and a group of any size can be divided.
    """
    body = text_of().cast("binary")
    text = F.shiftleft(F.shiftright(F.xxhash64(body), 32), 32)
    doc = F.shiftleft(F.xxhash64("doc_id").bitwiseAND(2**20 - 1), 12)
    row = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(2**12 - 1)
    return documents.select(
        "doc_id",
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        text.bitwiseOR(doc).bitwiseOR(row).alias("_key"),
    )


def _sample(keyed: DataFrame, step: float, salt: int) -> np.ndarray:
    """Keys, sorted: a record of that many steps' size is drawn so many times, the rest by chance.

    The chance is a hash of the key, so a task that runs again draws the same.
    """
    unit = F.pmod(F.xxhash64("_key", F.lit(salt)), F.lit(2**30)) / float(2**30)
    drawn = keyed.select("_key", F.floor(F.col("size") / F.lit(step) + unit).alias("_n")).where("_n > 0")
    rows = drawn.toArrow()
    return np.sort(np.repeat(rows["_key"].to_numpy(), np.minimum(rows["_n"].to_numpy(), 64)))


def _in_ranges(keyed: DataFrame, splitters: np.ndarray) -> DataFrame:
    """Adds ``_range``: the number of splitters at or below the key."""
    names = [*keyed.columns, "_range"]
    schema = StructType([*keyed.schema.fields, StructField("_range", IntegerType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(splitters, batch["_key"].to_numpy(), "right").astype(np.int32)
            yield pa.record_batch([*batch.columns, pa.array(at)], names=names)

    return keyed.mapInArrow(place, schema)


def _measured(ranged: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and records of each of ``n`` ranges."""
    rows = ranged.groupBy("_range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).toArrow()
    sizes, counts = np.zeros(n, np.int64), np.zeros(n, np.int64)
    sizes[rows["_range"].to_numpy()] = rows["b"].to_numpy()
    counts[rows["_range"].to_numpy()] = rows["n"].to_numpy()
    return sizes, counts


def _split(keyed: DataFrame, how: Sharding) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The records with their range, and bytes and records of the ranges."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    wanted = how.shards * how.ranges
    share = max(total / wanted, 1.0)
    keys = _sample(keyed, share / how.samples, how.seed)
    # boundaries lie between groups of equal texts at first; only overfull ranges are divided within one
    splitters = np.unique(keys[how.samples :: how.samples] & ~np.int64(2**32 - 1))
    for turn in range(how.rounds + 1):
        ranged = _in_ranges(keyed, splitters)
        sizes, counts = _measured(ranged, len(splitters) + 1)
        overfull = np.flatnonzero((sizes > 2 * share) & (counts > 1))
        if turn == how.rounds or not len(overfull):
            break
        inside = ranged.where(F.col("_range").isin(overfull.tolist()))
        more = _sample(inside.select("_key", "size"), share / how.samples, how.seed + turn + 1)
        added = np.unique(np.concatenate([splitters, more[how.samples // 2 :: how.samples]]))
        if len(added) == len(splitters):
            break
        splitters = added
    return ranged, sizes, counts


def shard(documents: DataFrame, how: Sharding | None = None) -> DataFrame:
    """Per record: ``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot``, its place there from 0.

    Shards are near equal in bytes, to about the size of a range (1/64 of a shard) or of the largest
    record. Equal texts lie side by side, in one shard unless they alone are several ranges. Null text:
    no bytes. Null ids and repeated rows: records like any other. No documents: no rows. The driver
    receives samples of a fixed size and one number per range.
    """
    how = how or Sharding()
    keyed = checkpointed(_keyed(documents))
    ranged, sizes, counts = _split(keyed, how)
    middle = np.cumsum(sizes) - sizes / 2
    shards = np.minimum(middle * how.shards // max(int(sizes.sum()), 1), how.shards - 1).astype(np.int32)
    before = np.cumsum(counts) - counts
    first = np.searchsorted(shards, shards, "left")
    base = before - before[first]
    names = ["doc_id", "size", "text_crc32", "shard", "slot"]
    types = {f.name: f.dataType.simpleString() for f in keyed.schema}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["_range"].to_numpy()
            slot = pa.array(base[at] + batch["_at"].to_numpy())
            yield pa.record_batch([*(batch[c] for c in names[:3]), pa.array(shards[at]), slot], names=names)

    order = Window.partitionBy("_range").orderBy("_key", "doc_id", "size")
    numbered = ranged.withColumn("_at", (F.row_number().over(order) - 1).cast("bigint"))
    schema = f"doc_id {types['doc_id']}, size bigint, text_crc32 bigint, shard int, slot bigint"
    return numbered.select(*names[:3], "_range", "_at").mapInArrow(place, schema)
