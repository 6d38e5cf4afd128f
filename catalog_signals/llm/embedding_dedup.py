"""Near-duplicate embeddings: sign hashes by random hyperplanes, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.buckets import chunked, links_in_buckets, rough_links, shared_buckets
from catalog_signals.llm.components import resolved
from catalog_signals.llm.text import checkpointed, straight_from_shuffle
from catalog_signals.llm.words import mixed


@dataclass(frozen=True)
class Hyperplanes:
    """Vectors link from ``cosine`` on. Tables have as many bits as make a bucket of the largest label
    hold about ``bucket`` vectors, and there are as many tables as find a pair at the threshold with
    probability ``recall``; pairs above it are found more surely."""

    cosine: float = 0.93
    recall: float = 0.9999
    bucket: int = 512
    seed: int = 0

    def shape(self, largest: int) -> tuple[int, int]:
        bits = max(4, math.ceil(math.log2(max(largest, 1) / self.bucket)))
        same = (1 - math.acos(self.cosine) / math.pi) ** bits
        return bits, math.ceil(math.log(1 - self.recall) / math.log(1 - same))


def _vectors(values: pa.ListArray, usable: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors, as one matrix per number of components, of the usable rows that have a direction; scaled
    so that the largest component is 1."""
    flat = values.flatten()
    numbers = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component is not a number
    size = np.asarray(values.value_lengths().fill_null(0))
    start = np.cumsum(size) - size
    for d in np.unique(size[usable & (size > 0)]).tolist():
        at = np.flatnonzero(usable & (size == d))
        matrix = numbers[start[at][:, None] + np.arange(d)]
        largest = np.abs(matrix).max(1)
        good = np.isfinite(largest) & (largest > 0)
        yield at[good], matrix[good] / largest[good][:, None]


def _sketches(vectors: np.ndarray) -> list[bytes]:
    """Per vector, at length 1: components as whole numbers of a step, the step, and how far off that is."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    step = np.abs(unit).max(1) / 127
    whole = np.rint(unit / step[:, None]).astype(np.int8)
    off = np.linalg.norm(unit - whole * step[:, None], axis=1)
    heads = np.stack([step, off], 1)
    return [heads[i].tobytes() + whole[i].tobytes() for i in range(len(unit))]


def _maybe_near(cosine: float):
    """Pairs whose cosine may reach the threshold: that of the sketches, and at most as much more as both are off."""

    def verify(payloads: list[bytes]) -> np.ndarray:
        step, off = np.stack([np.frombuffer(p, np.float64, 2) for p in payloads]).T
        whole = np.stack([np.frombuffer(p, np.int8, -1, 16) for p in payloads])
        # products of 127 times 127 add up exactly in single precision for up to 1,024 components
        whole = whole.astype(np.float32 if whole.shape[1] <= 1024 else np.float64)
        dots = (whole @ whole.T) * step[:, None] * step[None, :]
        # a sketch has at most the length 1 + off
        more = off[:, None] + off[None, :] + 3 * off[:, None] * off[None, :]
        return dots + more >= cosine - 1e-9

    return verify


def _hashed(embeddings: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``vec_id``, ``node`` (a hash of label and vector), ``payload``, ``sketch`` and ``buckets``; all but the first
    are null for vectors that link with nothing."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        table_ids = np.arange(tables, dtype=np.uint64) << np.uint64(48)
        for batch in batches:
            n = batch.num_rows
            node, payload, sketch, buckets = [None] * n, [None] * n, [None] * n, [None] * n
            labelled = np.asarray(batch["label"].is_valid())
            labels = np.asarray(batch["label"].fill_null(0)).astype(np.int64).astype(np.uint64)
            for at, vectors in _vectors(batch["embedding"], labelled):
                d = vectors.shape[1]
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, tables * bits))
                code = ((vectors @ planes[d]) > 0).reshape(len(at), tables, bits) @ weights
                key = mixed(mixed(labels[at] + np.uint64(1)) ^ np.uint64(d))
                content = np.ascontiguousarray(vectors + 0.0).view(np.uint64)
                places = mixed(np.arange(d, dtype=np.uint64)[None, :] + key[:, None])
                digest = mixed(mixed(content + places).sum(1) ^ key).astype(np.int64)
                paths = mixed(mixed(code + table_ids[None, :]) + key[:, None]).astype(np.int64)
                for i, row, short in zip(at.tolist(), range(len(at)), _sketches(vectors)):
                    node[i], payload[i], sketch[i], buckets[i] = int(digest[row]), vectors[row].tobytes(), short, paths[row]
            yield pa.record_batch([
                batch["vec_id"], pa.array(node, pa.int64()), pa.array(payload, pa.binary()),
                pa.array(sketch, pa.binary()), pa.array(buckets, pa.list_(pa.int64())),
            ], names=["vec_id", "node", "payload", "sketch", "buckets"])

    slim = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.col("label").cast("bigint").alias("label")
    )
    return slim.mapInArrow(
        sign, "vec_id bigint, node bigint, payload binary, sketch binary, buckets array<bigint>"
    )


def _near(cosine: float):
    def verify(payloads: list[bytes]) -> np.ndarray:
        vectors = np.stack([np.frombuffer(p, np.float64) for p in payloads])
        dots = vectors @ vectors.T
        norms = np.sqrt(np.diag(dots))
        return dots / (norms[:, None] * norms[None, :]) >= cosine

    return verify


def _members(rows: DataFrame, payloads: DataFrame) -> DataFrame:
    """``bucket``, ``node`` and ``node``, ``weight``, ``payload`` -> one row per node, with its buckets."""
    sized = rows.withColumn("_size", F.lit(8))
    placed = chunked(sized, "_size").withColumnRenamed("node", "_node")
    return placed.join(payloads, F.col("node") == F.col("_node")).drop("_node")


def near_duplicates(embeddings: DataFrame, how: Hyperplanes | None = None) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Only rows with equal labels are compared. Null, empty, zero vectors, those with null or non-finite
    components and those without a label link with nothing and are kept. Vectors equal up to a
    positive factor that scales them to the same numbers are one node, so a vector that millions of
    rows share costs one comparison. Null ids: compared like others; a component takes its least id.
    """
    how = how or Hyperplanes()
    largest = embeddings.where("label is not null").groupBy("label").count().agg(F.max("count")).first()[0]
    bits, tables = how.shape(largest or 1)
    hashed = checkpointed(_hashed(embeddings, bits, tables, how.seed))
    classes = hashed.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"),
        F.first("payload").alias("payload"), F.first("sketch").alias("sketch"), F.first("buckets").alias("_buckets"),
    )
    classes = checkpointed(classes)
    rows = shared_buckets(classes.select("node", F.explode("_buckets").alias("bucket")))
    sketched = _members(rows, classes.select("node", F.lit(1).alias("weight"), F.col("sketch").alias("payload")))
    near = checkpointed(rough_links(sketched, _maybe_near(how.cosine)).select("bucket", "node").distinct())
    # vectors travel only to the buckets where they may have a partner; of those with the same vectors, one is left
    whole = _members(shared_buckets(near), classes.select("node", "weight", "payload"))
    found = checkpointed(links_in_buckets(whole, _near(how.cosine)))
    found = found.select("node", "links", "least")
    done = resolved(classes.select("node", "first"), found).withColumnRenamed("node", "_n")
    done = done.join(classes.select(F.col("node").alias("_w"), "weight"), F.col("_n") == F.col("_w"))
    joined = hashed.select("vec_id", "node").join(straight_from_shuffle(done), F.col("node") == F.col("_n"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("first"))
    return joined.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
