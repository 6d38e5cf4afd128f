"""Jaccard self-join of documents on word shingles by chosen paths.

Sets choose paths of tokens: in each run a set takes each of its tokens with a probability that makes
a pair at the threshold share one on average, by a hash that all sets agree on, and so on below each
path while a bucket is large. Small buckets are compared by brute force, and runs are repeated until a
pair at the threshold is found with the target recall.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.buckets import chunked, links_in_buckets, rough_links, shared_buckets
from catalog_signals.llm.components import connected_components, resolved
from catalog_signals.llm.text import NULL_ID, checkpointed, document_key, straight_from_shuffle, text_of
from catalog_signals.llm.words import mixed, runs, word_hashes

_U = np.uint64
_ALL = 2.0**64


@dataclass(frozen=True)
class ChosenPaths:
    """Sets of ``words``-word shingles link from ``part / whole`` Jaccard on. Buckets of more than
    ``large`` sets are split, down to paths of ``depth`` tokens."""

    words: int = 5
    part: int = 4
    whole: int = 5
    large: int = 4096
    depth: int = 3
    recall: float = 0.998
    seed: int = 0

    @property
    def runs(self) -> int:
        """Runs that find a pair with the target recall even on paths of full depth.

        A pair's common paths form a branching process with Poisson children, at least one on
        average at the threshold; a run fails if it dies out before that depth.
        """
        fail = 0.0
        for _ in range(self.depth):
            fail = math.exp(fail - 1)
        return math.ceil(math.log(1 - self.recall) / math.log(fail))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Index and sorted distinct shingle hashes of each text. A text of fewer words is one shingle;
    one without words has none."""
    for first, hashes, bounds in word_hashes(texts, _AT_ONCE):
        shingles = runs(hashes, words)
        for i, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if end - start >= words:
                yield first + i, np.unique(shingles[start : end - words + 1])
            else:
                yield first + i, runs(hashes[start:end], end - start) if end > start else hashes[:0]


def _choose(tokens: np.ndarray, path: int, part: int, whole: int) -> np.ndarray:
    """The paths below ``path`` that the set takes."""
    odd = mixed(np.array([path], np.int64).astype(_U)) | _U(1)
    drawn = tokens * odd
    limit = min(_ALL * whole / (part * max(len(tokens), 1)), _ALL - 2048)
    chosen = tokens[drawn < _U(int(limit))]
    return mixed(mixed(chosen) + odd).astype(np.int64)


def _digest(tokens: np.ndarray) -> int:
    return int(mixed(mixed(tokens).sum(keepdims=True) ^ _U(len(tokens))).astype(np.int64)[0])


#: Bins of a sketch, the tokens from which on two sets are compared by it, and the bytes before any tokens.
_BINS, _SKETCHED = 128, 64
_HEAD = 4 + _BINS
#: Bytes of text hashed at a time, or a single longer text; the arrays for it are some forty times as large.
_AT_ONCE = 1 << 18


def _sketch(tokens: np.ndarray, tells: int) -> bytes:
    """The number of tokens, and eight bits of the least one in each bin of the hashes, 0 if empty; then the tokens
    themselves, if they are at most ``tells``."""
    edges = np.arange(_BINS, dtype=_U) << _U(57)
    first = np.searchsorted(tokens, edges)
    after = np.r_[first[1:], len(tokens)]
    least = tokens[np.minimum(first, len(tokens) - 1)]
    bits = np.where(first < after, ((least >> _U(16)) % _U(255)).astype(np.uint8) + 1, 0).astype(np.uint8)
    own = tokens.tobytes() if len(tokens) <= tells else b""
    return np.array([len(tokens)], np.uint32).tobytes() + bits.tobytes() + own


def _most_told(part: int, whole: int) -> int:
    """Tokens of the largest set that can be similar to one too small for sketches."""
    return (_SKETCHED - 1) * whole // part


def _maybe_similar(part: int, whole: int) -> Callable[[list[bytes]], np.ndarray]:
    """Pairs whose sizes allow the threshold and whose sketches agree in half of their bins; if one of the two sets
    is small, those that are similar, by their tokens.

    At a Jaccard of 0.8, 64 tokens fill some 50 bins for each, of which fewer than half agree less
    than once in a million times; larger sets are surer still. What passes is compared exactly.
    """
    exact = _similar(part, whole)

    def verify(payloads: list[bytes]) -> np.ndarray:
        data = np.stack([np.frombuffer(p, np.uint8, _HEAD) for p in payloads])
        size, bins = data[:, :4].copy().view(np.uint32)[:, 0].astype(np.int64), data[:, 4:]
        fits = whole * np.minimum(size[:, None], size[None, :]) >= part * np.maximum(size[:, None], size[None, :])
        n = len(size)
        agree, empty = np.zeros((n, n), np.int16), np.zeros((n, n), np.int16)
        if n <= 48:
            same, none = bins[:, None, :] == bins[None, :, :], bins == 0
            both = none[:, None, :] & none[None, :, :]
            agree, empty = (same & ~both).sum(2), both.sum(2)
        else:
            for column in bins.T:
                both = (column == 0)[:, None] & (column == 0)[None, :]
                agree += (column[:, None] == column[None, :]) & ~both
                empty += both
        linked = fits & (2 * agree >= _BINS - empty)
        small, told = size < _SKETCHED, np.flatnonzero(size <= _most_told(part, whole))
        linked &= ~(small[:, None] | small[None, :])
        if small.any():
            either = small[told][:, None] | small[told][None, :]
            linked[np.ix_(told, told)] |= either & exact([payloads[i][_HEAD:] for i in told.tolist()])
        return linked

    return verify


def _chosen(documents: DataFrame, how: ChosenPaths) -> DataFrame:
    """Per row: key, ``node`` (a hash of its set, null for none), ``size`` of the set, ``sketch``, ``paths``."""
    roots = [int(x) for x in mixed(np.arange(1, how.runs + 1, dtype=_U) + _U(how.seed << 20)).astype(np.int64)]
    tells = _most_told(how.part, how.whole)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, sketch, paths = [], [], [], []
            for _, tokens in shingle_sets(batch["text"], how.words):
                node.append(_digest(tokens) if len(tokens) else None)
                size.append(len(tokens))
                sketch.append(_sketch(tokens, tells) if len(tokens) else None)
                taken = [_choose(tokens, root, how.part, how.whole) for root in roots] if len(tokens) else []
                paths.append(np.unique(np.concatenate(taken)) if taken else [])
            yield pa.record_batch([
                batch["_doc"], batch["_text"], pa.array(node, pa.int64()), pa.array(size, pa.int64()),
                pa.array(sketch, pa.binary()), pa.array(paths, pa.list_(pa.int64())),
            ], names=["_doc", "_text", "node", "size", "sketch", "paths"])

    keyed = documents.select(*document_key(documents), text_of().alias("text"))
    return keyed.mapInArrow(
        choose, "_doc bigint, _text bigint, node bigint, size bigint, sketch binary, paths array<bigint>"
    )


def _with_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (with ``first``, the key of a document that has the set) and that document's text.

    ``wanted`` grows with the documents, so the join is a merge join at every size, never a broadcast.
    """
    keyed = documents.select(*document_key(documents), text_of().alias("text"))
    key = wanted.withColumns({"_d": F.col("first")["_doc"], "_t": F.col("first")["_text"]}).drop("first")
    joined = keyed.join(key.hint("merge"), (F.col("_doc") == F.col("_d")) & (F.col("_text") == F.col("_t")))
    return joined.drop("_d", "_t").dropDuplicates(["_doc", "_text"]).drop("_doc", "_text")


def _sketch_tokens(sketch: bytes) -> np.ndarray:
    """The bins of a sketch that aren't empty, with what they hold: a sample of the set's tokens."""
    bins = np.frombuffer(sketch, np.uint8, _HEAD)[4:].astype(_U)
    return mixed(((np.arange(len(bins), dtype=_U) << _U(8)) | bins)[bins > 0] + _U(1))


def _split(classes: DataFrame, large: DataFrame, how: ChosenPaths) -> DataFrame:
    """The paths below large buckets that their members take: ``bucket``, ``node``.

    The tokens to choose from are those of the sketch, so that no text has to be fetched for it.
    """

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, bucket = [], []
            rows = zip(batch["node"].to_pylist(), batch["paths"].to_pylist(), batch["payload"].to_pylist())
            for one, paths, sketch in rows:
                tokens = _sketch_tokens(sketch)
                for path in paths:
                    below = _choose(tokens, path, how.part, how.whole)
                    bucket.append(below)
                    node += [one] * len(below)
            buckets = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(buckets), pa.array(node, pa.int64())], names=["bucket", "node"])

    wanted = large.groupBy(F.col("node").alias("_n")).agg(F.collect_list("bucket").alias("paths"))
    members = wanted.join(classes.select("node", "payload"), F.col("node") == F.col("_n"))
    return members.select("node", "paths", "payload").mapInArrow(descend, "bucket bigint, node bigint")


def _buckets(classes: DataFrame, how: ChosenPaths) -> DataFrame:
    """``bucket``, ``node`` of all small buckets, and of those still large at full depth."""
    rows = classes.select(F.explode("paths").alias("bucket"), "node")
    small = None
    for depth in range(1, how.depth + 1):
        sizes = rows.groupBy(F.col("bucket").alias("_b")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        level = checkpointed(
            rows.join(straight_from_shuffle(sizes), F.col("bucket") == F.col("_b")).select("bucket", "node", "_n")
        )
        last = depth == how.depth
        here = level if last else level.where(F.col("_n") <= how.large)
        here = here.select("bucket", "node")
        small = here if small is None else small.unionByName(here)
        large = level.where(F.col("_n") > how.large)
        if last or large.isEmpty():
            break
        rows = _split(classes, large.select("bucket", "node"), how).distinct()
    return small


def _similar(part: int, whole: int) -> Callable[[list[bytes]], np.ndarray]:
    def verify(payloads: list[bytes]) -> np.ndarray:
        sets = [np.frombuffer(p, _U) for p in payloads]
        n, sizes = len(sets), np.array([len(s) for s in sets], np.float64)
        shared = np.zeros((n, n), np.float32)
        if n <= 4:
            for i in range(n):
                for j in range(i):
                    shared[i, j] = shared[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        else:
            row = np.repeat(np.arange(n), sizes.astype(np.int64))
            _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            keep = count[column] > 1
            row, column = row[keep], np.unique(column[keep], return_inverse=True)[1]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            for at in range(0, int(column.max(initial=-1)) + 1, 2048):
                lo, hi = np.searchsorted(column, [at, at + 2048])
                some = np.unique(row[lo:hi])
                m = np.zeros((len(some), 2048), np.float32)
                m[np.searchsorted(some, row[lo:hi]), column[lo:hi] - at] = 1
                shared[np.ix_(some, some)] += m @ m.T
        return whole * shared >= part * (sizes[:, None] + sizes[None, :] - shared)

    return verify


def _linked(documents: DataFrame, how: ChosenPaths) -> tuple[DataFrame, DataFrame]:
    """Per row its key and node; per node ``weight``, ``links``, ``component`` and the component's first key."""
    chosen = checkpointed(_chosen(documents, how))
    classes = checkpointed(
        chosen.where("node is not null").groupBy("node").agg(
            F.count(F.lit(1)).alias("weight"), F.min(F.struct("_doc", "_text")).alias("first"),
            F.first("size").alias("size"), F.first("sketch").alias("payload"), F.first("paths").alias("paths"),
        )
    )
    rows = shared_buckets(_buckets(classes, how))
    facts = classes.select("node", "weight", "size", "first")
    sketches = classes.select("node", "payload", F.lit(1).alias("weight"))
    most = _HEAD + 8 * _most_told(how.part, how.whole)
    placed = chunked(rows.withColumn("_size", F.lit(most)), "_size").withColumnRenamed("node", "_n")
    rough = placed.join(sketches, F.col("_n") == F.col("node")).drop("_n")
    rough = checkpointed(rough_links(rough, _maybe_similar(how.part, how.whole)))
    # buckets whose members may be similar merge, so that a set travels to one place, and pairs meet once
    merged = connected_components(rough, "node", "least").select(F.col("component").alias("bucket"), F.col("node").alias("_n"))
    sized = merged.join(facts.select("node", (8 * F.col("size")).alias("_size")), F.col("_n") == F.col("node"))
    per_node = chunked(sized.drop("_n"), "_size").withColumnRenamed("node", "_n")
    wanted = per_node.join(facts.select("node", "weight", "first"), F.col("_n") == F.col("node")).drop("_n")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [tokens.tobytes() for _, tokens in shingle_sets(batch["text"], how.words)]
            columns = [batch["node"], batch["weight"], pa.array(sets, pa.binary()), batch["buckets"]]
            yield pa.record_batch(columns, names=["node", "weight", "payload", "buckets"])

    texts = _with_sets(documents, wanted).select("node", "weight", "buckets", "text")
    members = texts.mapInArrow(
        encode, "node bigint, weight bigint, payload binary, buckets array<struct<bucket:bigint,chunks:bigint>>"
    )
    found = checkpointed(links_in_buckets(members, _similar(how.part, how.whole)))
    done = resolved(classes.select("node", "first"), found).join(
        classes.select(F.col("node").alias("_w"), "weight"), F.col("node") == F.col("_w")
    )
    return chosen.select("_doc", "_text", "node"), checkpointed(done.drop("_w"))


def jaccard_join(documents: DataFrame, how: ChosenPaths | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``class_id`` (least id of all documents it is connected with by links),
    ``n_links`` (other rows linked with it directly), ``set_id`` (least id of those with the same set).

    Texts without words, null ones too, link with nothing. Texts of fewer than five words have one
    shingle, and link if equal. Repeated rows have the same set, hence link. Null ids count as the
    least id and are given as null. Documents with the same set are one node, however many they are.
    """
    rows, nodes = _linked(documents, how or ChosenPaths())
    own = rows.where("node is not null").groupBy("node").agg(F.min("_doc").alias("_set"))
    nodes = nodes.withColumnRenamed("node", "_n").join(own, F.col("_n") == F.col("node")).drop("node")
    joined = rows.join(straight_from_shuffle(nodes), F.col("node") == F.col("_n"), "left")

    def given(doc: Column) -> Column:
        return F.when(doc != NULL_ID, doc)

    return joined.select(
        given(F.col("_doc")).alias("doc_id"),
        given(F.coalesce(F.col("first")["_doc"], F.col("_doc"))).alias("class_id"),
        F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        given(F.coalesce("_set", "_doc")).alias("set_id"),
    )


def distinct_documents(documents: DataFrame, how: ChosenPaths | None = None) -> DataFrame:
    """One document of each group of connected documents, the one of least id; columns unchanged.

    Documents without words link with nothing, so they stay, but for repeated rows.
    """
    rows, nodes = _linked(documents, how or ChosenPaths())
    nodes = nodes.select(F.col("node").alias("_n"), F.col("first").alias("_first"))
    joined = rows.join(straight_from_shuffle(nodes), F.col("node") == F.col("_n"), "left")
    leads = joined.where(F.col("_first").isNull() | (F.col("_first") == F.struct("_doc", "_text")))
    leads = leads.select(F.col("_doc").alias("_d"), F.col("_text").alias("_t")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    kept = documents.select(*document_key(documents), row).join(
        straight_from_shuffle(leads), (F.col("_doc") == F.col("_d")) & (F.col("_text") == F.col("_t"))
    )
    kept = kept.dropDuplicates(["_doc", "_text"])
    return kept.select(*[F.col("_row")[c].alias(c) for c in documents.columns])
