"""Brute force inside buckets of candidates, whatever their size, without emitting pairs.

A bucket is compared in blocks of two chunks of members, so a large one is spread over many tasks, and
each block yields one row per member: how many links it has there, and the least member that the block
connects it with. A pair that meets in several buckets counts in the one of least id only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import straight_from_shuffle

#: From the payloads of n members to the n x n matrix of those that are linked; its diagonal doesn't count.
Verify = Callable[[list[bytes]], np.ndarray]

#: Members, and bytes of their payloads, that a chunk has at most (or one member).
_CHUNK, _CHUNK_BYTES = 1024, 32 << 20


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``bucket``, ``node`` rows -> those of buckets with two nodes or more; of buckets that hold the
    same nodes, one is kept, recognised by the number of nodes and two sums of their hashes."""
    sizes = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("_x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_y"),
    ).where("members > 1")
    once = sizes.groupBy("members", "_x", "_y").agg(F.min("bucket").alias("_bucket"))
    kept = straight_from_shuffle(once.select("_bucket", "members"))
    return rows.join(kept, F.col("bucket") == F.col("_bucket")).select("bucket", "node")


def _linked_pairs(linked: np.ndarray, cross: np.ndarray | None) -> np.ndarray:
    np.fill_diagonal(linked, False)
    if cross is not None:
        linked &= cross[:, None] != cross[None, :]
    return linked


def _met_before(linked: np.ndarray, bucket: int, others: list[np.ndarray]) -> np.ndarray:
    """Which pairs share a bucket of a lesser id."""
    n = len(others)
    row = np.repeat(np.arange(n), [len(o) for o in others])
    ids = np.concatenate(others) if n else np.zeros(0, np.int64)
    before = ids < bucket
    values, column, count = np.unique(ids[before], return_inverse=True, return_counts=True)
    row = row[before]
    met = np.zeros((n, n), np.float32)
    keep = count[column] > 1
    column = np.unique(column[keep], return_inverse=True)[1] if keep.any() else column[keep]
    row = row[keep]
    for at in range(0, int(column.max(initial=-1)) + 1, 1024):
        inside = (column >= at) & (column < at + 1024)
        m = np.zeros((n, 1024), np.float32)
        m[row[inside], column[inside] - at] = 1
        met += m @ m.T
    return met > 0


def _least_connected(linked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    order = np.argsort(nodes, kind="stable")
    label = np.empty(len(nodes), np.int64)
    label[order] = np.arange(len(nodes))
    a, b = np.nonzero(linked)
    while len(a):
        new = label.copy()
        np.minimum.at(new, a, label[b])
        new = np.minimum(new, label[order[new]])
        if (new == label).all():
            break
        label = new
    return nodes[order[label]]


def _compare(verify: Verify, members: dict[str, np.ndarray], payloads: list[bytes], others: list[np.ndarray]):
    linked = _linked_pairs(verify(payloads), members["chunk"] if members["cross"][0] else None)
    if not linked.any():
        return None
    counted = linked & ~_met_before(linked, int(members["bucket"][0]), others)
    links = counted @ members["weight"]
    least = _least_connected(linked, members["node"])
    some = linked.any(1)
    return members["node"][some], links[some], least[some]


_LINKS = "node bigint, links bigint, least bigint"
_NUMBERS = ("bucket", "low", "high", "chunk", "cross", "node", "weight")


def _dealt(members: DataFrame, met: bool) -> DataFrame:
    """``members`` dealt to the blocks of their buckets, in the order of buckets and blocks; with all ``others`` of
    their buckets, if it matters whether a pair ``met`` before.

    A block is that of a chunk with itself, or of two chunks, and then has the members of both.
    """
    chunk = F.pmod(F.xxhash64("node", F.lit(7)), F.col("b.chunks")).cast("int")
    own = members.select("node", "weight", "payload", "buckets", F.explode("buckets").alias("b")).select(
        "node", "weight", "payload", F.col("buckets")["bucket"].alias("others"), F.col("b.bucket").alias("bucket"),
        chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("b.chunks").cast("int") - 1)).alias("other"),
    )
    dealt = own.select(
        "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk",
        (F.col("chunk") != F.col("other")).cast("int").alias("cross"), "node", "weight",
        *(["others"] if met else []), "payload",
    )
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")


def rough_links(members: DataFrame, verify: Verify) -> DataFrame:
    """``bucket``, ``node``, ``least`` of members that ``verify`` links with others, one row per member and block.

    For a cheap test on short payloads, before whole ones travel. ``members`` as in ``links_in_buckets``.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            chunk, cross, node = (table[c].to_numpy() for c in ("chunk", "cross", "node"))
            linked = _linked_pairs(verify(table["payload"].to_pylist()), chunk if cross[0] else None)
            some = linked.any(1)
            if some.any():
                least, bucket = _least_connected(linked, node), table["bucket"].to_numpy()
                columns = [pa.array(x[some]) for x in (bucket, node, least)]
                yield pa.record_batch(columns, names=["bucket", "node", "least"])

    return _dealt(members, met=False).mapInArrow(compare, "bucket bigint, node bigint, least bigint")


def links_in_buckets(members: DataFrame, verify: Verify) -> DataFrame:
    """``node``, ``links``, ``least``: links are weighed by the other node's ``weight``; rows add up.

    ``members`` has one row per node: ``node``, ``weight``, ``payload`` (binary) and ``buckets`` (array
    of structs of ``bucket``, ``chunks``). A node is in its bucket once per block that its chunk has.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            numbers = {c: table[c].to_numpy() for c in _NUMBERS}
            others = [np.asarray(x, np.int64) for x in table["others"].to_pylist()]
            found = _compare(verify, numbers, table["payload"].to_pylist(), others)
            if found is not None:
                yield pa.record_batch([pa.array(x.astype(np.int64)) for x in found], names=["node", "links", "least"])

    return _dealt(members, met=True).mapInArrow(compare, _LINKS)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows of one block each, of two rows or more, out of sorted batches."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        key = np.stack([table[c].to_numpy() for c in ("bucket", "low", "high")], 1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        if held and not (key[0] == [held[-1][c][0].as_py() for c in ("bucket", "low", "high")]).all():
            yield from _whole(held)
            held = []
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(table)]):
            held.append(table.slice(start, end - start))
            if end < len(table):
                yield from _whole(held)
                held = []
    yield from _whole(held)


def _whole(held: list[pa.Table]) -> Iterator[pa.Table]:
    if sum(map(len, held)) > 1:
        yield pa.concat_tables(held).combine_chunks()


def chunked(rows: DataFrame, payload_bytes: str) -> DataFrame:
    """``bucket``, ``node``, bytes of a node's payload -> per node its ``buckets`` with their chunks."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum(payload_bytes).alias("_bytes"))
    chunks = F.greatest(F.ceil(F.col("_n") / _CHUNK), F.ceil(F.col("_bytes") / _CHUNK_BYTES), F.lit(1))
    sizes = sizes.select(F.col("bucket").alias("_bucket"), F.least(chunks, F.col("_n")).cast("bigint").alias("chunks"))
    joined = rows.join(straight_from_shuffle(sizes), F.col("bucket") == F.col("_bucket"))
    return joined.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "chunks"))).alias("buckets")
    )
