"""Best-fit packing of token sequences by exact-complement hashing.

Packing is decided on the number of pieces of each length, at most ``capacity`` numbers however many
documents there are. Lengths, longest first, are completed exactly by one, two or three shorter
lengths, looked up in tables of sums, as often as all of them are available; what finds no exact
complement is packed best-fit. The plan says which ranks among the pieces of a length go where, and
pieces find their place by their rank.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_signals.llm.text import NULL_ID, checkpointed, text_of

_BUCKETS = 256
#: Chunks in either of the two generations that a worker remembers.
_REMEMBERED = 400_000
#: Bytes of text split into chunks at a time.
_AT_ONCE = 1 << 19


@dataclass(frozen=True)
class Packing:
    """``tokenizer`` is the path of a tokenizer file; ``end`` is the id put after each document."""

    tokenizer: str
    capacity: int = 4096
    end: int = 1


#: A full stop or comma between an ASCII letter and a gap.
_STOP = re.compile(rb"([.,])(?=[ \n])(?<=[a-z].)")
#: A run of letters that ends in an ASCII letter, and another ASCII character with what follows it.
_WORD_AND_TAIL = re.compile(rb"([A-Za-z\x80-\xff]*[A-Za-z])([^A-Za-z\x80-\xff].*)", re.DOTALL)


class _Tokens:
    """From a chunk of a text, as bytes without white space, to its token ids as bytes.

    White space never is part of a token here, nor does a token or a normalisation reach across it,
    so the ids of a text are those of its chunks in a row. A token doesn't reach from a letter to a
    character of another kind either, so most chunks are a word and a tail, which are learnt alone.
    When the recent chunks are many, they become the older ones, which are forgotten unless needed.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.recent, self.older = {}, {}
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.marks = [token.content.lower().encode() for token in added]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True) if suffix else {}
        self.ends = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def of_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk. Chunks of letters are encoded as one text, which is faster, where the
        vocabulary marks ends of words and each chunk turns out to be one word."""
        plain = [c for c in chunks if c.isalpha()] if len(self.ends) else []
        ids = {}
        if plain:
            text = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0]
            row = np.array(text.ids, "<u4")
            cuts = np.flatnonzero(self.ends[row]) + 1
            if len(cuts) == len(plain):
                data, at = row.tobytes(), [0, *(4 * cuts).tolist()]
                ids = {c: data[a:b] for c, a, b in zip(plain, at, at[1:])}
        others = [c for c in chunks if c not in ids]
        encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        ids |= {c: np.array(e.ids, "<u4").tobytes() for c, e in zip(others, encoded)}
        return [ids[c] for c in chunks]

    def learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """A dictionary that has all the given chunks."""
        if len(self.recent) > _REMEMBERED:
            self.recent, self.older = {}, self.recent
        recent, older = self.recent, self.older
        new = [c for c in chunks if c not in recent]
        if older:
            recent.update({c: older[c] for c in new if c in older})
            new = [c for c in new if c not in recent]
        parts = {c: m.groups() for c in new if (m := _WORD_AND_TAIL.fullmatch(c))}
        wanted = {c for c in new if c not in parts}.union(*parts.values())
        recent.update({c: older[c] for c in wanted if c in older and c not in recent})
        wanted = [c for c in wanted if c and c not in recent]
        recent.update(zip(wanted, self.of_chunks([c.decode("utf-8", "replace") for c in wanted])))
        for chunk, (word, tail) in parts.items():
            recent[chunk] = recent[word] + recent[tail]
        return recent

    def chunks(self, text: str) -> list[bytes]:
        """The text in lower case, if the tokenizer lowers it anyway and none of its special tokens,
        which are not lowered, can be in it; a full stop or comma after a word is a chunk of its own."""
        data = text.encode("utf-8", "replace")
        if self.lowers:
            low = data.lower()
            data = data if any(mark in low for mark in self.marks) else low
        return _STOP.sub(rb" \1", data).split()

    def of_texts(self, texts: list[str]) -> list[bytes]:
        chunks = [self.chunks(text) for text in texts]
        find = self.learn(set().union(*chunks)).__getitem__
        return [b"".join(map(find, of_text)) for of_text in chunks]


#: A worker process serves many tasks; it keeps what it has learnt.
_known: dict[str, _Tokens] = {}


def _tokens(path: str) -> _Tokens:
    if path not in _known:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        _known[path] = _Tokens(path)
    return _known[path]


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, some at a time: as many as have ``_AT_ONCE`` bytes of text, or a single longer one."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        turn = np.cumsum(sizes) // _AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


_PIECES = "_doc bigint, _null boolean, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(documents: DataFrame, how: Packing) -> DataFrame:
    """The documents as pieces of at most ``capacity`` tokens: place, length and checksum of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end, most = _tokens(how.tokenizer), np.array([how.end], "<u4").tobytes(), how.capacity * 4
        for batch in _sliced(batches):
            rows: list[tuple] = []
            texts = tokens.of_texts(batch["text"].to_pylist())
            for doc, ids in zip(batch["doc_id"].to_pylist(), texts):
                ids += end
                for piece, at in enumerate(range(0, len(ids), most)):
                    part = ids[at : at + most]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            doc, piece, start, length, crc = zip(*rows) if rows else ((),) * 5
            ids = pa.array(doc, pa.int64())
            yield pa.record_batch([
                ids.fill_null(NULL_ID), ids.is_null(), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ], names=["_doc", "_null", "piece", "start", "length", "ids_crc32"])

    slim = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return slim.mapInArrow(cut, _PIECES)


@dataclass
class _Group:
    """``count`` sequences filled alike: ``parts`` are (length, first rank, offset)."""

    count: int
    fill: int
    parts: list[tuple[int, int, int]]


class _Sums:
    """The available lengths by the sums of one, two and three of them.

    A sum remembers the combination last found for it. It is looked up again when that one is used
    up, and never again once there is none, as lengths are only ever taken away.
    """

    def __init__(self, left: np.ndarray) -> None:
        self.left, self.found = left, {}

    def _enough(self, parts: tuple[int, ...]) -> bool:
        return all(self.left[p] >= parts.count(p) for p in parts)

    def _search(self, total: int, many: int) -> tuple[int, ...] | None:
        if many == 1:
            return (total,) if total < len(self.left) and self.left[total] else None
        if many == 2:
            large = np.arange(min(total - 1, len(self.left) - 1), (total - 1) // 2, -1)
            small = total - large
            good = (self.left[large] > 0) & (self.left[small] > (large == small))
            at = int(good.argmax()) if len(good) else 0
            return (int(large[at]), int(small[at])) if len(good) and good[at] else None
        available = np.flatnonzero(self.left[: total - 1])
        for one in available[3 * available >= total][::-1].tolist():
            rest = self.of(total - one, 2)
            if rest and self._enough((one, *rest)):
                return (one, *rest)
        return None

    def of(self, total: int, many: int) -> tuple[int, ...] | None:
        key = (total, many)
        known = self.found.get(key, ())
        if known is None or known and self._enough(known):
            return known
        self.found[key] = found = self._search(total, many)
        return found


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, how many, first sequence, offset) that place every piece.

    Bounded by the number of lengths, not of pieces: every step uses up a length or a group.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    taken = np.zeros(capacity + 1, np.int64)
    sums, groups, open_groups = _Sums(left), [], []

    def take(length: int, count: int) -> int:
        first = int(taken[length])
        taken[length] += count
        left[length] -= count
        return first

    def exactly(parts: tuple[int, ...], count: int) -> None:
        placed, offset = [], 0
        firsts = {p: take(p, count * parts.count(p)) for p in set(parts)}
        for part in parts:
            placed.append((part, firsts[part], offset))
            firsts[part] += count
            offset += part
        groups.append(_Group(count, offset, placed))

    rest: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        if length == capacity and left[length]:
            exactly((length,), int(left[length]))
        many = 1
        while left[length] and many <= 3:
            left[length] -= 1
            others = sums.of(capacity - length, many)
            left[length] += 1
            if others is None:
                many += 1
                continue
            parts = (length, *others)
            exactly(parts, int(min(left[p] // parts.count(p) for p in set(parts))))
        if left[length]:
            rest.append((length, int(left[length])))
            left[length] = 0

    for length, count in rest:
        while count:
            fits = [g for g in open_groups if capacity - g.fill >= length]
            if not fits:
                each = capacity // length
                full = count // each
                new = [(full, each)] if full else []
                new += [(1, count % each)] if count % each else []
                for sequences, inside in new:
                    group = _Group(sequences, 0, [])
                    for _ in range(inside):
                        group.parts.append((length, take(length, sequences), group.fill))
                        group.fill += length
                    open_groups.append(group)
                count = 0
                break
            best = max(fits, key=lambda g: g.fill)
            each = (capacity - best.fill) // length
            if count < best.count * each:
                full = max(1, count // each)
                each = min(each, count)
                if full < best.count:
                    later = [(p, first + full, offset) for p, first, offset in best.parts]
                    open_groups.append(_Group(best.count - full, best.fill, later))
                    best.count = full
            for _ in range(each):
                best.parts.append((length, take(length, best.count), best.fill))
                best.fill += length
            count -= best.count * each
    rows, sequence = [], 0
    for group in groups + open_groups:
        rows += [(p, first, group.count, sequence, offset) for p, first, offset in group.parts]
        sequence += group.count
    return rows


def _ranked(cut: DataFrame) -> DataFrame:
    """``cut`` with ``_rank``, from 0 among all pieces of a length, by id and piece.

    A length is dealt over 256 buckets by id, which are ranked on their own; sums over the buckets
    before give the rest. So a length that a third of all pieces have is ranked by many tasks.
    """
    bucket = F.pmod(F.xxhash64("_doc", "piece", "ids_crc32"), F.lit(_BUCKETS))
    cut = cut.withColumn("_bucket", bucket)
    sizes = cut.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("length").alias("_l"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("length", "_bucket").orderBy("_doc", "piece", "ids_crc32")
    ranked = cut.withColumn("_at", F.row_number().over(inside) - 1)
    joined = ranked.join(starts, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn("_rank", F.col("_start") + F.col("_at"))


def pack(documents: DataFrame, how: Packing) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Null text: empty, one piece of the end token. Null ids stay null. Repeated rows: packed one by
    one. Only the number of pieces of each length reaches the driver.
    """
    cut = checkpointed(pieces(documents, how))
    counts = {row.length: row.n for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sorted(plan(counts, how.capacity))
    table = np.array(rows, np.int64).reshape(-1, 5)
    names = [*cut.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.int64(1) << np.int64(48)
        starts = table[:, 0] * shift + table[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            row = table[np.searchsorted(starts, length * shift + rank, "right") - 1]
            sequence = row[:, 3] + rank - row[:, 1]
            columns = [batch[c] for c in names[:-2]] + [pa.array(sequence), pa.array(row[:, 4])]
            yield pa.record_batch(columns, names=names)

    ranked = _ranked(cut).select(*cut.columns, "_rank")
    placed = ranked.mapInArrow(place, f"{_PIECES}, sequence_id bigint, offset bigint")
    return placed.select(
        F.when(~F.col("_null"), F.col("_doc")).alias("doc_id"),
        "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    )
