"""Text quality: random-indexing word vectors, pooled per document, in a two-layer network.

Every word of a text is two tokens: the word in small letters, and its shape, which tells capitals,
digits, the signs it holds and whether it repeats the word before. Tokens are hashed to a fixed number of
rows. A row has a sparse random index vector and, as its word vector, that one and the sum of the
index vectors of the tokens around it, everywhere in the corpus. Texts are pooled into the mean of
their tokens' vectors, and only such means, of a bounded number of labelled documents, reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import checkpointed, text_of

#: Words whose tokens a worker remembers; it starts anew when there are more.
_REMEMBERED = 500_000
#: Tokens whose neighbours are counted at a time.
_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Indexing:
    """``rows`` of ``dimensions`` numbers are the model's vectors, whatever the corpus; tokens up to ``window``
    places away are neighbours. ``sample`` bounds the labelled documents that the network of ``hidden``
    units is fitted to, half of them of either class where there are as many; a quarter of them sets the
    temperature. ``decay`` pulls weights to zero. A text is good from ``threshold`` on."""

    rows: int = 1 << 14
    dimensions: int = 32
    window: int = 2
    sample: int = 6000
    hidden: int = 16
    steps: int = 400
    rate: float = 0.02
    decay: float = 1e-4
    threshold: float = 0.7
    seed: int = 0


@dataclass(frozen=True)
class Network:
    """Standardised inputs, a layer of tanh, a logit over ``temperature``."""

    centre: np.ndarray
    spread: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.spread @ self.inner + self.inner_bias) @ self.outer + self.outer_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def index_vectors(how: Indexing) -> tuple[np.ndarray, np.ndarray]:
    """The two places of every row's index vector: one holds 1, the other -1."""
    rng = np.random.default_rng(how.seed)
    plus = rng.integers(0, how.dimensions, how.rows)
    return plus, (plus + rng.integers(1, how.dimensions, how.rows)) % how.dimensions


def _row(token: str, how: Indexing) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % how.rows


def word_and_shape(word: str) -> tuple[str, str]:
    """The letters and digits of a word in small letters, and its case, whether it has digits, and its signs."""
    plain = "".join(c for c in word if c.isalnum())
    case = "A" if len(plain) > 1 and plain.isupper() else "a"
    digits = "0" if any(c.isdigit() for c in plain) else ""
    return plain.lower(), " " + case + digits + "".join(sorted(set(word) - set(plain)))


class _Tokens:
    """Rows of the tokens of texts, with those of the words seen so far remembered."""

    def __init__(self, how: Indexing) -> None:
        self.how, self.known = how, {}
        self.again = _row(" again", how)

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        known = self.known
        try:
            both = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(known) > _REMEMBERED:
                known.clear()
            for word in set(words):
                if word not in known:
                    plain, shape = word_and_shape(word)
                    known[word] = _row(plain, self.how) << 32 | _row(shape, self.how)
            both = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        tokens = np.empty(2 * len(both), np.int64)
        tokens[0::2], tokens[1::2] = both >> 32, both & 0xFFFFFFFF
        tokens[3::2][both[1:] == both[:-1]] = self.again
        return tokens


def neighbour_sums(tokens: np.ndarray, how: Indexing) -> np.ndarray:
    """Per row, the sum of the index vectors of its tokens' neighbours. Texts are set apart by ``window`` times -1."""
    plus, minus = index_vectors(how)
    n = how.rows * how.dimensions
    sums = np.zeros(n, np.int64)
    for step in range(1, how.window + 1):
        one, two = tokens[:-step], tokens[step:]
        real = (one >= 0) & (two >= 0)
        one, two = one[real], two[real]
        for a, b in ((one, two), (two, one)):
            at = a * how.dimensions
            sums += np.bincount(at + plus[b], minlength=n)
            sums -= np.bincount(at + minus[b], minlength=n)
    return sums.reshape(how.rows, how.dimensions)


def context_sums(documents: DataFrame, how: Indexing) -> DataFrame:
    """``row`` and ``d0``, ``d1``, ...: the neighbours of every row's tokens in all whole texts, added up in
    every task first, so that a task sends each row once."""
    names = [f"d{i}" for i in range(how.dimensions)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, size = _Tokens(how), [], 0
        apart = np.full(how.window, -1)
        total = np.zeros((how.rows, how.dimensions), np.int64)
        for batch in batches:
            for text in batch["text"]:
                held += [tokens.of(text.as_py()), apart]
                size += len(held[-2])
                if size > _AT_ONCE:
                    total += neighbour_sums(np.concatenate(held), how)
                    held, size = [], 0
        if held:
            total += neighbour_sums(np.concatenate(held), how)
        rows = np.flatnonzero(total.any(1))
        columns = [pa.array(rows.astype(np.int32)), *[pa.array(total[rows, i]) for i in range(how.dimensions)]]
        yield pa.record_batch(columns, names=["row", *names])

    schema = "row int, " + ", ".join(f"{n} bigint" for n in names)
    parts = documents.select(text_of().alias("text")).mapInArrow(count, schema)
    return parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names])


def word_vectors(documents: DataFrame, how: Indexing) -> np.ndarray:
    """A vector per row: its neighbours' sum, of length 1, and its own index vector, of length 1. The table
    has the same size for any corpus."""
    sums = context_sums(documents, how).toArrow()
    context = np.zeros((how.rows, how.dimensions))
    context[sums["row"].to_numpy()] = np.stack([sums[f"d{i}"].to_numpy() for i in range(how.dimensions)], 1)
    context /= np.maximum(np.linalg.norm(context, axis=1), 1e-9)[:, None]
    plus, minus = index_vectors(how)
    every = np.arange(how.rows)
    context[every, plus] += 2**-0.5
    context[every, minus] -= 2**-0.5
    return context.astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """The fourth of the documents that is never learnt from. A null id counts as an empty text, whose
    remainder is 0; having no label it is not learnt from either."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _pool(texts: list[str], tokens: _Tokens, vectors: np.ndarray) -> np.ndarray:
    """The mean vector of each text's tokens; zero for a text without any."""
    rows = [tokens.of(t) for t in texts]
    out = np.zeros((len(texts), vectors.shape[1]))
    for i, own in enumerate(rows):
        for at in range(0, len(own), _AT_ONCE):
            out[i] += vectors[own[at : at + _AT_ONCE]].sum(0, dtype=np.float64)
        out[i] /= max(len(own), 1)
    return out


def pooled(documents: DataFrame, vectors: np.ndarray, how: Indexing) -> DataFrame:
    """``doc_id`` and ``vector``, the mean of the text's token vectors."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens(how)
        for batch in batches:
            means = _pool(batch["text"].to_pylist(), tokens, vectors)
            yield pa.record_batch([batch["doc_id"], pa.array(list(means), pa.list_(pa.float64()))], names=["doc_id", "vector"])

    return documents.select("doc_id", text_of().alias("text")).mapInArrow(pool, f"doc_id {kind}, vector array<double>")


def _learnt(x: np.ndarray, y: np.ndarray, weight: np.ndarray, how: Indexing) -> Network:
    """The weights, by Adam on the weighted cross entropy; the temperature is 1."""
    rng = np.random.default_rng(how.seed)
    centre, spread = x.mean(0), x.std(0) + 1e-6
    z = (x - centre) / spread
    own = [
        rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], how.hidden)), np.zeros(how.hidden),
        rng.normal(0, how.hidden**-0.5, how.hidden), np.zeros(1),
    ]
    first, second = [np.zeros_like(p) for p in own], [np.zeros_like(p) for p in own]
    for step in range(1, how.steps + 1):
        for i, g in enumerate(gradients(own, z, y, weight, how.decay)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            scaled = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
            own[i] = own[i] - how.rate * (1 - step / (how.steps + 1)) * scaled
    return Network(centre, spread, own[0], own[1], own[2], float(own[3][0]), 1.0)


def loss(own: list[np.ndarray], z: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float) -> float:
    logit = np.tanh(z @ own[0] + own[1]) @ own[2] + own[3]
    entropy = np.logaddexp(0, logit) - y * logit
    return float((weight * entropy).sum() + decay / 2 * sum((p * p).sum() for p in own))


def gradients(own: list[np.ndarray], z: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float) -> list[np.ndarray]:
    inner = np.tanh(z @ own[0] + own[1])
    error = weight * (_sigmoid(inner @ own[2] + own[3]) - y)
    back = error[:, None] * own[2] * (1 - inner * inner)
    found = [z.T @ back, back.sum(0), inner.T @ error, error.sum(keepdims=True)]
    return [g + decay * p for g, p in zip(found, own)]


def _temperature(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The one of least weighted cross entropy between 1/4 and 16, by golden sections of its logarithm."""

    def cost(t: float) -> float:
        z = logits / np.exp(t)
        return float((weight * (np.logaddexp(0, z) - y * z)).sum())

    low, high, part = -np.log(4.0), np.log(16.0), (5**0.5 - 1) / 2
    for _ in range(40):
        one, two = high - part * (high - low), low + part * (high - low)
        low, high = (low, two) if cost(one) < cost(two) else (one, high)
    return float(np.exp((low + high) / 2))


def fit(x: np.ndarray, y: np.ndarray, share: float, how: Indexing) -> Network:
    """Network and temperature; ``share`` is the share of label 1 among all labels, to which the weights of
    the two classes of the sample are set. With one class only, every score is the share."""
    y = np.asarray(y, np.float64)
    back = np.arange(len(y)) % 4 == 3

    def weights(part: np.ndarray) -> np.ndarray:
        ones, zeros = max(y[part].sum(), 1), max((1 - y[part]).sum(), 1)
        return np.where(y == 1, share / ones, (1 - share) / zeros) * part

    if len(set(y[~back])) < 2:
        n = how.dimensions
        level = float(np.log(max(share, 1e-4) / max(1 - share, 1e-4)))
        return Network(np.zeros(n), np.ones(n), np.zeros((n, 1)), np.zeros(1), np.zeros(1), level, 1.0)
    net = _learnt(x[~back], y[~back], weights(~back)[~back], how)
    if len(set(y[back])) < 2:
        return net
    return Network(
        net.centre, net.spread, net.inner, net.inner_bias, net.outer, net.outer_bias,
        _temperature(net.logits(x[back]), y[back], weights(back)[back]),
    )


def train(documents: DataFrame, labels: DataFrame, vectors: np.ndarray, how: Indexing) -> Network:
    """Fit to at most ``how.sample`` labelled documents, those of least hash in either class.

    Several labels of a document count as their least. Null labels and ids are none. Of several texts with
    one id, that of least vector is taken.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_y"))
    known = checkpointed(known.where(~held_out(F.col("doc_id"))))
    share = known.agg(F.avg(F.col("_y").cast("double"))).first()[0]
    order = F.xxhash64("doc_id", F.lit(how.seed))
    halves = [known.where(F.col("_y") == y).orderBy(order, "doc_id").limit(how.sample // 2) for y in (0, 1)]
    chosen = halves[0].unionByName(halves[1]).withColumnRenamed("doc_id", "_id")
    # at most how.sample rows of two numbers, so every task can have them
    rows = documents.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    means = pooled(rows, vectors, how).groupBy("doc_id").agg(F.min("vector").alias("vector"))
    found = means.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "vector", "_y").toArrow()
    found = found.sort_by([("doc_id", "ascending")])
    shuffled = np.random.default_rng(how.seed).permutation(len(found))
    x = np.array(found["vector"].to_pylist()).reshape(-1, how.dimensions)[shuffled]
    return fit(x, found["_y"].to_numpy()[shuffled], 0.5 if share is None else share, how)


def score(documents: DataFrame, vectors: np.ndarray, network: Network, how: Indexing) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` from 0 to 1 and ``predicted`` (1 from the threshold on)."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens(how)
        for batch in batches:
            scores = network.score(_pool(batch["text"].to_pylist(), tokens, vectors))
            good = pa.array((scores >= how.threshold).astype(np.int32))
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(scores), good], names=names)

    names = ["doc_id", "held_out", "score", "predicted"]
    slim = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(rate, f"doc_id {kind}, held_out boolean, score double, predicted int")


def quality(documents: DataFrame, labels: DataFrame, how: Indexing | None = None) -> DataFrame:
    """``score`` of all documents, by word vectors of all texts and a network fitted to labels of documents
    that are not held out.

    Whole texts are read. Null and empty texts are pooled into zeros and scored as such; equal texts get
    equal scores, and rows that repeat get a row each. Null ids are kept. Without labels, or with those of
    one class only, all scores are the labels' share of 1, or 0.5. An empty table has no rows. Only
    ``doc_id`` and the text are read, whatever other columns there are.
    """
    how = how or Indexing()
    vectors = word_vectors(documents, how)
    return score(documents, vectors, train(documents, labels, vectors, how), how)
