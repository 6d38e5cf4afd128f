"""Toxicity: bags of subword embeddings, averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, which unseen misspellings share. Windows
of words, one from every word on and those over either end, are averaged and classified, and a text is as toxic as its most toxic window, so that a few
words in a long text are not averaged away. For two classes the softmax is a logistic function of
the difference of the class weights, by which all vectors are projected before texts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import checkpointed, text_of
from catalog_signals.llm.words import mixed

_U = np.uint64
#: Words whose value a worker remembers; it starts anew when there are more.
_REMEMBERED = 500_000
#: Words taken apart at a time.
_AT_ONCE = 20_000
_EDGES = ".,;:!?\"'()[]"


@dataclass(frozen=True)
class Subwords:
    """``sample`` bounds the labelled documents that are fitted, half of them toxic where there are as
    many, and ``sample_bytes`` their texts, half of it for either class. ``average_steps`` train on whole texts, ``window_steps`` on the most toxic window of each."""

    sample: int = 6000
    sample_bytes: int = 24 << 20
    lengths: tuple[int, ...] = (3, 4, 5)
    buckets: int = 1 << 17
    dimensions: int = 8
    window: int = 4
    average_steps: int = 40
    window_steps: int = 60
    rate: float = 0.2
    seed: int = 0


@dataclass(frozen=True)
class Model:
    """``values`` of all n-gram buckets along the class difference, and the final scale and offset."""

    how: Subwords
    values: np.ndarray
    scale: float
    offset: float


def subwords(words: list[str], how: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of every word, and where each word's begin and the last one's end.

    The n-grams of ``<word>`` and the whole of it; the latter makes sure that there is one.
    """
    parts = [_subwords(words[at : at + _AT_ONCE], how) for at in range(0, len(words), _AT_ONCE)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    counts = np.concatenate([count for _, count in parts])
    return np.concatenate([bucket for bucket, _ in parts]), np.r_[0, np.cumsum(counts)]


def _subwords(words: list[str], how: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, word by word, and how many each word has."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    points, ends = points.astype(_U) + _U(1), np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    room = ends[owner] - np.arange(len(points))
    steps = mixed((sizes[owner] - room + 1).astype(_U))
    found, owners = [mixed(np.add.reduceat(points * steps, ends - sizes))], [np.arange(len(words))]
    code = np.zeros(len(points), _U)
    for n in range(1, max(how.lengths) + 1):
        code = code[: max(len(points) - n + 1, 0)] * _U(0x9E3779B97F4A7C15) + points[n - 1 :]
        if n in how.lengths:
            inside = room[: len(code)] >= n
            found.append(mixed(code[inside] + _U(n << 40)))
            owners.append(owner[: len(code)][inside])
    owner = np.concatenate(owners)
    bucket = (np.concatenate(found) % _U(how.buckets)).astype(np.int32)
    return bucket[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def _plain(word: str) -> str:
    return word.lower().strip(_EDGES)


def _means(values: np.ndarray, bucket: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[bucket], bounds[:-1]) / np.diff(bounds)


def _windows(values: np.ndarray, window: int) -> np.ndarray:
    """The sums of the ``window`` values up to each one, over ``window``; zero before the first."""
    sums = values.copy()
    for back in range(1, window):
        sums[back:] += values[:-back]
    return sums / window


class _Descent:
    """Steps along the averaged gradient, scaled so that its largest entry moves by ``rate``: features
    of many texts move, those of a few hardly do."""

    def __init__(self, like: np.ndarray, rate: float) -> None:
        self.mean, self.rate = np.zeros_like(like), rate

    def step(self, x: np.ndarray, gradient: np.ndarray, slower: float) -> None:
        self.mean += 0.2 * (gradient - self.mean)
        x -= self.rate * slower * self.mean / max(float(np.abs(self.mean).max()), 1e-30)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and offset of a logistic fit of ``y`` on ``z``, with a little ridge on the scale."""
    middle, spread = np.average(z, weights=weight), np.sqrt(np.cov(z, aweights=weight)) + 1e-12
    z, a, b = (z - middle) / spread, 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * z + b)
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        ga, gb = (g * z).sum() + 0.1 * (a - 1), g.sum() + 1e-3 * b
        haa, hab, hbb = (h * z * z).sum() + 0.1, (h * z).sum(), h.sum() + 1e-3
        det = haa * hbb - hab * hab
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    a = max(a, 1e-3)
    return float(a / spread), float(b - a * middle / spread)


def fit(texts: list[str], toxic: np.ndarray, share: float, how: Subwords) -> Model:
    """Train vectors and class weights together; ``share`` is the share of toxic among all labels.

    The last quarter of the texts calibrates the score. With one class only, the score is the share.
    """
    y = np.asarray(toxic, np.float64)
    flat = float(np.log(max(share, 1e-4) / max(1 - share, 1e-4)))
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[~held])) < 2:
        return Model(how, np.zeros(how.buckets), 1.0, flat)
    vocabulary: dict[str, int] = {}
    parts = [
        np.array([vocabulary.setdefault(_plain(w), len(vocabulary)) for w in text.split()], np.int32) for text in texts
    ]
    tokens, sizes = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
    n_words = len(vocabulary)
    bucket, bounds = subwords(list(vocabulary), how)
    grams = np.diff(bounds)
    vocabulary.clear()
    doc = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    # a text has its words and a gap of window - 1 places, so a window for each place that it ends at
    counts = np.where(sizes > 0, sizes + how.window - 1, 0)
    inside = np.arange(len(tokens), dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
    begins = np.cumsum(counts) - counts
    place = np.repeat(begins.astype(np.int32), sizes) + inside
    del inside, parts
    n_places, of, some = int(counts.sum()), np.repeat(np.arange(len(y), dtype=np.int32), counts), counts > 0
    weight = np.where(y > 0, 0.5 / max((y[~held] > 0).sum(), 1), 0.5 / max((y[~held] == 0).sum(), 1)) * ~held

    rng = np.random.default_rng(how.seed)
    vectors = rng.normal(0, 0.01, (how.buckets, how.dimensions))
    classes, bias = rng.normal(0, 0.5, (2, how.dimensions)), 0.0
    learn = [_Descent(p, how.rate) for p in (vectors, classes)]
    for step in range(how.average_steps + how.window_steps + 1):
        difference = classes[1] - classes[0]
        values = (vectors @ difference).astype(np.float32)
        word = _means(values, bucket, bounds)
        spread = np.zeros(n_places)
        spread[place] = word[tokens]
        sums = _windows(spread, how.window)
        best = np.zeros(len(y))
        if n_places:
            best[some] = np.maximum.reduceat(sums, begins[some])
        if step == how.average_steps + how.window_steps:
            break
        if step < how.average_steps:
            z = np.bincount(doc, word[tokens], len(y)) / np.maximum(sizes, 1) + bias
            each = (weight * (_sigmoid(z) - y) / np.maximum(sizes, 1))[doc]
        else:
            top = (sums == best[of]).astype(np.float64)
            top /= np.maximum(np.bincount(of, top, len(y)), 1)[of]
            error = weight * (_sigmoid(best + bias) - y)
            # a word is in the windows that end at its place and up to window - 1 places later
            each = _windows(top[::-1], how.window)[::-1][place] * error[doc]
            z = best + bias
        per_word = np.bincount(tokens, each, n_words) / grams
        per_bucket = np.bincount(bucket, np.repeat(per_word.astype(np.float32), grams), how.buckets)
        toward = vectors.T @ per_bucket
        gradients = per_bucket[:, None] * difference, np.stack([-toward, toward])
        for parameter, descent, gradient in zip((vectors, classes), learn, gradients):
            descent.step(parameter, gradient, 1 - step / (how.average_steps + how.window_steps))
        bias -= (weight * (_sigmoid(z) - y)).sum()
    real = np.where(y > 0, share / max((y[held] > 0).sum(), 1), (1 - share) / max((y[held] == 0).sum(), 1)) * held
    if len(set(y[held])) < 2:
        return Model(how, values, 1.0, bias)
    scale, offset = _calibrated(best + bias, y, real * held.sum())
    return Model(how, values, scale, offset + scale * bias)


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that is never learnt from; null ids belong to it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, how: Subwords) -> Model:
    """Fit on at most ``how.sample`` labelled documents, those of least hash in either class.

    Several labels of a document count as their greatest. Null labels and ids are none. Of several texts
    with one id, that of least hash is taken. Texts are taken whole, in the order of the hashes of their
    ids; one that doesn't fit in what is left of ``how.sample_bytes`` is passed over.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    order = F.xxhash64("doc_id", F.lit(how.seed))
    halves = [known.where(F.col("toxic") == t).orderBy(order).limit(how.sample // 2) for t in (0, 1)]
    chosen = halves[0].unionByName(halves[1]).withColumnRenamed("doc_id", "_id")
    # at most how.sample rows of two numbers, so every task can have them
    texts = documents.select(F.col("doc_id").alias("_doc"), text_of().alias("_body"))
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    least = F.min(F.struct(F.xxhash64("_body"), "_body"))["_body"].alias("_body")
    rows = checkpointed(rows.groupBy("_doc", "toxic").agg(least))
    sizes = rows.select("_doc", "toxic", F.octet_length("_body"), F.xxhash64("_doc", F.lit(how.seed)).alias("_order"))
    left, fitting = {0: how.sample_bytes // 2, 1: how.sample_bytes // 2}, []
    found = sorted(sizes.collect(), key=lambda r: (r[3], r[0]))
    for doc, label, size, _ in found:
        if size <= left[label]:
            left[label] -= size
            fitting.append(doc)
    if len(fitting) < len(found):
        rows = rows.where(F.col("_doc").isin(fitting))
    rows = rows.select("_doc", "_body", "toxic").toArrow().sort_by([("_doc", "ascending")])
    shuffled = np.random.default_rng(how.seed).permutation(len(rows))
    rows = rows.take(pa.array(shuffled))
    return fit(rows["_body"].to_pylist(), rows["toxic"].to_numpy(), float(share), how)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` from 0 to 1 and ``predicted`` (1 from 0.5 on).

    Whole texts are scored. Null and empty texts have no window and get the score of a zero vector.
    """
    how = model.how

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                split = [text.split() for text in part["text"].to_pylist()]
                new = [w for w in set().union(*split) if w not in known]
                if len(known) + len(new) > _REMEMBERED:
                    known.clear()
                    new = list(set().union(*split))
                if new:
                    bucket, bounds = subwords([_plain(w) for w in new], how)
                    known.update(zip(new, _means(model.values, bucket, bounds).tolist()))
                most = np.zeros(len(split))
                for i, ws in enumerate(split):
                    if ws:
                        value = np.zeros(len(ws) + how.window - 1)
                        value[: len(ws)] = np.fromiter(map(known.__getitem__, ws), np.float64, len(ws))
                        most[i] = _windows(value, how.window).max()
                scores = _sigmoid(model.scale * most + model.offset)
                yield pa.record_batch(
                    [part["doc_id"], part["held_out"], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    slim = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(rate, f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity(documents: DataFrame, labels: DataFrame, how: Subwords | None = None) -> DataFrame:
    """``score`` of all documents by a model trained on the labels of documents not held out."""
    return score(documents, train(documents, labels, how or Subwords()))
