"""The similarity operators against brute force, with groups that need several blocks."""

import random
from collections import Counter

import numpy as np
import pytest

from catalog_signals.llm import buckets
from catalog_signals.llm.embedding_dedup import Hyperplanes, _maybe_near, _sketches, near_duplicates
from catalog_signals.llm.embedding_dedup import _near as _near_vectors
from catalog_signals.llm.ngram_join import ChosenPaths, _maybe_similar, _similar, _sketch, distinct_documents, jaccard_join
from catalog_signals.llm.words import mixed
from tests.llm.frames import components, dirty, dirty_rows, empty, frame, jaccard_links, prose


def _near(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def _planted(seed):
    rng = random.Random(seed)
    texts = []
    for size, copies, edits in ((200, 40, 2), (60, 6, 1), (400, 12, 9), (30, 5, 1), (6, 4, 0)):
        base = prose(rng, size)
        texts += [base, base] + [_near(rng, base, rng.randint(0, edits)) for _ in range(copies)]
    passage = prose(rng, 20)
    texts += [prose(rng, 80) + " " + passage + " " + prose(rng, 80) for _ in range(60)]
    return [*texts, None, "", "one", "one", "two words", "two  words"]


def _expected(rows):
    texts = [t for _, t in rows]
    links = jaccard_links(texts)
    root, linked = components(len(rows), links), Counter(i for link in links for i in link)
    least = {}
    for (doc, _), r in zip(rows, root):
        least[r] = min(least.get(r, doc), doc)
    return sorted((doc, least[r], linked[i]) for i, ((doc, _), r) in enumerate(zip(rows, root)))


@pytest.mark.parametrize("how", [ChosenPaths(), ChosenPaths(large=8, seed=3, recall=0.99999)])
def test_jaccard_join_is_brute_force(spark, how, monkeypatch):
    monkeypatch.setattr(buckets, "_CHUNK", 7)
    rows = [(i * 3, t) for i, t in enumerate(_planted(11))]
    df = frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    found = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_join(df, how).collect())
    assert found == _expected(rows)
    kept = sorted(r.doc_id for r in distinct_documents(df, how).collect())
    assert kept == sorted(doc for doc, class_id, _ in found if doc == class_id)


def test_runs_follow_the_target_recall():
    assert ChosenPaths(depth=1, recall=0.99).runs == 5 and ChosenPaths().runs == 14


def test_dirty_documents(spark):
    rows = sorted((r.doc_id or 0, r.n_links) for r in jaccard_join(dirty(spark)).collect())
    assert len(rows) == len(dirty_rows()) and (10, 1) in rows and (11, 1) in rows and (5, 0) in rows and (4, 0) in rows
    kept = distinct_documents(dirty(spark))
    assert kept.columns == dirty(spark).columns
    # copies and near copies of 1, repeated and null ids too: whichever is least stays, as one row
    texts = Counter(r.text for r in kept.collect())
    assert sum(n for t, n in texts.items() if t and t.startswith(dirty_rows()[0][1][:40])) == 1 and texts["one"] == 1
    assert jaccard_join(empty(spark)).count() == 0 and distinct_documents(empty(spark)).count() == 0


def test_comparisons_are_exact_at_the_threshold():
    tokens = np.sort(mixed(np.arange(1000, dtype=np.uint64)))
    base, rng = tokens[:900], np.random.default_rng(0)
    for n in (3, 30):
        sets = [base, np.sort(tokens[100:1000]), base[:720], base[:719]] + [np.sort(rng.choice(tokens, 500, False)) for _ in range(n - 3)]
        linked = _similar(4, 5)([s.tobytes() for s in sets])
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = len(np.intersect1d(a, b))
                assert i == j or linked[i, j] == (5 * both >= 4 * (len(a) + len(b) - both))
        rough = _maybe_similar(4, 5)([_sketch(s, 78) for s in sets])
        assert not (linked & ~rough).any()
    assert not _maybe_similar(4, 5)([_sketch(base, 78), _sketch(tokens[:600], 78)])[0, 1]


def test_sets_too_small_for_sketches_are_compared_by_their_tokens():
    rng = np.random.default_rng(4)
    some = np.sort(mixed(np.arange(5000, dtype=np.uint64)))
    bases = [rng.choice(some, size, False) for size in (1, 2, 20, 40, 63, 64, 70, 78, 79, 90)]
    sets = [base[: len(base) - cut] for base in bases for cut in (0, 1, 4, 9, 15) if cut < len(base)]
    sets = [np.sort(s) for s in sets + [rng.choice(some[:60], 50, False) for _ in range(40)]]
    rough, exact = (verify(sets_) for verify, sets_ in (
        (_maybe_similar(4, 5), [_sketch(s, 78) for s in sets]), (_similar(4, 5), [s.tobytes() for s in sets])
    ))
    small = np.array([len(s) < 64 for s in sets])
    either = small[:, None] | small[None, :]
    assert (rough == exact)[either].all() and not (exact & ~rough).any()


def _cosine_links(vectors, labels):
    links = set()
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is None or b is None or labels[i] is None or labels[i] != labels[j] or len(a) != len(b):
                continue
            a_, b_ = np.array(a, float), np.array(b, float)
            if np.isfinite(a_).all() and np.isfinite(b_).all() and a_.any() and b_.any():
                a_, b_ = a_ / abs(a_).max(), b_ / abs(b_).max()
                if a_ @ b_ / np.linalg.norm(a_) / np.linalg.norm(b_) >= 0.93:
                    links.add((j, i))
    return links


def test_embeddings_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(buckets, "_CHUNK", 9)
    rng = np.random.default_rng(2)
    vectors, labels = [], []
    for group in range(30):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 25))):
            vectors.append((centre + rng.normal(size=16) * rng.choice([0.0, 0.15, 0.4])).tolist())
            labels.append(group % 3)
    vectors += [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0] * 16, [1.0] * 16, [1.0] * 8, [1.0] * 8, [], [1e300] * 16, [1e-300] * 16]
    labels += [0, 0, 0, 0, None, None, 1, 1, 1, 2, 2]
    rows = [(i, v, label) for i, (v, label) in enumerate(zip(vectors, labels))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "vec_id as node", "1 as bucket")
    out = sorted(map(tuple, near_duplicates(df, Hyperplanes(recall=0.999999)).collect()))
    links = _cosine_links([None if v is None or None in v else v for v in vectors], labels)
    root, linked = components(len(rows), links), Counter(i for link in links for i in link)
    assert out == [(i, linked[i], root[i], root[i] == i) for i in range(len(rows))]
    assert near_duplicates(df.limit(0)).count() == 0
    repeated = near_duplicates(df.where("vec_id = 0").union(df.where("vec_id = 0"))).collect()
    assert [tuple(r) for r in repeated] == [(0, 1, 0, True)] * 2


@pytest.mark.parametrize("d", [1, 2, 3, 64, 1500])
def test_sketches_lose_no_near_vector(d):
    rng = np.random.default_rng(d)
    centres = rng.normal(size=(20, d))
    noise = rng.normal(size=(20, 12, d)) * rng.uniform(0.2, 0.6, (20, 12, 1))
    vectors = (centres[:, None, :] + noise).reshape(-1, d)
    vectors[::7] *= rng.random((len(vectors[::7]), d)) < 0.2  # few components that aren't zero
    vectors = vectors[vectors.any(1)] * 10.0 ** rng.integers(-100, 100, (int(vectors.any(1).sum()), 1))
    vectors = vectors / np.abs(vectors).max(1)[:, None]
    linked = _near_vectors(0.93)([v.tobytes() for v in vectors])
    rough = _maybe_near(0.93)(_sketches(vectors))
    assert not (linked & ~rough).any() and linked.sum() > len(vectors)
    if d == 64:
        assert not (rough & ~_near_vectors(0.89)([v.tobytes() for v in vectors])).any()
