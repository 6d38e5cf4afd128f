import random
import zlib

import duckdb
import numpy as np

import catalog_signals.llm.toxicity as toxicity_module
from catalog_signals.llm.toxicity import Model, Subwords, fit, score, subwords, toxicity, train
from tests.llm.frames import dirty, dirty_rows, empty, frame, prose

SF = "/root/testdata/sf0.1"


def _rows():
    return duckdb.sql(
        f"SELECT doc_id, text, toxic FROM '{SF}/documents.parquet' d JOIN '{SF}/labels.parquet' l USING (doc_id) ORDER BY 1"
    ).fetchall()


def _out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_documents_are_recognised(spark):
    rows = _rows()
    learnt = [r for r in rows if not _out(r[0])]
    order = np.random.default_rng(0).permutation(len(learnt))
    toxic = np.array([learnt[i][2] for i in order])
    model = fit([learnt[i][1] for i in order], toxic, float(toxic.mean()), Subwords())
    test = spark.createDataFrame([r for r in rows if _out(r[0])], "doc_id bigint, text string, toxic int")
    truth = {r.doc_id: r.toxic for r in test.collect()}
    got = score(test, model).collect()
    assert all(r.held_out and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    ranked = sorted(got, key=lambda r: r.score)
    places = [i for i, r in enumerate(ranked) if truth[r.doc_id]]
    positives, negatives = len(places), len(ranked) - len(places)
    auc = (sum(places) - positives * (positives - 1) / 2) / (positives * negatives)
    accuracy = np.mean([r.predicted == truth[r.doc_id] for r in got])
    # 352 toxic documents to learn from; always saying 0 has an accuracy of 0.88
    assert auc > 0.9 and accuracy > 0.93


def test_misspellings_share_ngrams():
    how = Subwords()
    bucket, bounds = subwords(["worthless", "worthles", "garden"], how)
    sets = [set(bucket[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    assert len(sets[0] & sets[1]) > 10 > len(sets[0] & sets[2])
    one, _ = subwords(["garden"], how)
    assert sets[2] == set(one.tolist())
    assert len(subwords([""], how)[0]) == 1 and subwords([], how)[0].size == 0


def test_labels_of_held_out_documents_are_never_learnt(spark):
    rows = [(i, f"plain words number {i} " + ("vile scum" if i % 2 else "kind friend"), "en", "s", 0) for i in range(400)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = [(i, i % 2) for i in range(400)]
    wrong = [(i, 1 - t if _out(i) else t) for i, t in labels]
    how = Subwords(sample=200)
    first, second = (
        sorted(map(tuple, toxicity(documents, spark.createDataFrame(x, "doc_id bigint, toxic int"), how).collect()))
        for x in (labels, wrong)
    )
    assert first == second
    assert np.mean([p == i % 2 for i, held, _, p in first if held]) > 0.95


def test_dirty_and_empty_documents(spark):
    for labels in ([], [(1, 0), (None, 1), (2, None)], [(i, i % 2) for i in range(16)]):
        known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        out = toxicity(dirty(spark), known).collect()
        assert len(out) == len(dirty_rows()) and all(0 <= r.score <= 1 for r in out)
        assert toxicity(empty(spark), known).count() == 0


def test_one_whole_text_per_id_and_bounded_bytes_reach_the_driver(spark, monkeypatch):
    rows = [(i, f"text {i} " + "word " * 50, "", "", 0) for i in range(60)]
    rows += [(7, f"another {i}", "", "", 0) for i in range(300)] + [(8, "x" * 100_000, "", "", 0)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    seen = []
    monkeypatch.setattr(toxicity_module, "fit", lambda texts, *rest: seen.append((texts, rest[0])))
    documents = frame(spark, rows)
    train(documents, labels, Subwords())
    texts, ids = seen[0][0], [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    assert len(texts) == len(ids) and len(set(texts)) == len(texts) and set(texts) <= {r[1] for r in rows}
    train(documents, labels, Subwords(sample_bytes=4000))
    texts, toxic = seen[1]
    assert set(texts) <= {r[1] for r in rows} and set(toxic) == {0, 1}
    assert all(0 < sum(len(x) for x, y in zip(texts, toxic) if y == label) <= 2000 for label in (0, 1))


def test_the_score_is_that_of_the_best_of_all_overlapping_windows(spark):
    how = Subwords(buckets=1 << 12)
    model, rng = Model(how, np.random.default_rng(3).normal(0, 1, how.buckets), 1.0, 0.0), random.Random(3)
    texts = [prose(rng, n) for n in range(1, 40)]
    got = {r.doc_id: r.score for r in score(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)]), model).collect()}
    for i, text in enumerate(texts):
        bucket, bounds = subwords(text.split(), how)
        value = [model.values[bucket[a:b]].mean() for a, b in zip(bounds, bounds[1:])]
        best = max(sum(value[max(at, 0) : at + 4]) / 4 for at in range(-3, len(value)))
        assert abs(got[i] - 1 / (1 + np.exp(-best))) < 1e-9
