"""The pipeline on the smallest tables, stage by stage against brute force."""

import pytest

import corpus_pipeline
from catalog_signals.llm.quality_rules import quality_rules
from tests.llm.frames import components, dirty, empty, jaccard_links

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What went into every stage and what came out, through Parquet."""
    folder, found = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{i}")
        found.append((docs, spark.read.parquet(f"{folder}/{i}")))
        docs = found[-1][1]
    return found


def test_stages_are_named_and_return_documents(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "mixing", "best-fit packing"
    ]
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    assert all(out.columns == columns for _, out in stages[:-1])


def test_quality_rules(stages):
    before, after = stages[0]
    kept = {r.doc_id for r in quality_rules(before).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == kept
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_line_dedup_leaves_no_repeated_window(stages):
    before, after = stages[1]
    seen = set()
    for r in sorted(before.collect()):
        lines = [x for x in r.text.split("\n") if x.strip(" \t\n\x0b\f\r")]
        seen |= {tuple(lines[i : i + 3]) for i in range(len(lines) - 2)}
    left = [tuple(w) for r in after.collect() for w in zip(*(r.text.split("\n")[i:] for i in range(3)))]
    first = {line for w in seen for line in w}
    assert {line for r in after.collect() for line in r.text.split("\n")} >= first
    repeated = {w for w in left if left.count(w) > 1 and w in seen}
    assert not repeated


def test_join_keeps_one_of_each_group(stages):
    before, after = stages[2]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    root = components(len(rows), jaccard_links([t for _, t in rows]))
    assert sorted(r.doc_id for r in after.collect()) == sorted({rows[i][0] for i in root})


def test_mixture_and_packing(stages):
    before, mixed = stages[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    drawn = mixed.collect()
    assert drawn and all(texts[r.doc_id] == r.text for r in drawn)
    assert max(mixed.groupBy("doc_id").count().collect(), key=lambda r: r["count"])["count"] <= 3
    packed = stages[4][1].collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert sum(r.piece == 0 for r in packed) == len(drawn)


def test_run_gives_what_the_stages_give(spark, stages):
    def key(df):
        return sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())

    assert key(corpus_pipeline.run(spark, SMALL)) == key(stages[4][1])


def test_dirty_and_empty_documents_pass_through(spark):
    for docs in (dirty(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        docs.count()
