"""Queries that SQL can express, against DuckDB, on the smallest tables and on dirty ones."""

import duckdb
import pytest
from pyspark.sql import functions as F

from catalog_signals.llm.line_dedup import deduped_documents, dedup_lines
from catalog_signals.llm.mixing import mixed_documents, mixture
from catalog_signals.llm.quality_rules import LineLimits, clean_documents, quality_rules
from catalog_signals.llm.queries import QUERIES
from catalog_signals.llm.sql import ORACLE
from catalog_signals.llm.url_filters import Reputation, filter_urls
from tests.llm.frames import COLUMNS, dirty, dirty_rows, empty, frame
from verification.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin_on_the_smallest_tables(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) == []


def _documents(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows) if rows else None
    return con


@pytest.mark.parametrize("name, run", [
    ("op8_mixing", mixture),
    ("op9_quality_rules", lambda d: quality_rules(d).drop("removed_words")),
])
def test_twin_on_dirty_and_empty_documents(spark, name, run):
    assert differences(run(dirty(spark)), _documents(dirty_rows()), ORACLE[name]) == []
    assert run(empty(spark)).count() == 0


def test_line_dedup_of_dirty_documents(spark):
    """Distinct rows only: SQL numbers repeated rows apart, the operator takes them as one document."""
    rows = list(dict.fromkeys(dirty_rows()))
    found = differences(dedup_lines(frame(spark, rows)), _documents(rows), ORACLE["op10_line_dedup"])
    assert found == []
    assert dedup_lines(empty(spark)).count() == 0
    twice = [r for r in dedup_lines(dirty(spark)).collect() if r.doc_id == 1]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_stages_keep_the_columns(spark):
    for stage in (clean_documents, deduped_documents, mixed_documents):
        out = stage(dirty(spark))
        assert out.schema.names == dirty(spark).schema.names and out.count() > 0
        assert stage(empty(spark)).count() == 0


def test_line_dedup_keeps_the_first_occurrence(spark):
    a, b, c, d = "first line", "second line", "third line", "fourth line"
    rows = [(2, "\n".join([a, b, c, d]), "", "", 0), (1, "\n".join(["x", a, b, c]), "", "", 0), (3, "\n".join([a, b, c]), "", "", 0)]
    out = {r.doc_id: r for r in dedup_lines(frame(spark, rows)).collect()}
    assert (out[1].text, out[2].text, out[3].text) == (rows[1][1], d, "")
    assert (out[2].n_lines, out[2].n_removed) == (4, 3)
    kept = {r.doc_id: r for r in deduped_documents(frame(spark, rows)).collect()}
    assert sorted(kept) == [1, 2] and kept[2].n_chars == len(d)


def test_overlapping_windows_merge(spark):
    line = "the same line"
    out = dedup_lines(frame(spark, [(1, "\n".join([line] * 5), "", "", 0)])).first()
    assert (out.text, out.n_removed) == (line, 4)


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    words = " ".join(f"own{{0}}w{i}" for i in range(30))
    rows = [(i, f"Read   MORE here\n{words.format(i)}", "en", "h", 0) for i in range(40)]
    thin = " ".join(f"thin{i}" for i in range(18))
    rows += [(100, f"read more HERE\n{thin}", "en", "h", 0), (101, f"read more here\n{thin}", "en", "other", 0)]
    verdict = {r.doc_id: r for r in quality_rules(frame(spark, rows)).collect()}
    assert verdict[0].removed_words == 0 and verdict[1].removed_words == 3
    assert verdict[1].kept and not verdict[100].kept and not verdict[100].base_failed and verdict[101].kept
    left = {r.doc_id: r.text for r in clean_documents(frame(spark, rows)).collect()}
    assert left[0].startswith("Read") and left[1] == words.format(1) and 100 not in left


def test_of_documents_with_one_id_or_none_one_keeps_a_frequent_line(spark):
    for ids in ([None] * 40, [7] * 40, list(range(40))):
        body = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(40)]
        rows = [(doc, f"Follow us on all channels today\n{text}", "en", "h", 0) for doc, text in zip(ids, body)]
        limits = LineLimits(min_documents=5)
        left = [r.text for r in clean_documents(frame(spark, rows), limits=limits).collect()]
        assert len(left) == 40 and sum(t.startswith("Follow") for t in left) == 1
        removed = quality_rules(frame(spark, rows), limits=limits).where("removed_words = 6").count()
        assert removed == 39


def test_texts_of_very_many_removed_lines(spark):
    n = 40_000
    text = "\n".join(f"l{i} and some more words" for i in range(n))
    rows = [(1, text, "en", "h", 0), (2, f"{text}\nthe last line of all", "en", "h", 0)]
    left = {r.doc_id: r for r in dedup_lines(frame(spark, rows)).collect()}
    assert (left[1].n_removed, left[2].n_removed) == (0, n) and left[2].text == "the last line of all"
    rows = [(i, f"{text}\n{' '.join(f'd{i}w{j}' for j in range(40))}", "en", "h", 0) for i in range(12)]
    left = sorted(len(r.text) for r in clean_documents(frame(spark, rows)).collect())
    assert len(left) == 12 and left[-1] > len(text) and left[-2] < 400


def test_copies_of_a_text_do_not_condemn_its_lines(spark):
    text = "\n".join(" ".join(f"l{j}w{i}" for i in range(10)) for j in range(5))
    rows = [(i, text, "en", "h", 0) for i in range(200)]
    assert quality_rules(frame(spark, rows)).where("not kept").count() == 0


def test_filters_on_verdicts_can_be_planned(spark):
    """A predicate that Catalyst moves down must not multiply the expressions below it."""
    out = quality_rules(dirty(spark), limits=LineLimits(min_documents=1)).where("kept and n_repeat_words = 0")
    assert out.count() > 0


def test_mixture_meets_targets_and_ignores_partitions(spark):
    rows = [(i, "w " * (i % 37), "en", f"s{i % 5}", 0) for i in range(3000)] + [(i, "w " * 900, "en", "s0", 0) for i in range(9)]
    df = frame(spark, rows)
    out = mixture(df).collect()
    assert sorted(out) == sorted(mixture(df.repartition(7)).collect())
    total = sum(r.size for r in out)
    targets = {r.source_size: r.target for r in out}
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    for source_size, target in targets.items():
        taken = sum(r.taken for r in out if r.source_size == source_size)
        assert abs(taken - target) <= 1000 and target <= 3 * source_size
    assert all(r.taken <= 3 * r.size for r in out)


def test_mixed_documents_agree_with_the_mixture(spark):
    df = frame(spark, [(i, "w " * (i % 11 + 1), "en", f"s{i % 3}", 0) for i in range(300)])
    drawn = {r.doc_id: r["count"] for r in mixed_documents(df).groupBy("doc_id").count().collect()}
    assert drawn == {r.doc_id: r.taken // r.size for r in mixture(df).collect() if r.taken}


def test_reputation_blocks_hosts_with_bad_outcomes(spark):
    urls = [(i, f"http://bad.test/{i}") for i in range(60)] + [(100 + i, f"http://good.site.test/{i}") for i in range(60)]
    urls += [(300, "http://new.site.test/"), (301, None), (302, "nonsense"), (303, "HTTP://A.Example.ORG?x"), (None, "http://bad.test/")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame(
        [(i, 0) for i in range(50)] + [(100 + i, 1) for i in range(50)] + [(300, None), (None, 0)], "page_id bigint, good int"
    )
    out = {r.page_id: r for r in filter_urls(pages, labels).collect()}
    assert {out[i].verdict for i in range(60)} == {"block"} and {out[100 + i].verdict for i in range(60)} == {"allow"}
    assert out[300].verdict == "allow" and out[None].verdict == "block"
    assert (out[301].host, out[301].path, out[302].host) == ("", "", "")
    assert (out[303].host, out[303].path, out[303].rule) == ("a.example.org", "", None)
    assert filter_urls(pages.limit(0), labels).count() == 0
    assert filter_urls(pages, labels.limit(0), how=Reputation()).where("verdict = 'block'").count() == 0


@pytest.mark.parametrize("url, rule, verdict", [
    ("http://example.org/es/x", "example.org/es/", "block"), ("http://a.example.org/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "org/", "allow"), ("http://b.com/fr/", "com/fr/", "allow"),
    ("http://b.com/de/?q", "com/de/", "block"), ("http://notexample.org/es/", "org/", "allow"), ("http://b.com/en/", None, "allow"),
])
def test_rules(spark, url, rule, verdict):
    pages = spark.createDataFrame([(1, url)], "page_id bigint, url string")
    labels = spark.createDataFrame([], "page_id bigint, good int")
    row = filter_urls(pages, labels).first()
    assert (row.rule, row.verdict) == (rule, verdict)


def test_columns_are_those_of_documents():
    assert [c.split()[0] for c in COLUMNS.split(", ")] == ["doc_id", "text", "lang", "source", "n_chars"]
