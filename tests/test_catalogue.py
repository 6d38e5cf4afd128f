"""Versions, client scope, tenant roll-up, lookup and validation."""

import datetime as dt
import random

import pytest
from frames import LOOKUP, MERGED, SERVICE_TYPES, rows, type_row
from pyspark.sql import functions as F

from catalog_signals.config import FLAGS
from catalog_signals.operators import lookup, scope
from catalog_signals.operators.versions import dedupe_types, latest_types, latest_version
from catalog_signals.sources import scans

NAMED = "clientId string, TYPE_ID bigint, DESCRIPTION string"


def raw(spark, *type_rows):
    return spark.createDataFrame(list(type_rows), SERVICE_TYPES)


def test_latest_version_wins_and_missing_dates_lose(spark):
    df = raw(
        spark,
        type_row(description="old", loaded=dt.date(2020, 1, 1)),
        type_row(description="new", loaded=dt.date(2021, 1, 1)),
        type_row(description="undated", loaded=None),
        type_row(client="B", description="other client", loaded=None),
    )
    assert rows(latest_version(df), "clientId", "TYPE_ID", "DESCRIPTION") == [
        ("A", 1, "new"), ("B", 1, "other client"),
    ]


def test_version_ties_do_not_depend_on_input_order(spark):
    tied = [type_row(description=d, FREQUENCY=f) for d in ("b", "a", None) for f in ("2", "1")]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(tied)
        df = raw(spark, *tied).repartition(3)
        results.add(tuple(rows(latest_version(df), "DESCRIPTION", "API_FREQUENCY")))
    assert results == {(("a", 1),)}


def test_flags_are_cast_tolerantly(spark):
    row = latest_version(raw(spark, type_row(RESERVICE="n/a", FREQUENCY=" 30 ", INITIAL=None))).first()
    assert [row[f"API_{f}"] for f in FLAGS] == [None, 0, 30, 30, 0, None]


def test_one_window_equals_version_then_dedupe(spark):
    rng = random.Random(7)
    data = [
        type_row(
            client=rng.choice("AB"), type_id=rng.choice(["1", "01", "2", " 3"]), description=rng.choice(["x", "y", None]),
            loaded=rng.choice([None, dt.date(2020, 1, 1), dt.date(2020, 1, 2)]), FREQUENCY=rng.choice(["1", "x"]),
        )
        for _ in range(60)
    ]
    df = scope.tenant_rollup(raw(spark, *data), {"T": ["A", "B"]})
    columns = ["clientId", "TYPE_ID", "DESCRIPTION", "API_FREQUENCY", "sourceClient", "DATE_LOADED"]
    two_steps = rows(dedupe_types(latest_version(df, "clientId")), *columns)
    assert rows(latest_types(df, "clientId"), *columns) == two_steps
    assert len(two_steps) == 3


def test_client_list(spark):
    assert scope.requested_clients(" A, ,B ,A", fallback="C") == ["A", "B"]
    assert scope.requested_clients(None, fallback=["C ", ""]) == ["C"]
    assert scope.requested_clients("", "") is None
    df = raw(spark, type_row("A"), type_row("B"), type_row(None))
    assert rows(scope.distinct_clients(df), "clientId") == [("A",), ("B",)]
    assert rows(scope.scoped_service_types(df, ["B", "Z"]), "clientId") == [("B",)]
    assert rows(scope.scoped_service_types(df), "clientId") == [("A",), ("B",)]


def test_clients_may_be_a_list_of_any_length_a_text_or_a_frame(spark):
    df = raw(spark, type_row("A"), type_row("B"), type_row("C"), type_row(None))
    wanted = ["A", "C", "Z", *map(str, range(5000))]
    frame = spark.createDataFrame([(c,) for c in wanted], "name string")
    for clients in (wanted, "A, C,Z", frame):
        assert rows(scans.of_clients(df, clients, "CLIENT"), "CLIENT") == [("A",), ("C",)]
    assert rows(scope.scoped_service_types(df, "AB"), "clientId") == []


def test_a_source_named_twice_counts_once(spark):
    df = raw(spark, type_row("O1"), type_row("O1", 2), type_row("B"))
    assert scope.tenant_rollup(df, {"T": ["O1", "O1"]}).count() == 2


def test_a_usable_mapping_text_wins(spark):
    types = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y")], NAMED)
    table = spark.createDataFrame([("A", "x", "unknown"), ("A", "x", " true"), ("A", "y", "a"), ("A", "y", "b")], LOOKUP)
    assert rows(lookup.lookup_attach(types, table), "TYPE_ID", "isRecurring") == [(1, " true"), (2, "b")]


def test_copies_are_written_out_in_blocks(spark):
    df = spark.createDataFrame([(1, 3 * 4096 + 5), (2, 4096), (3, 1)], "id int, copies bigint")
    found = {r.id: r["count"] for r in lookup.expand_copies(df).groupBy("id").count().collect()}
    assert found == {1: 3 * 4096 + 5, 2: 4096, 3: 1}


def test_a_logical_client_exists_only_if_asked_for(spark):
    df = raw(spark, type_row("O1"), type_row("O2", description="other"), type_row("B"), type_row("T"))
    aliases = {"T": ["O1", "O2"]}
    everyone = scope.scoped_service_types(df, None, aliases)
    assert rows(everyone, "clientId") == [("B",), ("O1",), ("O2",), ("T",)]
    asked = scope.scoped_service_types(df, ["T", "B", "O1"], aliases)
    assert rows(asked, "clientId", "CLIENT") == [("B", "B"), ("O1", "O1"), ("T", "O1"), ("T", "O2")]


def types_frame(spark, data):
    return spark.createDataFrame(data, NAMED)


def test_lookup_matches_null_names_and_settles_ambiguity(spark):
    types = types_frame(spark, [("A", 1, "x"), ("A", 2, None), ("A", 3, "z"), ("B", 1, "x")])
    table = spark.createDataFrame(
        [("A", "x", "FALSE"), ("A", "x", "TRUE"), ("A", None, "TRUE"), ("B", "y", "TRUE"), ("A", "q", None)],
        LOOKUP,
    )
    assert rows(lookup.lookup_attach(types, table), "clientId", "TYPE_ID", "isRecurring") == [
        ("A", 1, "TRUE"), ("A", 2, "TRUE"), ("A", 3, None), ("B", 1, None),
    ]
    assert rows(lookup.lookup_attach_fanout(types, table), "clientId", "TYPE_ID", "isRecurring") == [
        ("A", 1, "FALSE"), ("A", 1, "TRUE"), ("A", 2, "TRUE"), ("A", 3, None), ("B", 1, None),
    ]


def test_equal_lookup_rows_multiply_a_type(spark):
    types = types_frame(spark, [("A", 1, "x")])
    table = spark.createDataFrame([("A", "x", "TRUE")] * 3 + [("A", "x", None)] * 2, LOOKUP)
    got = lookup.lookup_attach_fanout(types, table)
    assert rows(got, "isRecurring") == [("TRUE",)] * 3 + [(None,)] * 2
    assert rows(lookup.lookup_match_count(types, table), "copies") == [(5,)]


def test_repeated_names(spark):
    types = types_frame(
        spark, [("A", 1, "x"), ("A", 2, "x"), ("A", 3, "y"), ("A", 4, None), ("A", 5, None), ("B", 1, "x")]
    )
    expected = [
        ("A", 1, True), ("A", 2, True), ("A", 3, False), ("A", 4, False), ("A", 5, False), ("B", 1, False),
    ]
    assert rows(lookup.repeated_names(types), "clientId", "TYPE_ID", "repeated_name") == expected
    facts = lookup.name_facts(types, spark.createDataFrame([("A", "y", "TRUE")], LOOKUP))
    assert rows(lookup.name_types(types, facts), "clientId", "TYPE_ID", "repeated_name") == expected


def test_fanout_by_mapping_text_counts_every_match(spark):
    types = types_frame(spark, [("A", 1, "x"), ("A", 2, None), ("A", 3, "z")])
    table = spark.createDataFrame(
        [("A", "x", " true"), ("A", "x", "TRUE"), ("A", "x", "no"), ("A", "x", None), ("A", None, "False")],
        LOOKUP,
    )
    got = lookup.name_types_fanout(types, lookup.name_facts(types, table))
    assert rows(got, "TYPE_ID", "isRecurring", "copies", "repeated_name") == [
        (1, "TRUE", 2, True), (1, None, 2, True), (2, "FALSE", 1, False), (3, None, 1, False),
    ]


def test_reference_mismatch(spark):
    types = types_frame(
        spark, [("A", 1, "same"), ("A", 2, "mine"), ("A", 3, "lacking"), ("A", 4, None), ("A", 5, None)]
    )
    merged = scans.scan_merged_service_types(
        spark.createDataFrame(
            [("1", "A", "same"), ("2", "A", "theirs"), ("2", "A", "theirs"), ("2", "A", "mine"),
             ("2", "A", None), ("3", "B", "lacking"), ("4", "A", "named"), ("5", "A", None)],
            MERGED,
        )
    )
    assert rows(lookup.reference_mismatch(types, merged), "TYPE_ID", "DESCRIPTION", "DESCRIPTION_MERGED") == [
        (2, "mine", "theirs"), (2, "mine", "theirs"), (2, "mine", None), (3, "lacking", None),
        (4, None, "named"), (5, None, None),
    ]


def test_mismatch_equals_a_plain_left_join(spark):
    rng = random.Random(3)
    texts = ["x", "y", None]
    types = types_frame(spark, [(c, t, rng.choice(texts)) for c in "AB" for t in range(6)])
    merged = spark.createDataFrame(
        [(rng.choice("ABC"), rng.randrange(8), rng.choice(texts)) for _ in range(60)], NAMED
    )
    got = lookup.reference_mismatch(types, merged)
    other = merged.withColumnRenamed("DESCRIPTION", "DESCRIPTION_MERGED")
    plain = types.join(other, ["clientId", "TYPE_ID"], "left").where(
        F.col("DESCRIPTION_MERGED").isNull() | ~F.col("DESCRIPTION_MERGED").eqNullSafe(F.col("DESCRIPTION"))
    )
    columns = ["clientId", "TYPE_ID", "DESCRIPTION", "DESCRIPTION_MERGED"]
    assert rows(got, *columns) == rows(plain, *columns)


@pytest.mark.parametrize("bad", ["x1", "1.5"])
def test_a_malformed_type_id_fails_the_catalogue_scan(spark, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        latest_version(raw(spark, type_row(type_id=bad))).collect()


def test_a_mapping_of_aliases_moves_no_rows(spark):
    """Shuffled by source, the rows of two sources would be sorted in two tasks, whatever their number."""
    df = raw(spark, type_row("O1"), type_row("O2"), type_row("B")).repartition(3)
    names = spark.createDataFrame([("T",)], "name string")
    for moved in (
        scope.tenant_rollup(df, {"T": ["O1", "O2"]}),
        scope.scoped_service_types(df, ["T"], {"T": ["O1", "O2"]}),
    ):
        assert sorted(r.CLIENT for r in moved.collect()) == ["O1", "O2"]
        plan = moved._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert scope.tenant_rollup(df, {}).count() == 0
    assert sorted(r.CLIENT for r in scope.scoped_service_types(df, names, {"T": ["O1", "O2"]}).collect()) == ["O1", "O2"]
